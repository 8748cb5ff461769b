"""Token counts by byte-pair merging over a heap and a linked list; no identifier is ever built.

The file is of the tokenizers library's kind: special strings are cut out of the raw text first, the rest is composed
(NFC) and lower-cased, split into words by the file's pattern, and each word's bytes are the first symbols, the last one
with the file's mark of a word's end. Per word the pairs that can merge wait in a heap by rank, then place; the lowest
is popped, its right part is taken out of the list of parts, and the pairs on both sides are queued anew. An entry counts
only while the pair at its place is the one it was queued for. Tokens are first symbols minus merges.

Null texts are empty: no bytes, no tokens. Repeated rows and ids are rows of their own, `row` keeps every other column
whatever its name, and a table without rows gives none. A text of one long word takes n log n steps.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.store import map_arrow, octets_of

#: Words that a worker remembers the count of, in two generations, and the longest of them.
REMEMBERED = 200_000
LONGEST = 48
#: The split's pattern does not depend on what white space is replaced by, as it matches none.
_NORMALIZERS = (["NFC", "Lowercase"], ["NFC", "Replace", "Lowercase"])


class WordCounter:
    """Counts the tokens of texts by a JSON file of the tokenizers library (byte level, word ends, lower case)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as lines:
            held = json.load(lines)
        model, self.words = held["model"], regex.compile(_pattern(held))
        self.end = model["end_of_word_suffix"] or ""
        number = {symbol: i for i, symbol in enumerate(model["vocab"])}
        letters = _letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        try:
            self.inner = [number[c] for c in letters]
            self.last = [number[c + self.end] for c in letters]
        except KeyError as e:
            raise ValueError(f"the vocabulary lacks the byte symbol {e}") from e
        self.width = max(1, (len(number) - 1).bit_length())
        #: left and right symbol in one number -> rank and joined symbol in one number
        self.merges: dict[int, int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[number[left] << self.width | number[right]] = rank << self.width | number[left + right]
        special = [t["content"] for t in held["added_tokens"]]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in held["added_tokens"]):
            raise ValueError("special strings that are stripped or normalised are not supported")
        # the longest of two that start at one place
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.known = _Known(lambda word: self.tokens_of_word(word.encode("utf-8")))
        self.path, self.library = path, None

    def tokens_of_word(self, data: bytes) -> int:
        n = len(data)
        parts: list[int] = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        if n == 1:
            return 1
        width, merge_of = self.width, self.merges.get
        mask = (1 << width) - 1
        after = list(range(1, n + 1))  # the part to the right; n is none
        before = list(range(-1, n - 1))
        bits = n.bit_length()
        places = (1 << bits) - 1
        # an entry is the merge (rank first), then the place of its left part
        heap = [found << bits | at for at in range(n - 1) if (found := merge_of(parts[at] << width | parts[at + 1])) is not None]
        heapify(heap)
        merged = 0
        while heap:
            entry = heappop(heap)
            at, merge = entry & places, entry >> bits
            right = after[at]
            if parts[at] < 0 or right >= n or merge_of(parts[at] << width | parts[right]) != merge:
                continue  # one of its parts has merged otherwise
            merged += 1
            parts[at], parts[right] = merge & mask, -1
            beyond = after[at] = after[right]
            if beyond < n:
                before[beyond] = at
                if (found := merge_of(parts[at] << width | parts[beyond])) is not None:
                    heappush(heap, found << bits | at)
            left = before[at]
            if left >= 0 and (found := merge_of(parts[left] << width | parts[at])) is not None:
                heappush(heap, found << bits | left)
        return n - merged

    def count(self, text: str) -> int:
        if "<" not in text:
            return self._plain(text)
        found = self.special.findall(text)
        return len(found) + sum(map(self._plain, self.special.split(text))) if found else self._plain(text)

    def _plain(self, text: str) -> int:
        if text.isascii():
            text = text.lower()
        elif _unknown(text):
            return sum(map(self.tokens_of_word, self.by_library(text)))
        else:
            # a capital sigma has one small form here, wherever it stands
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(map(self.known.__getitem__, self.words.findall(text)))

    def by_library(self, text: str) -> list[bytes]:
        """The words as the library prepares and splits them: for characters that this Python's tables do not know."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in pieces]


class _Known(dict):
    def __init__(self, make) -> None:
        self.make, self.older = make, {}

    def __missing__(self, word: str) -> int:
        if (found := self.older.get(word)) is None:
            found = self.make(word)
            if len(word) > LONGEST:
                return found
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def _unknown(text: str) -> bool:
    """Whether a character has no category in this Python's tables."""
    return max(text) >= "\ua000" and any(unicodedata.category(c) == "Cn" for c in set(text)) or _new_in_plane().search(text) is not None


@lru_cache(maxsize=1)
def _new_in_plane() -> re.Pattern:
    """The characters below U+A000 without a category, as ranges."""
    unknown = [c for c in range(0xA000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for c, p in zip(unknown, [-2, *unknown], strict=False) if c != p + 1]
    ends = [c for c, p in zip(unknown, [*unknown[1:], -2], strict=True) if c + 1 != p]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True)) + "]")


def _letters() -> list[str]:
    """The character that stands for each byte at byte level: itself if it prints, else the next one from U+0100 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printing else chr(next(others)) for b in range(256)]


def _pattern(held: dict) -> str:
    """The pattern of a word; files that prepare texts in another way are refused."""
    steps = (held["normalizer"] or {}).get("normalizers", [])
    split, *rest = (held["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    plain = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"] and [r["type"] for r in rest] == ["ByteLevel"]
    if [s["type"] for s in steps] not in _NORMALIZERS or not plain or rest[0]["use_regex"] or rest[0]["add_prefix_space"]:
        raise ValueError("not a lower-case word vocabulary at byte level")
    if held["model"]["type"] != "BPE" or held["model"]["continuing_subword_prefix"] or held["model"]["ignore_merges"]:
        raise ValueError("not a plain byte-pair model")
    return split["pattern"]["Regex"]


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def _count(batch: pa.RecordBatch, path: str) -> dict:
    count = counter(path).count
    texts = octets_of(batch)
    return {"row": batch.column("row"), "n_bytes": list(map(len, texts)), "n_tokens": [count(t.decode("utf-8", "replace")) for t in texts]}


def token_counts(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """`row` (the columns `keep`, all by default), n_bytes (UTF-8) and n_tokens of each row of `docs`, counted where it is read.

    `path` is a vocabulary file that every executor has.
    """
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, _count, f"row {rows.schema['row'].dataType.simpleString()}, n_bytes long, n_tokens long", path, rows=512)


def count_report(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether a document is over the limit."""
    return token_counts(docs, path, ["doc_id"]).select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
