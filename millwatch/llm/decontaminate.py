"""Benchmark decontamination: a generalised suffix automaton of the test items, over which documents are streamed.

The automaton's symbols are the items' normalised words. A document's words are followed through it, and the longest
match that ends at each word is tracked: where it reaches a window's length, the window has occurred. Its first two
transitions are tables that numpy looks up for a whole batch, so only runs of words in which every pair of
neighbours is a pair of some item, and which are long enough for the shortest window, are followed one by one.

The benchmark is read in parts of at most PART_BYTES, each with an automaton of its own that is sent to the tasks;
a larger benchmark takes several passes, whose spans are joined.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm import octets
from millwatch.llm.store import id_key, map_arrow, octets_of, saved

WINDOW = 10
#: Text of the items of one automaton, at most.
PART_BYTES = 32 << 20
#: Bytes that separate words, once A-Z are lower case; all others, with every byte of a character beyond ASCII, are in words.
BREAKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes | None) -> list[bytes]:
    """Normalised words: A-Z in lower case (other letters as they are), runs of digits, letters and non-ASCII."""
    return _WORD.findall((text or b"").lower())


class SuffixAutomaton:
    """Of several word sequences. step[state] has the transitions, length and link as usual; state 0 is the root.

    windows[state] lists the items with a window in the state's class of `window` words; whole[state] lists
    (length, item) of shorter items that end there or at a suffix of it.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.names = [name for name, _ in items]
        self.windows: dict[int, set[int]] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for _, seq in items:
            last = 0
            for word in seq:
                last = self._append(last, word)
        short: dict[int, list[tuple[int, int]]] = {}
        for i, (_, seq) in enumerate(items):
            state = 0
            for k, word in enumerate(seq):
                state = self.step[state][word]
                if k + 1 >= window:
                    at = state
                    while self.length[self.link[at]] >= window:
                        at = self.link[at]
                    self.windows.setdefault(at, set()).add(i)
            if 0 < len(seq) < window:
                short.setdefault(state, []).append((len(seq), i))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if got := self.whole.get(self.link[state], []) + short.get(state, []):
                self.whole[state] = got
        sizes = [min(len(seq), window) for _, seq in items if seq]
        self.least = min(sizes, default=0)

    def _append(self, last: int, word: bytes) -> int:
        step, length, link = self.step, self.length, self.link
        if (there := step[last].get(word)) is not None:
            return there if length[there] == length[last] + 1 else self._clone(last, word, there)
        new = self._state(length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            there = step[at][word]
            link[new] = there if length[there] == length[at] + 1 else self._clone(at, word, there)
        return new

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _clone(self, at: int, word: bytes, there: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.step[there]), self.link[there])
        self.link[there] = copy
        while at >= 0 and self.step[at].get(word) == there:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def stream(self, seq: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Occurrences of windows as (first word, end), and the items they are of."""
        state = matched = 0
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        for k, word in enumerate(seq, 1):
            while state and word not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if (there := self.step[state].get(word)) is None:
                continue
            state, matched = there, matched + 1
            for size, item in self.whole.get(state, ()):
                if size <= matched:
                    found.append((k - size, k))
                    items.add(item)
            if matched >= self.window:
                at = state
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                if got := self.windows.get(at):
                    found.append((k - self.window, k))
                    items |= got
        return found, items

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted fingerprints of the words, and of the pairs of neighbours, that have a transition."""
        known = sorted(self.step[0])
        o = octets.Octets(known)
        prints = dict(zip(known, octets.segment_hash(o.data, o.starts, o.ends).tolist(), strict=True))
        pairs = [(prints[a], prints[b]) for a, s in self.step[0].items() for b in self.step[s]]
        both = np.array(pairs, np.uint64).reshape(-1, 2)
        return np.unique(np.array(list(prints.values()), np.uint64)), np.unique(pair_hash(both[:, 0], both[:, 1]))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return octets.mix(a * np.uint64(3) + b)


class _Known:
    """Membership in a sorted table of fingerprints, behind a table of bits."""

    def __init__(self, values: np.ndarray, bits: int = 20) -> None:
        self.values, self.shift = values, np.uint64(64 - bits)
        self.bits = np.zeros(1 << bits, bool)
        self.bits[(values >> self.shift).astype(np.int64)] = True

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        out = self.bits[(asked >> self.shift).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(self.values):
            at = np.minimum(np.searchsorted(self.values, asked[some]), len(self.values) - 1)
            out[some] = self.values[at] == asked[some]
        return out


MATCH = "id long, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


def _follow(batch: pa.RecordBatch, shared, window: int, then=None) -> dict:
    automaton, word_known, pair_known = shared.value
    texts = octets_of(batch)
    n_words, n_hit, items, spans = [], np.zeros(len(texts), np.int64), [None] * len(texts), [None] * len(texts)
    mask = octets.word_mask(BREAKS)
    for lo, hi in octets.batches(texts):
        o = octets.Octets(texts[lo:hi])
        data = octets.lower_ascii(o.data)
        starts, ends = o.runs(mask[data])
        owner = o.owner(starts)
        n_words.append(octets.counts(owner, o.n))
        if not automaton.least or not len(starts):
            continue
        prints = octets.segment_hash(data, starts, ends)
        known = word_known(prints)
        near = np.flatnonzero(known[1:] & known[:-1] & (owner[1:] == owner[:-1]))
        joined = np.zeros(len(starts), np.int8)
        joined[near[pair_known(pair_hash(prints[near], prints[near + 1]))] + 1] = 1
        # a run starts at a known word that is not joined to the one before
        head = np.flatnonzero(known & (joined == 0))
        stop = np.flatnonzero(joined == 0)
        after = np.r_[stop, len(starts)][np.searchsorted(stop, head, side="right")]
        raw = data.tobytes()
        hits: dict[int, tuple[list, set]] = {}
        for a, b in zip(*(x[after - head >= automaton.least].tolist() for x in (head, after)), strict=True):
            found, who = automaton.stream([raw[starts[k] : ends[k]] for k in range(a, b)])
            if found:
                at, names = hits.setdefault(int(owner[a]), ([], set()))
                at += [(x + a, y + a) for x, y in found]
                names |= who
        for k, (at, names) in hits.items():
            at, merged = sorted(at), []
            for x, y in at:
                if merged and x <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], y)
                else:
                    merged.append([x, y])
            n_hit[lo + k] = sum(y - x for x, y in merged)
            items[lo + k] = sorted({automaton.names[i] for i in names})
            spans[lo + k] = [{"start": int(starts[x] - o.starts[k]), "end": int(ends[y - 1] - o.starts[k])} for x, y in merged]
    out = {"id": batch.column("id"), "n_words": np.concatenate(n_words) if n_words else [], "n_hit": n_hit, "items": items, "spans": spans, **({"row": batch.column("row")} if "row" in batch.schema.names else {})}
    return then(batch, out) if then else out


def _automaton(rows: list, window: int):
    seqs = [(str(r["item_id"]), words(r["text"])) for r in rows]
    automaton = SuffixAutomaton(seqs, window)
    a, b = automaton.tables()
    return automaton, _Known(a), _Known(b)


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs` (doc_id, text): id, n_words, n_hit, items, spans (byte ranges of hit words), row.

    `benchmark` has item_id and text. A window is `window` words of an item in a row, or a shorter item as a whole;
    a document's word inside an occurrence of one is hit. Null texts have no words; an item without words matches
    nothing. Items of one text all count; an item_id in several rows counts once. `row` holds all columns of `docs`.
    """
    return _leaks(docs, benchmark, window, MATCH)


def _leaks(docs: DataFrame, benchmark: DataFrame, window: int, columns: str, then=None) -> DataFrame:
    """``find_leaks``, or `columns` and row as ``then(batch, found)`` makes them: in the same call, since two calls of one
    stage are two workers for each task."""
    spark = docs.sparkSession
    tests = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // (PART_BYTES // 2)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_key("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    row = f"row {rows.schema['row'].dataType.simpleString()}"
    schema, last = (f"{columns}, {row}", then) if parts == 1 else (f"{MATCH}, {row}", None)
    passes = []
    for part in range(parts):
        mine = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        shared = spark.sparkContext.broadcast(_automaton(mine.collect(), window))
        passes.append(map_arrow(rows, _follow, schema, shared, window, last))
    if parts == 1:
        return passes[0]
    # several passes: hit words of a document are counted again on the joined spans
    key = F.xxhash64("text")
    texts = rows.withColumn("of", key)
    found = None
    for one in passes:
        one = one.where("n_hit > 0").select("id", F.xxhash64(F.col("row.text").cast("binary")).alias("of"), "items", "spans")
        found = one if found is None else found.unionByName(one)
    found = saved(found, "leaks").groupBy("id", "of").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    return map_arrow(texts.join(found, ["id", "of"], "left").drop("of"), _recount, f"{columns}, {row}", then)


def _recount(batch: pa.RecordBatch, then=None) -> dict:
    out: dict[str, list] = {"n_words": [], "n_hit": [], "spans": []}
    for text, spans in zip(octets_of(batch), batch.column("spans").to_pylist(), strict=True):
        merged: list[list[int]] = []
        for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out["n_words"].append(len(words(text)))
        out["n_hit"].append(sum(len(words(text[a:b])) for a, b in merged))
        out["spans"].append([{"start": a, "end": b} for a, b in merged] or None)
    out = {"id": batch.column("id"), "items": batch.column("items"), "row": batch.column("row"), **out}
    return then(batch, out) if then else out


def leak_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted ids, comma-joined), contaminated."""
    out = find_leaks(docs.select("doc_id", "text"), benchmark, window)
    listed = F.coalesce(F.array_join("items", ","), F.lit(""))
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _cut(most: float, batch: pa.RecordBatch, found: dict) -> dict:
    out: dict[str, list] = {"left": [], "keep": []}
    for text, spans, hit, n in zip(octets_of(batch), *(found[c] for c in ("spans", "n_hit", "n_words")), strict=True):
        at, left = 0, []
        for s in spans or ():
            left.append(text[at : s["start"]])
            at = s["end"]
        out["left"].append(b"".join([*left, text[at:]]).decode("utf-8", "replace"))
        out["keep"].append(bool(not n or hit <= most * n))
    return {"row": batch.column("row"), **out}


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = 0.5) -> DataFrame:
    """`docs` without hit spans; documents with a larger share of hit words than `coverage` go as a whole.

    Rows without a hit are returned as they are; n_chars, where there is one, follows the text.
    """
    cut = _leaks(docs, benchmark, window, "left string, keep boolean", partial(_cut, coverage)).where("keep")
    return cut.select(*rewritten(docs, F.when(F.col("row.text").isNotNull(), F.col("left"))))


def rewritten(docs: DataFrame, text) -> list:
    """The columns of `docs` out of `row`, with a new text and its length."""
    new = {"text": text, "n_chars": F.when(text.isNotNull(), F.char_length(text)).cast("long")}
    return [(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
