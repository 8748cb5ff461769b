"""Byte-level BPE with a hierarchical-bitmap rank queue.

The pairs that can merge wait in a bucket for their rank, as positions in a linked list of parts. Which buckets are in use
is kept in bits: 64 ranks to a word, 64 words to a word above, and one more level on top, so the next rank is found by
three find-first-set steps however much waits. A merge does not look for the entries that it makes void: an entry counts
only if the pair at its position still has the bucket's rank.

Pre-tokens do not depend on each other, so all new ones of a batch are parts of one list with gaps, and share one queue: a
bucket is taken whole and its positions are merged together, as arrays. Of positions that overlap ("aaa") every other one
merges, from the left. That is the order of one pre-token by itself unless a merge makes a pair of a lower rank, which
the ranks of trained vocabularies do not do; should it happen, pre-tokens are merged one by one.

Null text is empty. Repeated rows and ids are rows of their own; columns keep their names inside `row`, whatever they are;
a table without rows gives none.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import sha256
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.store import Tidy, arrow_schema, map_arrow, octets_of, record

#: Bytes of pre-tokens and their ids that a task remembers, about, in two generations, so frequent ones stay when the older
#: is dropped; and the longest of them. What is forgotten is encoded again.
REMEMBERED = 16 << 20
LONGEST = 64
#: What an entry takes besides its bytes.
ENTRY = 150
#: Bytes of text whose pre-tokens are looked up together.
TOGETHER = 1 << 20
#: A space that always starts a pre-token: no white space beside it (U+180E counts, as in older tables).
LONE_SPACE = re.compile(r"(?<=[^\s\u180E]) (?=[^\s\u180E])")


class BytePairs:
    """Encodes and decodes by a table of ranks and a pattern for pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.pairs = _Pairs(ranks)
        self.forget()

    def forget(self) -> None:
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of = self.ranks.get
        if (whole := rank_of(piece)) is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))  # a part is piece[at:end[at]]; the next one starts where it ends
        before = list(range(-1, n))
        pair: list[int | None] = [rank_of(piece[at : at + 2]) for at in range(n - 1)]
        pair.append(None)
        # the queue: positions by rank; bit r & 63 of low[r >> 6] if the bucket of rank r is in use; bit a of top if
        # low[a] has any
        buckets: dict[int, list[int]] = {}
        low: dict[int, int] = {}
        top = 0
        fresh = range(n - 1)  # positions to queue
        while True:
            for at in fresh:
                rank = pair[at]
                if rank is None:
                    continue
                if rank in buckets:
                    heappush(buckets[rank], at)
                    continue
                buckets[rank] = [at]
                a = rank >> 6
                if a in low:
                    low[a] |= 1 << (rank & 63)
                else:
                    low[a] = 1 << (rank & 63)
                    top |= 1 << a
            if not top:
                break
            a = (top & -top).bit_length() - 1
            word = low[a]
            rank = (a << 6) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket[0]
                del buckets[rank]
                word &= word - 1
                if word:
                    low[a] = word
                else:
                    del low[a]
                    top &= top - 1
            if pair[at] != rank:
                fresh = ()  # stale
                continue
            gone = end[at]
            stop = end[at] = end[gone]
            pair[gone] = None
            before[stop] = at
            left = before[at]
            if stop < n:
                pair[at] = rank_of(piece[at : end[stop]])
                fresh = (at, left) if left >= 0 else (at,)
            else:
                pair[at] = None
                fresh = (left,) if left >= 0 else ()
            if left >= 0:
                pair[left] = rank_of(piece[left:stop])
        ids, at, known = [], 0, self.ranks
        while at < n:
            ids.append(known[piece[at : end[at]]])
            at = end[at]
        return ids

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, each by itself, as little-endian 32-bit numbers."""
        packed = _merge_together(pieces, self.pairs, self.ranks)
        return [np.array(self.merge(p), "<u4").tobytes() for p in pieces] if packed is None else packed

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts: of their pre-tokens, one after another. A pre-token is merged once and remembered."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (size < TOGETHER or stop == start):
                size += len(texts[stop])
                stop += 1
            split = [self.pattern.findall(t) for t in texts[start:stop]]
            young, older = self.young, self.older
            found, missing = {}, []
            for piece in set().union(*split):
                ids = young.get(piece)
                if ids is None and (ids := older.get(piece)) is None:
                    missing.append(piece)
                else:
                    found[piece] = ids
            fresh = dict(zip(missing, self.merge_all([p.encode("utf-8") for p in missing]), strict=True))
            found |= fresh
            out += [b"".join(map(found.__getitem__, pieces)) for pieces in split]
            if older:  # what is used again outlives its generation
                fresh |= {piece: ids for piece, ids in found.items() if piece not in young}
            for piece, ids in fresh.items():
                if len(piece) <= LONGEST:
                    young[piece] = ids
                    self.held += len(piece) + len(ids) + ENTRY
            if self.held >= REMEMBERED:
                self.young, self.older, self.held = {}, young, 0
            start = stop
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


class _Pairs:
    """The rank of two adjacent parts by their own ranks, for all pairs of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, values = [], []
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                if (left := ranks.get(piece[:cut])) is not None and (right := ranks.get(piece[cut:])) is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        #: one more entry, so that a search always finds a place
        self.keys = np.append(np.array(keys, np.int64)[order], -1)
        self.ranks = np.append(np.array(values, np.int64)[order], NONE)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys[:-1], key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


#: No pair.
NONE = 1 << 62


class _Queue:
    """Positions by rank; the lowest rank in use by three find-first-set steps."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low: dict[int, int] = {}
        self.middle: dict[int, int] = {}
        self.top = 0

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        at = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
        buckets = self.buckets
        for rank, i, j in zip(ranks[at].tolist(), at, [*at[1:], len(ranks)], strict=True):
            if rank in buckets:
                buckets[rank].append(positions[i:j])
                continue
            buckets[rank] = [positions[i:j]]
            a, b = rank >> 6, rank >> 12
            self.low[a] = self.low.get(a, 0) | 1 << (rank & 63)
            self.middle[b] = self.middle.get(b, 0) | 1 << (a & 63)
            self.top |= 1 << b

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and its positions, in order, once each."""
        b = (self.top & -self.top).bit_length() - 1
        word = self.middle[b]
        a = (b << 6) + (word & -word).bit_length() - 1
        bits = self.low[a]
        rank = (a << 6) + (bits & -bits).bit_length() - 1
        self.low[a] = bits & (bits - 1)
        if not self.low[a]:
            self.middle[b] &= ~(1 << (a & 63))
            if not self.middle[b]:
                self.top &= ~(1 << b)
        held = self.buckets.pop(rank)
        return rank, held[0] if len(held) == 1 else np.unique(np.concatenate(held))


def _merge_together(pieces: list[bytes], pairs: _Pairs, whole: dict[bytes, int]) -> list[bytes] | None:
    """Ids of pre-tokens by one queue; None if a merge makes a pair of a lower rank, or a byte has no rank."""
    out: list[bytes | None] = [None if (rank := whole.get(p)) is None else struct.pack("<I", rank) for p in pieces]
    left = [i for i, ids in enumerate(out) if ids is None]
    sizes = np.array([len(pieces[i]) for i in left], np.int64)
    n = int(sizes.sum())
    if not n:
        return [b"" if ids is None else ids for ids in out]
    part = pairs.bytes[np.frombuffer(b"".join([pieces[i] for i in left]), np.uint8)]
    if (part < 0).any():
        return None
    stops = np.cumsum(sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[stops[sizes > 0] - 1] = n  # the last part of a pre-token has none after it
    before[(stops - sizes)[sizes > 0]] = -1
    pair = np.full(n + 1, NONE)
    inner = np.flatnonzero(after < n)
    pair[inner] = pairs(part[inner], part[inner + 1])
    part = np.append(part, 0)
    before = np.append(before, -1)  # a place for what comes after a last part
    queue = _Queue()
    some = np.flatnonzero(pair < NONE)
    queue.add(pair[some], some)
    while queue.top:
        rank, at = queue.pop()
        at = at[pair[at] == rank]  # others are stale
        if not len(at):
            continue
        gone = after[at]
        if len(at) > 1 and (overlap := at[1:] == gone[:-1]).any():
            first = np.flatnonzero(np.append(True, ~overlap))
            nth = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
            at, gone = at[nth % 2 == 0], gone[nth % 2 == 0]
        beyond = after[gone]
        part[at], part[gone], pair[gone] = rank, -1, NONE
        after[at], before[beyond] = beyond, at
        ahead = before[at]
        near = np.concatenate((at, ahead[ahead >= 0]))
        further = after[near]
        fresh = np.where(further < n, pairs(part[near], part[further]), NONE)
        pair[near] = fresh
        live = fresh < NONE
        if live.any():
            if fresh.min() < rank:
                return None
            queue.add(fresh[live], near[live])
    kept = part[:n] >= 0
    ends = np.append(0, np.cumsum(kept))[stops] * 4
    packed = part[:n][kept].astype("<u4").tobytes()
    start = 0
    for i, end in zip(left, ends.tolist(), strict=True):
        out[i] = packed[start:end]
        start = end
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> BytePairs:
    """The coder of a worker process. `path` is a file that every executor has."""
    return BytePairs(load_ranks(path), pattern)


def _encode(batch: pa.RecordBatch, path: str, pattern: str) -> dict:
    ids = coder(path, pattern).encode_all([t.decode("utf-8", "replace") for t in octets_of(batch)])
    return {"row": batch.column("row"), "n_tokens": [len(x) // 4 for x in ids], "ids": ids}


def _decode(batch: pa.RecordBatch, path: str, pattern: str) -> dict:
    decode = coder(path, pattern).decode
    return {"row": batch.column("row"), "n_tokens": batch.column("n_tokens"), "ids": batch.column("ids"), "decoded": [decode(x) for x in batch.column("ids").to_pylist()]}


def _report(schema, path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = coder(path, pattern)
    try:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                ids = own.encode_all([t.decode("utf-8", "replace") for t in octets_of(batch)])
                yield record({"doc_id": batch.column("doc_id"), "n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [sha256(x).hexdigest() for x in ids],
                              "decoded_sha256": [sha256(own.decode(x)).hexdigest() for x in ids]}, schema)
    finally:
        own.forget()  # an idle worker keeps nothing


def encode_texts(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """`row` (the columns `keep`, all by default), n_tokens and ids (little-endian 32-bit) of each row of `docs`.

    Null text is empty and has no ids. No rows move: each is encoded where it is read.
    """
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, _encode, f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, ids binary", path, pattern, rows=512)


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """With `decoded`, the bytes that the ids of ``encode_texts`` stand for."""
    schema = f"row {encoded.schema['row'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary"
    return map_arrow(encoded, _decode, schema, path, pattern, rows=512)


def token_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the bytes that they decode to: encoded and decoded in one pass."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(Tidy(partial(_report, arrow_schema(schema), path, pattern)), schema)
