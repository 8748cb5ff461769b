"""Which tokens of two tokenizers stand for each other, with pair counts by external spill counting.

A text is encoded by both; byte offsets at which tokens of both end cut it into groups, and all pairs of one group are
linked. How many documents hold a pair linked is counted over the whole corpus, outside of memory:

1. Documents are encoded where they are read. Links collect in memory as (pair, document) records; a full memory is
   sorted by pair and written to the shared folder as a zstd run: its distinct pairs, in how many of its documents each
   is, and the records behind. A pair that every document holds is one entry of a run, so no pair is a hot key.
2. The runs' entries are partitioned by radix of a mixed pair number. A task gets the pieces of a bucket one after
   another and merges FAN at a time by a k-way heap merge, adding counts up; what is merged is a run of the next merge. The
   order is by A's id, then B's, so each A id's maximum in the bucket falls off as its pairs go by.
3. The pieces pass by their bucket's totals again, and each run gets the totals of its own pairs back, in its order; with
   the maxima (one per id of A's vocabulary, the only thing that the driver holds) its records become contributions to its
   documents, which are written out.

Null and empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros, and '' for
the groups. Repeated rows, and rows of one id or none, are documents of their own. Other columns of the table are not
looked at. A table without rows gives none. One document is never split between runs, however long.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.store import Tidy, arrow_schema, octets_of, record, saved

#: Links, and documents, of a run.
RUN, RUN_DOCS = 1 << 22, 1 << 16
#: Pieces that are merged at once.
FAN = 64
#: Entries of a bucket, about, that its task merges.
BUCKET = 1 << 22
#: A group of more links than this is expanded by its distinct tokens.
WIDE = 1 << 10
#: Fixed value: the pre-tokens of byte-level vocabularies of this kind.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_symbols() -> dict[str, int]:
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return {chr(b) if b in printing else chr(next(others)): b for b in range(256)}


class BytesSide:
    """Ids by a byte-level BPE file of the tokenizers library; special strings in a text are ordinary text."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        byte_of = _byte_symbols()
        self.bytes_of = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for symbols, i in vocabulary.items():
            self.bytes_of[i] = bytes(map(byte_of.__getitem__, symbols))
        with open(path, encoding="utf-8") as lines:
            held = json.load(lines)
        steps = held["pre_tokenizer"] or {}
        plain = held["normalizer"] is None and steps.get("type") == "ByteLevel" and steps["use_regex"] and not steps["add_prefix_space"]
        # Where each token's own bytes merge to that token, merging any pair whose bytes are a token, least id first, takes
        # the same steps as the file's list of merges, if ids are in the order of the list: then the faster library serves.
        made = [vocabulary[left + right] for left, right in held["model"]["merges"]]
        alone = all(len(self.library.model.tokenize(s)) == 1 for s in vocabulary)
        self.fast = None
        if plain and alone and made == sorted(made):
            import tiktoken

            ranks = {b: i for i, b in enumerate(self.bytes_of) if b}
            self.fast = tiktoken.Encoding("file", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None:
            return [self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int64) for t in texts]
        return [np.array(e.ids, np.int64) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide:
    """Ids by a sentencepiece model with byte fallback; it sets a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        pieces = self.library.id_to_piece(list(range(size)))
        self.bytes_of = [bytes([int(p[1:-1], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.library.encode(texts, num_threads=1)]


class Aligned:
    """Tokens of a batch of texts, those of text i between a_at[i] and a_at[i + 1], and their groups, numbered through."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_size: np.ndarray, b_size: np.ndarray) -> None:
        self.a_at, self.b_at = (np.cumsum([0, *map(len, side)]) for side in (a, b))
        none = [np.zeros(0, np.int64)]
        self.a, self.b = np.concatenate(none + a), np.concatenate(none + b)
        a_end, b_end = np.cumsum(a_size[self.a]), np.cumsum(b_size[self.b])
        shared = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        self.n_groups = len(shared)
        self.in_a, self.in_b = (np.bincount(g, minlength=self.n_groups) for g in (self.a_group, self.b_group))
        # a text's last tokens end together, so no group crosses texts
        last = np.concatenate(([0], a_end))[self.a_at]
        self.group_at = np.searchsorted(shared, last, side="right")
        self.group_at[last == 0] = 0

    def groups_of(self) -> list[int]:
        return np.diff(self.group_at).tolist()

    def links_of(self) -> list[int]:
        total = np.concatenate(([0], np.cumsum(self.in_a * self.in_b)))
        return np.diff(total[self.group_at]).tolist()

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
        """(text, id of A, id of B, times or None for once): every linked pair of tokens."""
        text_of = np.repeat(np.arange(len(self.a_at) - 1), np.diff(self.a_at))
        b_start = np.concatenate(([0], np.cumsum(self.in_b)))
        wide = self.in_a * self.in_b > WIDE
        times = np.where(wide, 0, self.in_b)[self.a_group]
        left = np.repeat(np.arange(len(self.a)), times)
        nth = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        yield text_of[left], self.a[left], self.b[b_start[self.a_group[left]] + nth], None
        a_start = np.concatenate(([0], np.cumsum(self.in_a)))
        for g in np.flatnonzero(wide).tolist():
            text = text_of[a_start[g]]
            bs, b_times = np.unique(self.b[b_start[g] : b_start[g + 1]], return_counts=True)
            for token, k in zip(*np.unique(self.a[a_start[g] : a_start[g + 1]], return_counts=True), strict=True):
                yield np.full(len(bs), text), np.full(len(bs), token), bs, k * b_times

    def written(self, signs: _Signs) -> list[bytes]:
        """Each text's groups as decimal ids: `a1,a2|b1;a3|b2,b3`."""
        # a token stands after all tokens of earlier groups, and B's after A's
        order = np.zeros(len(self.a) + len(self.b), np.int64)
        before_a = np.concatenate(([0], np.cumsum(self.in_b)))[self.a_group]
        before_b = np.cumsum(self.in_a)[self.b_group] if self.n_groups else np.zeros(0, np.int64)
        a_last, b_last = (np.concatenate((np.diff(g), [1])[: 2 if len(g) else 0] or [np.zeros(0)]).astype(bool) for g in (self.a_group, self.b_group))
        order[np.arange(len(self.a)) + before_a] = 2 * self.a + a_last
        order[np.arange(len(self.b)) + before_b] = signs.from_b + 2 * self.b + b_last
        at = (self.a_at + self.b_at).tolist()
        look = signs.texts.__getitem__
        return [b"".join(map(look, order[i:j].tolist()))[:-1] for i, j in zip(at, at[1:], strict=False)]


class _Signs:
    """Each id as text with the sign behind it: within its side, or at its side's end."""

    def __init__(self, n_a: int, n_b: int) -> None:
        self.from_b = 2 * n_a
        self.texts = [b"%d%s" % (i, s) for i in range(n_a) for s in (b",", b"|")] + [b"%d%s" % (i, s) for i in range(n_b) for s in (b",", b";")]


class Aligner:
    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = BytesSide(a_path), PieceSide(b_path)
        self.a_size, self.b_size = (np.array(list(map(len, side.bytes_of)), np.int64) for side in (self.a, self.b))
        self.signs = _Signs(len(self.a_size), len(self.b_size))

    def __call__(self, texts: list[str]) -> Aligned:
        """Texts that either side does not give back have no tokens."""
        full = [" " + t if t else "" for t in texts]
        sides = [self.a.encode(full), self.b.encode(texts)]
        none = np.zeros(0, np.int64)
        for i, text in enumerate(full):
            want = text.encode("utf-8")
            if any(b"".join(map(side.bytes_of.__getitem__, ids[i].tolist())) != want for side, ids in zip((self.a, self.b), sides, strict=True)):
                for ids in sides:
                    ids[i] = none
        return Aligned(*sides, self.a_size, self.b_size)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, in as few bytes as the greatest needs, equal bytes together, as zstd."""
    width = next(w for w in (1, 2, 4, 8) if not numbers.size or w == 8 or int(numbers.max()) >> 8 * w == 0)
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}").astype(np.int64)


def _rises(numbers: np.ndarray) -> bytes:
    """Numbers that never fall, by their steps."""
    return packed(np.diff(numbers, prepend=0))


class _Memory:
    """The (pair, document) records of a run, and what its documents have by themselves."""

    def __init__(self, b_bits: int) -> None:
        self.b_bits, self.docs, self.n = b_bits, [], 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, rows: np.ndarray, a: np.ndarray, b: np.ndarray, times: np.ndarray | None) -> None:
        self.keys.append((a << self.b_bits | b) << 16 | rows)
        self.times.append(np.ones(len(rows), np.int64) if times is None else times)
        self.n += len(rows)

    def run(self) -> dict[str, bytes]:
        none = [np.zeros(0, np.int64)]
        keys, times = np.concatenate(none + self.keys), np.concatenate(none + self.times)
        self.keys, self.times = [], []
        if (times == 1).all():
            keys.sort()
            at = np.flatnonzero(np.diff(keys, prepend=-1))
            times = np.diff(at, append=len(keys))
        else:
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            at = np.flatnonzero(np.diff(keys, prepend=-1))
            times = np.add.reduceat(times, at) if len(at) else times
        keys = keys[at]
        pairs, rows = keys >> 16, keys & 0xFFFF
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        # a document's number within a pair, by its step from the one before
        steps = np.diff(rows, prepend=0)
        steps[first] = rows[first]
        whole = pa.concat_tables([pa.Table.from_batches([d]) for d in self.docs]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(whole)
        return {"pairs": _rises(pairs[first]), "holders": packed(np.diff(first, append=len(keys))), "rows": packed(steps), "times": packed(times),
                "docs": sink.getvalue().to_pybytes(), "entries": len(first)}


RUNS = "run long, entries long, pairs binary, holders binary, rows binary, times binary, docs binary"


def _spill(schema, a_path: str, b_path: str, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    align = aligner(a_path, b_path)
    b_bits = max(1, (len(align.b_size) - 1).bit_length())
    if max(1, (len(align.a_size) - 1).bit_length()) + b_bits > 46:
        raise ValueError("vocabularies too large for one number a pair and document")
    memory, number = _Memory(b_bits), TaskContext.get().partitionId() << 32

    def close() -> pa.RecordBatch:
        return record({"run": [number], **{k: [v] for k, v in memory.run().items()}}, schema)

    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            got = align([t.decode("utf-8", "replace") for t in octets_of(batch)])
            has = np.diff(got.a_at) > 0
            digests = [hashlib.sha256(w).digest() if h else None for w, h in zip(got.written(align.signs), has.tolist(), strict=True)]
            base = sum(d.num_rows for d in memory.docs)
            memory.docs.append(pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (np.diff(got.a_at), np.diff(got.b_at))), pa.array(got.groups_of(), pa.int64()),
                 pa.array(got.links_of(), pa.int64()), pa.array(digests, pa.binary())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "digest"]))
            for rows, a, b, times in got.links():
                memory.add(rows + base, a, b, times)
            if memory.n >= size or base + 2 * 256 > RUN_DOCS:
                yield close()
                memory, number = _Memory(b_bits), number + 1
    if memory.docs:
        yield close()


PIECES = "bucket int, run long, pairs binary, holders binary"


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """High bits of a mixed pair number, so that neither many pairs of one A id nor ids in order fill one bucket."""
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _ordered(pairs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs by bucket and within it as they were, where each bucket starts)."""
    bucket = _bucket(pairs, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _radix(schema, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run, pairs, holders in zip(*(batch.column(c).to_pylist() for c in ("run", "pairs", "holders")), strict=True):
            pairs, holders = np.cumsum(unpacked(pairs)), unpacked(holders)
            order, at = _ordered(pairs, buckets)
            some = np.flatnonzero(np.diff(at)).tolist()
            parts = [order[at[k] : at[k + 1]] for k in some]
            yield record({"bucket": some, "run": [run] * len(some), "pairs": [_rises(pairs[p]) for p in parts], "holders": [packed(holders[p]) for p in parts]}, schema)


def _entries(pairs: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """A run as (pair, count), some at a time."""
    for start in range(0, len(pairs), 1 << 15):
        yield from zip(pairs[start : start + (1 << 15)].tolist(), counts[start : start + (1 << 15)].tolist(), strict=True)


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """k-way heap merge of runs in order of pairs; counts of equal pairs are added."""
    pairs: list[int] = []
    counts: list[int] = []
    last = -1
    for pair, count in heapq.merge(*(_entries(*r) for r in runs)):
        if pair == last:
            counts[-1] += count
        else:
            pairs.append(pair)
            counts.append(count)
            last = pair
    return np.array(pairs, np.int64), np.array(counts, np.int64)


def _maxima(pairs: np.ndarray, counts: np.ndarray, b_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest count of each A id; pairs are in its order."""
    a = pairs >> b_bits
    at = np.flatnonzero(np.diff(a, prepend=-1))
    return a[at], np.maximum.reduceat(counts, at) if len(at) else counts


TOTALS = "bucket int, pairs binary, counts binary, ids binary, highest binary"


def _count(schema, b_bits: int, fan: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of each bucket; a bucket's pieces come one after another."""
    bucket, held = None, []

    def close() -> pa.RecordBatch:
        pairs, counts = merged(held)
        ids, highest = _maxima(pairs, counts, b_bits)
        return record({"bucket": [bucket], "pairs": [_rises(pairs)], "counts": [packed(counts)], "ids": [_rises(ids)], "highest": [packed(highest)]}, schema)

    for batch in batches:
        for here, pairs, holders in zip(*(batch.column(c).to_pylist() for c in ("bucket", "pairs", "holders")), strict=True):
            if bucket is not None and here != bucket:
                yield close()
                held = []
            bucket = here
            held.append((np.cumsum(unpacked(pairs)), unpacked(holders)))
            if len(held) >= fan:
                held = [merged(held)]
    if bucket is not None:
        yield close()


def _answer(schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece the totals of its pairs, in its order. A bucket's totals come before its pieces."""
    pairs = counts = None
    for batch in batches:
        out: dict[str, list] = {"bucket": [], "run": [], "counts": []}
        for here, run, some, holders in zip(*(batch.column(c).to_pylist() for c in ("bucket", "run", "pairs", "holders")), strict=True):
            if run < 0:
                pairs, counts = np.cumsum(unpacked(some)), unpacked(holders)
                continue
            out["bucket"].append(here)
            out["run"].append(run)
            out["counts"].append(packed(counts[np.searchsorted(pairs, np.cumsum(unpacked(some)))]))
        yield record(out, schema)


def _contribute(schema, buckets: int, b_bits: int, highest: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each run; its answers come before it, by bucket."""
    answers: list[bytes] = []
    for batch in batches:
        columns = [batch.column(c) for c in ("bucket", "counts", "pairs", "holders", "rows", "times", "docs")]
        for bucket, counts, *blobs in zip(*columns, strict=True):
            if bucket.as_py() < buckets:
                answers.append(counts.as_py())
                continue
            pairs, holders, steps, times = (unpacked(b.as_py()) for b in blobs[:4])
            pairs = np.cumsum(pairs)
            count = np.zeros(len(pairs), np.int64)
            if len(pairs):
                count[_ordered(pairs, buckets)[0]] = np.concatenate([unpacked(x) for x in answers])
            answers = []
            first = np.cumsum(holders) - holders
            # steps start anew with each pair
            rows = np.cumsum(steps)
            rows -= np.repeat(rows[first] - steps[first], holders) if len(first) else 0
            docs = pa.ipc.open_stream(blobs[4].as_py()).read_all()
            best = np.zeros(docs.num_rows, np.int64)
            total = np.zeros(docs.num_rows, np.int64)
            np.add.at(total, rows, times * np.repeat(count, holders))
            np.add.at(best, rows, times * np.repeat(count == highest[pairs >> b_bits], holders))
            digests = [b"" if d is None else d.hex() for d in docs["digest"].to_pylist()]
            sums = {"n_best": best, "count_sum": total, "groups_sha256": digests}
            for start in range(0, docs.num_rows, 8192):
                part = docs.slice(start, 8192).combine_chunks()
                own = {c: part[c].combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                yield record(own | {k: v[start : start + 8192] for k, v in sums.items()}, schema)


def _arrow(df: DataFrame, fn, ddl: str, *extra) -> DataFrame:
    return df.mapInArrow(Tidy(partial(fn, arrow_schema(ddl), *extra)), ddl)


def _dealt(df: DataFrame, key: Column | str, n: int, *order: str) -> DataFrame:
    return df.repartition(n, key).sortWithinPartitions(*order)


class PairCounts:
    """The runs of a corpus, saved, and the totals of its pairs: count once, then read pairs or documents.

    `run` is the links that a task holds before it spills, `fan` the pieces that one merge takes (at least 2).
    """

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, *, run: int = RUN, fan: int = FAN) -> None:
        self.spark = docs.sparkSession
        self.id_type = docs.schema["doc_id"].dataType.simpleString()
        align = aligner(a_path, b_path)
        self.n_a, self.b_bits = len(align.a_size), max(1, (len(align.b_size) - 1).bit_length())
        rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        self.runs = saved(_arrow(rows, _spill, RUNS, a_path, b_path, run), "pair-runs")
        entries, self.n_runs = self.runs.agg(F.coalesce(F.sum("entries"), F.lit(0)), F.count(F.lit(1))).first()
        self.buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), min(entries // BUCKET, 1 << 14))
        pieces = _dealt(self._pieces(), "bucket", self.buckets, "bucket", "run")
        self.totals = saved(_arrow(pieces, _count, TOTALS, self.b_bits, fan), "pair-totals")

    def _pieces(self) -> DataFrame:
        return _arrow(self.runs.select("run", "pairs", "holders"), _radix, PIECES, self.buckets)

    def highest(self) -> np.ndarray:
        """By A id its highest count, 0 for ids without pairs: one number for each id of the vocabulary."""
        ddl = "a long, highest long"

        def spread(schema, batches):
            for batch in batches:
                for ids, highest in zip(batch.column("ids").to_pylist(), batch.column("highest").to_pylist(), strict=True):
                    yield record({"a": np.cumsum(unpacked(ids)), "highest": unpacked(highest)}, schema)

        of = np.zeros(self.n_a, np.int64)
        for r in _arrow(self.totals.select("ids", "highest"), spread, ddl).groupBy("a").agg(F.max("highest").alias("highest")).collect():
            of[r["a"]] = r["highest"]
        return of

    def pairs(self) -> DataFrame:
        """a, b, documents: every linked pair of ids and in how many documents it is."""
        b_bits, ddl = self.b_bits, "a long, b long, documents long"

        def spread(schema, batches):
            for batch in batches:
                for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                    pairs = np.cumsum(unpacked(pairs))
                    yield record({"a": pairs >> b_bits, "b": pairs & ((1 << b_bits) - 1), "documents": unpacked(counts)}, schema)

        return _arrow(self.totals.select("pairs", "counts"), spread, ddl)

    def documents(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
        totals = self.totals.select("bucket", F.lit(-1).cast("long").alias("run"), "pairs", F.col("counts").alias("holders"))
        passing = _dealt(self._pieces().unionByName(totals), "bucket", self.buckets, "bucket", "run")
        answers = _arrow(passing, _answer, "bucket int, run long, counts binary")
        runs = self.runs.drop("entries").withColumn("bucket", F.lit(self.buckets))
        both = answers.unionByName(runs, allowMissingColumns=True)
        n = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.n_runs)
        ddl = f"doc_id {self.id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        return _arrow(_dealt(both, "run", min(n, 1 << 16), "run", "bucket"), _contribute, ddl, self.buckets, self.b_bits, self.highest())


def alignment_report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """What each document's links are, and how common over the whole corpus. The paths are files that every executor has."""
    return PairCounts(docs, a_path, b_path).documents()
