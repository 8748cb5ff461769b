"""Removal of long byte strings that occur earlier in the collection, by column-wise suffix sorting.

The rule: a byte goes when a string of `length` bytes that covers it also starts earlier, in a smaller document or
further left in the same one. Strings are judged on the input as it is.

Inserting one symbol of every document per round, as the multi-document construction does it, needs as many rounds
as the longest document has bytes. Only prefixes of `length` bytes are asked for here, so the collection is cut so
that the rounds are few and fixed, and every pair of equal strings still meets:

1. ``anchors``: of the 32-byte strings in every window of `length` bytes, the one with the least fingerprint (the
   leftmost of several) is its anchor. Equal windows have equal anchors at equal places.
2. Anchors are dealt by fingerprint; those that occur once are dropped.
3. Around each repeated anchor the bytes that any of its windows can reach are a segment; segments with one anchor are
   a group, lined up at it. Groups are small collections, and each is sorted on its own.
4. ``sort_columns``: from the last column to the first, each round inserts one symbol of every segment. The order of
   the suffixes follows from the order before it by a stable deal on the new symbol (the step of a Burrows-Wheeler
   transform), and the common prefixes of neighbours by the least one in between, plus one. Where the common prefix
   reaches `length`, suffixes are one class, and all but its first occurrence are marked.

Columns of a batch of groups are read in sorted order from Spark's shuffle files, so memory holds one batch. Equal
segments that meet in a task are merged before they are sent; groups beyond GROUP segments are sorted in parts and
their first occurrences compared by fingerprint. Whole copies of a document are settled first, by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm import octets
from millwatch.llm.store import KEY, Tidy, arrow_schema, id_key, keyed, map_arrow, octets_of, record, saved, small

LENGTH = 100
GRAM = 32
#: A longer text is searched in pieces of so many bytes that overlap by length - 1.
PIECE = 1 << 20
#: A group of more segments is sorted in parts of about this size.
GROUP = 8_000
#: Segments sorted together in one task; groups are not cut for it.
TOGETHER = 16_000
#: Sent from a batch of texts to the task of an anchor's fingerprint.
ANCHOR = np.dtype([("hash", "<u8"), ("id", "<i8"), ("at", "<u4"), ("known", "u1")])
SPAN = "id long, kind int, a int, b int"  # kind 1: an anchor at a; kind 2: windows from a to b have an earlier copy


def anchors(o: octets.Octets, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions in o.data of every window's anchor, each once, and their fingerprints."""
    data, reach = o.data, length - gram + 1
    last = len(data) - gram + 1
    if last < reach:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(last)
    key = octets.segment_hash(data, at, at + gram)
    bits = np.uint64(max(1, int(last).bit_length()))
    low = (key >> bits << bits) | at.astype(np.uint64)  # ties on the high bits go to the leftmost
    width = 1
    while 2 * width <= reach:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    if reach > width:
        low = np.minimum(low[: len(low) - (reach - width)], low[reach - width :])
    starts = np.arange(len(low))
    inside = starts + length <= o.ends[np.minimum(o.owner(starts), o.n - 1)]
    found = (low[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = found[np.r_[True, found[1:] != found[:-1]]] if len(found) else found
    return found, key[found]


def _union(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole-number intervals [a, b] of each id, joined where they touch."""
    if not len(ids):
        return ids, a, b
    order = np.lexsort((a, ids))
    ids, a, b = ids[order], a[order], b[order]
    span = np.int64(1) << 33
    rank = np.cumsum(np.r_[0, ids[1:] != ids[:-1]]) * span
    reach = np.maximum.accumulate(b + rank)
    new = np.r_[True, (a + rank)[1:] > reach[:-1] + 1]
    first = np.flatnonzero(new)
    return ids[first], a[first], (reach - rank)[np.r_[first[1:] - 1, len(ids) - 1]]


def _merge_equal(key: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, left: np.ndarray, order_by: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the first of those with equal anchor and equal segment, and which have such a first before them."""
    content = octets.mix(octets.segment_hash(data, starts, ends) + key + left.astype(np.uint64))
    order = np.lexsort((*order_by, content))
    first = np.zeros(len(key), bool)
    if len(key):
        first[order[np.r_[True, content[order][1:] != content[order][:-1]]]] = True
    return first, ~first


def _pieces(texts: list[bytes], length: int) -> tuple[list[bytes], list[int], list[int]]:
    parts, owner, offset = [], [], []
    for i, t in enumerate(texts):
        for start in range(0, max(1, len(t) - length + 1), PIECE - length + 1):
            parts.append(t[start : start + PIECE])
            owner.append(i)
            offset.append(start)
    return parts, owner, offset


def _segments(o: octets.Octets, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    own = o.owner(at)
    return np.maximum(o.starts[own], at - (length - gram)), np.minimum(o.ends[own], at + length)


def _send_anchors(batch: pa.RecordBatch, buckets: int, length: int, gram: int) -> dict:
    """Packed anchors by bucket; anchors that meet within the batch are known to repeat and go on at once."""
    out = {"bucket": [], "kind": [], "packed": []}
    texts, ids = octets_of(batch), batch.column("id").to_numpy(zero_copy_only=False)
    parts, owner, offset = _pieces(texts, length)
    owner, offset = np.array(owner, np.int64), np.array(offset, np.int64)
    for lo, hi in octets.batches(parts, PIECE):
        o = octets.Octets(parts[lo:hi])
        at, key = anchors(o, length, gram)
        if not len(at):
            continue
        own = o.owner(at)
        doc = ids[owner[lo:hi][own]]
        place = at - o.starts[own] + offset[lo:hi][own]
        _, back, many = np.unique(key, return_inverse=True, return_counts=True)
        local = many[back] > 1
        send = np.zeros(len(at), ANCHOR)
        send["hash"], send["id"], send["at"] = key, doc, place
        send["known"] = local
        # one mark per repeated fingerprint is enough for the others to know of it
        _, one = np.unique(key, return_index=True)
        keep = ~local
        keep[one] = True
        # a batch that cuts a text into pieces may see part of a segment only, so equal segments are merged later
        whole = np.bincount(owner, minlength=len(texts))[owner[lo:hi][own]] == 1
        starts, ends = _segments(o, at, length, gram)
        first, rest = _merge_equal(key, o.data, starts, ends, at - starts, (place, doc))
        rest &= whole
        spans = _union(doc[rest], (starts - at + place)[rest], (ends - at + place)[rest] - length)
        go = local & ~rest
        some = np.zeros(len(spans[0]) + int(go.sum()), _SPAN)
        some["id"] = np.r_[spans[0], doc[go]]
        some["a"], some["b"] = np.r_[spans[1], place[go]], np.r_[spans[2], np.zeros(int(go.sum()))]
        some["kind"] = np.r_[np.full(len(spans[0]), 2), np.full(int(go.sum()), 1)]
        out["bucket"].append(int(key[0] % np.uint64(buckets)))
        out["kind"].append(1)
        out["packed"].append(some.tobytes())
        send = send[keep]
        bucket = (send["hash"] >> np.uint64(40)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        send, bucket = send[order], bucket[order]
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, b in zip(cut, np.r_[cut[1:], len(send)], strict=True):
            out["bucket"].append(int(bucket[a]))
            out["kind"].append(0)
            out["packed"].append(send[a:b].tobytes())
    return out


_SPAN = np.dtype([("id", "<i8"), ("kind", "<i4"), ("a", "<i4"), ("b", "<i4")])


def _repeated(schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: anchors whose fingerprint another one of the bucket has."""

    def settle(packed: list[bytes]) -> dict:
        got = np.frombuffer(b"".join(packed), ANCHOR)
        _, back, many = np.unique(got["hash"], return_inverse=True, return_counts=True)
        got = got[(many[back] > 1) & (got["known"] == 0)]
        return {"id": got["id"], "kind": np.ones(len(got), np.int32), "a": got["at"].astype(np.int32), "b": np.zeros(len(got), np.int32)}

    now, packed = None, []
    for batch in batches:
        for bucket, kind, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "packed")), strict=True):
            if kind:
                got = np.frombuffer(data, _SPAN)
                yield record({c: got[c] for c in ("id", "kind", "a", "b")}, schema)
                continue
            if bucket != now and packed:
                yield record(settle(packed), schema)
                packed = []
            now = bucket
            packed.append(data)
    if packed:
        yield record(settle(packed), schema)


SEGMENT = "key long, id long, kind int, a int, b int, left int, bytes binary"


def _cut_segments(batch: pa.RecordBatch, length: int, gram: int) -> dict:
    """A row for each segment (a: place of its first byte, b: of its anchor), and spans already known."""
    out: dict[str, list] = {c: [] for c in ("key", "id", "kind", "a", "b", "left", "bytes")}
    texts, ids, places = octets_of(batch), batch.column("id").to_numpy(zero_copy_only=False), batch.column("places").to_pylist()
    for lo, hi in octets.batches(texts, PIECE):
        o = octets.Octets(texts[lo:hi])
        own = np.repeat(np.arange(hi - lo), [len(p) for p in places[lo:hi]])
        place = np.array([x for p in places[lo:hi] for x in p], np.int64)
        if not len(place):
            continue
        at, doc = o.starts[own] + place, ids[lo:hi][own]
        key = octets.segment_hash(o.data, at, at + gram)
        starts, ends = _segments(o, at, length, gram)
        first, rest = _merge_equal(key, o.data, starts, ends, at - starts, (place, doc))
        spans = _union(doc[rest], (starts - o.starts[own])[rest], (ends - o.starts[own])[rest] - length)
        raw = o.data.tobytes()
        n, k = int(first.sum()), len(spans[0])
        out["key"] += [key[first].view(np.int64), np.zeros(k, np.int64)]
        out["id"] += [doc[first], spans[0]]
        out["kind"] += [np.ones(n, np.int32), np.full(k, 2, np.int32)]
        out["a"] += [(starts - o.starts[own])[first], spans[1]]
        out["b"] += [place[first], spans[2]]
        out["left"] += [(at - starts)[first], np.zeros(k, np.int64)]
        out["bytes"] += [raw[a:b] for a, b in zip(starts[first], ends[first], strict=True)] + [None] * k
    return {c: v if c == "bytes" else (np.concatenate(v) if v else np.zeros(0, np.int64)) for c, v in out.items()}


def sort_columns(columns: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Column-wise suffix order of aligned segments, last column first: (column, order, common prefixes).

    columns[c, i] is the symbol of segment i in column c, 0 where it has none, else the byte plus one; `group` is
    ascending, and only segments of one group are compared. common[k] is the length of the prefix that suffix
    order[k] shares with order[k - 1], both starting in this column; 0 across groups.
    """
    n = len(group)
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    base = group.astype(np.int64) << 9
    for c in range(len(columns) - 1, -1, -1):
        symbol = columns[c][order]
        deal = base[order] + symbol
        if (deal[1:] >= deal[:-1]).all():
            turn = None
            same, near = deal[1:] == deal[:-1], common[1:n].copy()
        else:
            turn = np.argsort(deal, kind="stable")  # equal symbols keep their order: the step from rank to rank
            deal, symbol = deal[turn], symbol[turn]
            same = deal[1:] == deal[:-1]
            before, after = turn[:-1], turn[1:]
            near = common[after]
            apart = np.flatnonzero(same & (after != before + 1))
            if len(apart):
                ranges = np.column_stack([before[apart] + 1, after[apart] + 1]).ravel()
                near[apart] = np.minimum.reduceat(common, ranges)[::2]
            order = order[turn]
        common = np.zeros(n + 1, np.int32)
        common[1:n] = np.where(same & (symbol[1:] > 0), near + 1, 0)
        yield c, order, common[:n]


def _mark(rows: list[tuple], length: int, gram: int) -> tuple[dict, dict]:
    """Spans with an earlier copy, and for groups sorted in parts the first occurrence of every string."""
    key = np.array([r[0] for r in rows], np.int64)
    part = np.array([r[1] for r in rows], np.int64)
    ids, start, place, left = (np.array([r[k] for r in rows], np.int64) for k in (2, 3, 4, 5))
    n, reach = len(rows), length - gram
    group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
    width = length + reach
    columns = np.zeros((width, n), np.int16)
    sizes = np.array([len(r[6]) for r in rows], np.int64)
    data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    row = np.repeat(np.arange(n), sizes)
    inner = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    columns[inner + (reach - left)[row], row] = data.astype(np.int16) + 1
    rank = np.empty(n, np.int64)
    rank[np.lexsort((place, ids))] = np.arange(n)
    earlier = np.zeros((reach + 1, n), bool)
    heads: dict[str, list] = {c: [] for c in ("h1", "h2", "id", "a")}
    split = np.array([r[7] for r in rows], bool)
    lead, tail = reach - left, reach - left + sizes
    for c, order, common in sort_columns(columns, group):
        if c > reach:
            continue
        first = np.flatnonzero(common < length)
        least = np.minimum.reduceat(rank[order], first)
        mine = np.repeat(least, np.diff(np.r_[first, n]))
        earlier[c, order] = rank[order] > mine
        top = order[rank[order] == mine]
        top = top[split[top] & (c >= lead[top]) & (c + length <= tail[top])]
        if len(top):
            begin = (np.cumsum(sizes) - sizes)[top] + c - lead[top]
            h = octets.segment_hash(data, begin, begin + length)
            heads["h1"].append(h.view(np.int64))
            heads["h2"].append(octets.segment_hash(data ^ np.uint8(0x5A), begin, begin + length).view(np.int64))
            heads["id"].append(ids[top])
            heads["a"].append(start[top] + c - lead[top])
    mark_c, mark_i = np.nonzero(earlier)
    window = start[mark_i] + mark_c - lead[mark_i]
    spans = _union(ids[mark_i], window, window)
    return {"id": spans[0], "a": spans[1], "b": spans[2]}, {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in heads.items()}


MARK = "id long, a int, b int, h1 long, h2 long"


def _sort_groups(schema, length, gram, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def settle(rows: list[tuple]) -> pa.RecordBatch:
        spans, heads = _mark(rows, length, gram)
        k, m = len(spans["id"]), len(heads["id"])
        none = pa.nulls(k, pa.int64())
        return record({
            "id": np.r_[spans["id"], heads["id"]], "a": np.r_[spans["a"], heads["a"]], "b": np.r_[spans["b"], heads["a"]],
            "h1": pa.concat_arrays([none, pa.array(heads["h1"], pa.int64())]), "h2": pa.concat_arrays([none, pa.array(heads["h2"], pa.int64())]),
        }, schema) if k + m else record({c: [] for c in ("id", "a", "b", "h1", "h2")}, schema)

    rows: list[tuple] = []
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("key", "part", "id", "a", "b", "left", "bytes", "cut")), strict=True):
            if len(rows) >= TOGETHER and (r[0], r[1]) != rows[-1][:2]:
                yield settle(rows)
                rows = []
            rows.append(r)
    if rows:
        yield settle(rows)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(spans, copies) of `docs` (doc_id, text): id with the starts a to b of windows that have an earlier copy, and
    the ids of documents whose whole text is that of a smaller id. An id has one text (``dedup_spans`` sees to that)."""
    spark = docs.sparkSession
    texts = docs.select(id_key("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    digests = saved(texts.where(F.octet_length("text") >= length).select("id", F.sha2("text", 256).alias("digest")), "digests")
    twice = digests.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = saved(digests.join(twice.select("digest", "first"), "digest").where("id > first").select("id").distinct(), "copies")
    own = texts.where(F.octet_length("text") >= length).join(small(copies, 16), "id", "left_anti")

    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = map_arrow(own, _send_anchors, "bucket int, kind int, packed binary", buckets, length, gram)
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    first = saved(dealt.mapInArrow(Tidy(partial(_repeated, arrow_schema(SPAN))), SPAN), "anchors")

    places = first.where("kind = 1").groupBy("id").agg(F.sort_array(F.collect_set("a")).alias("places"))
    places = saved(places, "places")
    held = own.join(small(places.select("id"), 16), "id", "left_semi").dropDuplicates(["id"]).join(places, "id")
    segments = saved(map_arrow(held, _cut_segments, SEGMENT, length, gram, rows=1024), "segments")

    mine = segments.where("kind = 1")
    sizes = mine.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    sizes = saved(sizes, "sizes")
    grouped = mine.join(sizes, "key").withColumn("cut", F.col("k") > group)
    grouped = grouped.withColumn("part", F.when(F.col("cut"), F.pmod(F.xxhash64("id", "b"), F.ceil(F.col("k") / group))).otherwise(F.lit(0).cast("long")))
    lined = grouped.select("key", "part", "id", "a", "b", "left", "bytes", "cut").repartition("key", "part").sortWithinPartitions("key", "part")
    marks = saved(lined.mapInArrow(Tidy(partial(_sort_groups, arrow_schema(MARK), length, gram)), MARK), "marks")

    heads = marks.where("h1 is not null").select("h1", "h2", F.struct("id", "a").alias("at"))
    least = heads.groupBy("h1", "h2").agg(F.min("at").alias("least"))
    late = heads.join(least, ["h1", "h2"]).where("at > least").select("at.id", "at.a", F.col("at.a").alias("b"))
    spans = marks.where("h1 is null").select("id", "a", "b").unionByName(late)
    for known in (first, segments):
        spans = spans.unionByName(known.where("kind = 2").select("id", "a", "b"))
    return spans, copies


def _apply(batch: pa.RecordBatch, length: int, with_text: bool) -> dict:
    """Byte ranges to remove, and what is left."""
    out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "spans", "kept", "kept_text", "kept_sha256")}
    for text, spans, copy in zip(octets_of(batch), batch.column("spans").to_pylist(), batch.column("copy").to_pylist(), strict=True):
        if copy and len(text) >= length:
            cuts = [(0, len(text))]
        else:
            cuts, reach = [], -1
            for s in sorted((s["a"], s["b"] + length) for s in spans or ()):
                a, b = s[0], min(s[1], len(text))
                if cuts and a <= reach:
                    cuts[-1] = (cuts[-1][0], max(reach, b))
                else:
                    cuts.append((a, b))
                reach = max(reach, b)
            cuts = [(a, b) for a, b in cuts if a < b]
        left, at = [], 0
        for a, b in cuts:
            left.append(text[at:a])
            at = b
        kept = b"".join([*left, text[at:]])
        out["n_bytes"].append(len(text))
        out["n_removed"].append(len(text) - len(kept))
        out["spans"].append([{"start": a, "end": b} for a, b in cuts])
        out["kept"].append(kept if with_text else None)
        out["kept_text"].append(kept.decode("utf-8", "ignore") if with_text else None)
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
    return {"row": batch.column("row"), **out}


RESULT = "n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary, kept_text string, kept_sha256 string"


def dedup_spans(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """All columns of `docs`, in `row`, with n_bytes, n_removed, spans (byte ranges removed), kept, kept_sha256, and
    kept_text: what is left as text, without the stumps of characters that a cut went through. `with_text=False` leaves
    out the other columns and what is kept.

    Null text is empty. Null ids are before all others. Rows repeated whole are one document and not copies of each
    other; different texts of one id are documents of their own, in the order of their digests. A text shorter than `length` keeps all. Other columns, whatever their names, are carried and not looked at.
    """
    marked, _ = keyed(docs)
    spans, copies = repeated_spans(marked.select(F.col(KEY).alias("doc_id"), "text"), length)
    by_doc = spans.groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    found = saved(by_doc.join(copies.withColumn("copy", F.lit(True)), "id", "full_outer"), "found")
    names = docs.columns if with_text else ["doc_id"]
    rows = marked.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(KEY).alias("id"), F.col("text").cast("binary").alias("text"))
    ids = small(found.select("id"), 16)
    hit = rows.join(ids, "id", "left_semi").join(found, "id")
    clear = rows.join(ids, "id", "left_anti").withColumn("spans", F.lit(None).cast(found.schema["spans"].dataType)).withColumn("copy", F.lit(None).cast("boolean"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, {RESULT}"
    return map_arrow(hit.unionByName(clear).drop("id"), _apply, schema, length, with_text, rows=1024)


def dedup_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    out = dedup_spans(docs, length, with_text=False)
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")

