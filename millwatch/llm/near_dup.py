"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find grouping.

Two documents are linked when their sets of word shingles have a Jaccard similarity of at least `percent` / 100, and
a group is what links connect. The steps, none of which gathers a group in one place or lists its pairs:

1. ``sketch``: one pass over the texts gives each document's set size, fingerprint of the set, signature and bands.
   Documents with equal sets form a class, and only the class's least id goes on.
2. A bucket is the documents with one band in common. Buckets are sorted over all partitions by (band, next band, id);
   each document is compared with its neighbour, and its best estimates are verified on the full sets.
3. Verified links are joined to components (large-star and small-star rounds on tables).
4. What is still apart in a bucket is verified in whole: members of a bucket outside its largest component are
   taken to blocks of at most BLOCK documents and compared with every document there on full sets. Only links that
   join two components leave a task. So a bucket's pairs are all decided, by fewer comparisons than there are pairs.

With 32 bands of 5 slots a pair of similarity 0.8 shares no band, and so is missed, with a chance of 3 in a million;
pairs of equal sets are never missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm import octets
from millwatch.llm.components import components
from millwatch.llm.store import KEY, NO_ID, Tidy, arrow_schema, id_key, keyed, map_arrow, octets_of, record, saved, small
from millwatch.llm.superminhash import SLOTS, bands, signatures

BAND_ROWS = 5
#: Documents of one block in the last step; at most so many sets are in a task's memory at once.
BLOCK = 512
#: Neighbours of a document that are verified in the first step, the best by estimate. What they leave is for step 4.
NEIGHBOURS = 3
#: Estimates below this are not tried in the first step.
PROMISING = 0.70

SKETCH = "id long, n_shingles long, c1 long, c2 long, bands array<long>, sig binary"


def word_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle fingerprints and their text's number: lower-case A-Z, words are runs without ASCII white space."""
    o = octets.Octets(texts)
    data = octets.lower_ascii(o.data)
    starts, ends = o.runs(octets.word_mask()[data])
    return octets.shingles(octets.content_hash(data, starts, ends), o.owner(starts), o.n, width)


def _sketch(batch: pa.RecordBatch, width: int, slots: int, rows: int) -> dict:
    texts, out = octets_of(batch), {k: [] for k in ("n", "c1", "c2", "bands", "sig")}
    for a, b in octets.batches(texts):
        values, owner = word_sets(texts[a:b], width)
        n = octets.counts(owner, b - a)
        first = np.minimum(np.cumsum(n) - n, max(0, len(values) - 1))
        for name, salt in (("c1", 1), ("c2", 2)):
            sums = np.add.reduceat(octets.mix(values + np.uint64(salt)), first) if len(values) else np.zeros(b - a, np.uint64)
            out[name].append(np.where(n > 0, sums, np.uint64(0)).view(np.int64))
        sig = signatures(values, owner, b - a, slots)
        out["n"].append(n)
        out["bands"].extend(x if k else None for x, k in zip(bands(sig, rows).view(np.int64), n, strict=True))
        short = octets.mix(sig).astype(np.uint8)  # a byte of each slot is enough to estimate
        out["sig"].extend(x.tobytes() if k else None for x, k in zip(short, n, strict=True))
    joined = {k: np.concatenate(out[k]) if out[k] else np.zeros(0, np.int64) for k in ("n", "c1", "c2")}
    return {"id": batch.column("id"), "n_shingles": joined["n"], "c1": joined["c1"], "c2": joined["c2"], "bands": out["bands"], "sig": out["sig"]}


def sketch(docs: DataFrame, width: int, slots: int = SLOTS, rows: int = BAND_ROWS) -> DataFrame:
    """One row per document: id (NO_ID for null), set size, two set fingerprints, bands, and a byte of each slot."""
    texts = docs.select(id_key("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    return map_arrow(texts, _sketch, SKETCH, width, slots, rows)


def _sets(batch: pa.RecordBatch, width: int) -> dict:
    texts, sets = octets_of(batch), []
    for a, b in octets.batches(texts):
        values, owner = word_sets(texts[a:b], width)
        sets += [x.tobytes() for x in np.split(values, np.cumsum(octets.counts(owner, b - a))[:-1])]
    return {"id": batch.column("id"), "set": sets}


def _chain(schema, slots, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (band, next band, id): a pair of each row and the one before it in its bucket, with estimate."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "id"))
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(len(ids), slots)
        if last is not None:
            key, ids, sig = np.r_[last[0], key], np.r_[last[1], ids], np.concatenate([last[2], sig])
        alike = (sig[1:] == sig[:-1]).mean(axis=1)
        pair = (key[1:] == key[:-1]) & (ids[1:] != ids[:-1])
        here = pair & (alike >= PROMISING)
        a, b = np.minimum(ids[1:], ids[:-1])[here], np.maximum(ids[1:], ids[:-1])[here]
        yield record({"a": a, "b": b, "alike": alike[here]}, schema)
        last = key[-1:], ids[-1:], sig[-1:]


def _verify_pairs(batch: pa.RecordBatch, percent: int) -> dict:
    """Pairs whose full sets reach the similarity."""
    a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("set_a", "set_b"))
    good = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        both = len(np.intersect1d(x, y, assume_unique=True))
        good[i] = 100 * both >= percent * (len(x) + len(y) - both)
    mask = pa.array(good)
    return {"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)}


class _Block:
    """The documents of a block by shingle, against which a set is counted at once."""

    def __init__(self, members: list[tuple[int, int, bytes]]) -> None:
        self.ids = np.array([m[0] for m in members], np.int64)
        self.comps = np.array([m[1] for m in members], np.int64)
        sets = [np.frombuffer(m[2], np.uint64) for m in members]
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def links(self, comp: int, data: bytes, percent: int) -> np.ndarray:
        """One linked document of each other component."""
        own = np.frombuffer(data, np.uint64)
        low, high = np.searchsorted(self.values, own), np.searchsorted(self.values, own, side="right")
        size = high - low
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        both = octets.counts(self.owner[at], len(self.ids))
        good = (100 * both >= percent * (len(own) + self.sizes - both)) & (self.comps != comp)
        _, one = np.unique(self.comps[good], return_index=True)
        return self.ids[good][one]


def _verify_blocks(schema, percent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (home, block, guest): the members of a block, then its guests, one at a time."""
    now, members, block = None, [], None
    for batch in batches:
        a, b = [], []
        for home, number, guest, i, comp, data in zip(*(batch.column(c).to_pylist() for c in ("home", "block", "guest", "id", "comp", "set")), strict=True):
            if (home, number) != now:
                now, members, block = (home, number), [], None
            if not guest:
                members.append((i, comp, data))
                continue
            block = block or _Block(members)
            found = block.links(comp, data, percent)
            a += [i] * len(found)
            b += found.tolist()
        yield record({"a": a, "b": b}, schema)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, slots: int = SLOTS, rows: int = BAND_ROWS, block: int = BLOCK) -> DataFrame:
    """id, n_shingles, component (the least id reachable) and kept of each row of `docs` (doc_id, text).

    Null or word-less texts have an empty set and stand alone; fewer words than `width` are one shingle. Rows repeated
    whole are one document; different texts of one doc_id are documents of their own, and of a group with several texts
    of its least id, one is kept. Null ids are NO_ID here, before all others. Other columns of `docs` are not looked at.
    An empty table gives an empty result.
    """
    marked, keys = keyed(docs)
    out = _groups(marked, keys is not None, width, percent, slots, rows, block).withColumn("kept", F.expr("key = group"))
    if keys is None:
        return out.select(F.col("key").alias("id"), "n_shingles", F.col("group").alias("component"), "kept")
    keys = small(keys, 16)
    own, first = (keys.select(F.col(KEY).alias(c), F.col("doc").alias(name)) for c, name in (("key", "id"), ("group", "component")))
    return out.join(own, "key").join(first, "group").select("id", "n_shingles", "component", "kept")


def _groups(marked: DataFrame, repeated: bool, width: int, percent: int, slots: int = SLOTS, rows: int = BAND_ROWS, block: int = BLOCK) -> DataFrame:
    """key, n_shingles and group (the least key reachable) of each row of a table with KEY, on which rows may be `repeated`."""
    docs = marked.select(F.col(KEY).alias("doc_id"), "text")
    marks = saved(sketch(docs, width, slots, rows), "sketch")
    classes = saved(marks.where("n_shingles > 0").groupBy("c1", "c2", "n_shingles").agg(F.min("id").alias("rep")), "classes")
    reps = marks.join(classes.select(F.col("rep").alias("id"), "c1", "c2", "n_shingles"), ["id", "c1", "c2", "n_shingles"]).dropDuplicates(["id", "c1", "c2"])
    n_bands = slots // rows
    # a document has a row per band here, so its signature is left out; it joins those that go on
    banded = reps.select("id", F.posexplode("bands").alias("band", "key"), (F.col("bands")[(F.col("band") + 1) % n_bands]).alias("tie"))
    # only buckets of two or more go on; the count combines before the shuffle
    crowded = reps.select(F.explode("bands").alias("key")).groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    rows_in = saved(banded.join(crowded, "key").select("key", "tie", "id"), "buckets")
    ids = small(saved(rows_in.select("id").distinct(), "ids"), 40)
    texts = docs.select(id_key("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    sets = map_arrow(texts.join(ids, "id", "left_semi"), _sets, "id long, set binary", width)
    sets = saved(sets.groupBy("id").agg(F.max("set").alias("set")) if repeated else sets, "sets")

    pair = "a long, b long, alike double"
    sigs = marks.join(ids, "id", "left_semi").select("id", "sig")
    signed = rows_in.join(sigs.dropDuplicates(["id"]) if repeated else sigs, "id").select("key", "tie", "id", "sig")
    chained = signed.repartitionByRange("key", "tie", "id").sortWithinPartitions("key", "tie", "id").mapInArrow(Tidy(partial(_chain, arrow_schema(pair), slots)), pair)
    tried = chained.groupBy("a", "b").agg(F.max("alike").alias("alike"))
    best = tried.groupBy("b").agg(F.slice(F.sort_array(F.collect_list(F.struct("alike", "a")), asc=False), 1, NEIGHBOURS).alias("best"))
    pairs = best.select("b", F.explode("best.a").alias("a"))
    of = lambda c: sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}"))
    links = saved(map_arrow(pairs.join(of("a"), "a").join(of("b"), "b"), _verify_pairs, "a long, b long", percent, rows=1024), "links")

    found = components(links)
    comp = F.coalesce("component", "id")
    placed = rows_in.select("key", "id").join(found, "id", "left").select("key", "id", comp.alias("comp"))
    placed = saved(placed, "placed")
    by_comp = placed.groupBy("key", "comp").agg(F.count("*").alias("k"))
    split = by_comp.groupBy("key").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.min("comp").alias("low"), F.count("*").alias("parts")).where("parts > 1")
    open_rows = saved(placed.join(split, "key").select("key", "id", "comp", "main", "low"), "open")
    homes = open_rows.groupBy("id", "comp").agg(F.min("low").alias("home"))
    blocks = homes.groupBy("home").agg(F.ceil(F.count("*") / block).alias("parts"))
    homes = saved(homes.join(blocks, "home").select("id", "comp", "home", F.pmod(F.xxhash64("id"), "parts").alias("block")), "homes")
    at = open_rows.join(homes.select("id", "home", "block"), "id").select("key", "home", "block").distinct()
    guests = open_rows.where("comp <> main").select("key", "id", "comp")
    visits = guests.join(at, "key").select("id", "comp", "home", "block", F.lit(1).alias("guest")).distinct()
    members = homes.join(visits.select("home", "block").distinct(), ["home", "block"], "left_semi").select("id", "comp", "home", "block", F.lit(0).alias("guest"))
    work = members.unionByName(visits).join(sets, "id").repartition("home", "block").sortWithinPartitions("home", "block", "guest", "id")
    more = work.mapInArrow(Tidy(partial(_verify_blocks, arrow_schema("a long, b long"), percent)), "a long, b long")
    more = saved(more, "links")

    all_links = found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)
    groups = components(all_links).withColumnRenamed("id", "rep")
    named = classes.join(groups, "rep", "left").select("c1", "c2", "n_shingles", F.coalesce("component", "rep").alias("group"))
    out = marks.join(named, ["c1", "c2", "n_shingles"], "left")
    return out.select(F.col("id").alias("key"), "n_shingles", F.coalesce("group", "id").alias("group"))


def near_dup_report(docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept. One document of a group, that with the least id, is kept."""
    out = near_duplicates(docs, width, percent)
    real = F.when(F.col("component") != NO_ID, F.col("component"))
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_shingles", real.alias("component_id"), "kept")


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose document is kept, all columns as they were; of repeated rows one stays.

    Rows without words stand alone, so of those only rows equal in every column are repeated.
    """
    marked, keys = keyed(docs)
    kept = _groups(marked, keys is not None, width, percent).where("key = group").select(F.col("key").alias(KEY), (F.col("n_shingles") > 0).alias("__words")).distinct()
    rows = marked.join(small(saved(kept, "kept"), 40), KEY)
    if keys is not None:
        whole = F.when(~F.col("__words"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
        rows = rows.withColumn("__row", whole).dropDuplicates([KEY, "__row"])
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
