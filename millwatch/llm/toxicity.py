"""Toxicity of texts: words are restored by a noisy channel, then scored with a lexicon learned from labels.

1. The character model's trigrams are counted over the whole corpus, combined in each task before they are sent.
2. Features of a document are its distinct words, as written and as restored, and their first 4 to 8 letters. Of
   about LABELLED labelled documents, chosen by hash, the features of the toxic ones are counted; those that are
   rare elsewhere are picked one by one, each for the toxic documents that no earlier one explains, or because it is in
   many. A rare word that only happens to stand beside a toxic one explains nothing more, and is left out. Documents
   are counted by the least few of their features, so a family of near copies counts about once.
3. A feature's weight is its share of toxic documents; a score is the chance that at least one feature is a true sign.

Scoring is one pass in which no rows move. Labels, language, source and id are never part of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.deobfuscate import CharacterModel, readings, spaced, trigram_codes
from millwatch.llm.store import arrow_schema, map_arrow, octets_of, record, saved, small

#: Labelled documents that the lexicon is learned from, about, and the bytes of a text to be one of them.
LABELLED = 24_000
LABELLED_BYTES = 1 << 18
#: A feature needs so many toxic documents, this share of toxic among all, and so many that it alone explains.
LEAST_TOXIC, LEAST_SHARE, LEAST_NEW = 3, 0.75, 3
#: One in so large a share of toxic documents, and nearly nowhere else, is a sign whatever else explains them.
FREQUENT = 0.03
PREFIXES = (4, 5, 6, 7, 8)
#: Documents with so many least features in common count as one.
FAMILY = 4
#: Tokens that a worker remembers, in two generations.
REMEMBERED = 300_000
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _trigrams(schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, int] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            text = "\n".join(t.decode("utf-8", "replace") for t in octets_of(batch.slice(start, 256)))
            codes, counts = np.unique(trigram_codes(text), return_counts=True)
            for code, k in zip(codes.tolist(), counts.tolist(), strict=True):
                seen[code] = seen.get(code, 0) + k
    yield record({"code": list(seen), "k": list(seen.values())}, schema)


def character_model(docs: DataFrame) -> CharacterModel:
    """Of all texts. One row per kind of letter triple, a number that the alphabet bounds, reaches the driver."""
    texts = docs.where("text is not null").select(F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(partial(_trigrams, arrow_schema("code long, k long")), "code long, k long")
    rows = counted.groupBy("code").agg(F.sum("k").alias("k")).collect()
    return CharacterModel(np.array([r["code"] for r in rows], np.int64), np.array([r["k"] for r in rows], np.float64))


def _feature(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def features(token: str, model: CharacterModel) -> tuple[int, ...]:
    out = set()
    for word in readings(token, model):
        out.add(_feature(word))
        out.update(_feature(f"{word[:k]}-") for k in PREFIXES if len(word) >= k)
    return tuple(out)


class _Memory(dict):
    def __init__(self, make) -> None:
        self.make = make
        self.older: dict = {}

    def __missing__(self, token: str):
        found = self.older.get(token)
        if found is None:
            found = self.make(token)
        if len(token) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[token] = found
        return found


def tokens(text: str) -> set[str]:
    return set(text.split()).union(spaced(text))


def _features(batch: pa.RecordBatch, shared) -> dict:
    memory = _Memory(lambda t: features(t, shared.value))
    out, family = [], []
    for t in octets_of(batch):
        found: set[int] = set()
        for token in tokens(t.decode("utf-8", "replace")):
            found.update(memory[token])
        out.append(list(found))
        family.append(_feature(",".join(map(str, sorted(found)[:FAMILY]))))
    return {"family": family, "toxic": batch.column("toxic"), "features": out}


class Lexicon:
    """Weights (chance that a document with the feature is toxic) and the chance of one without any."""

    def __init__(self, model: CharacterModel, weights: dict[int, float], rest: float) -> None:
        self.model, self.weights, self.rest = model, weights, rest

    def cost(self, token: str) -> float:
        """Negative log chance that no feature of the token is a true sign."""
        found = [w for f in features(token, self.model) if (w := self.weights.get(f))]
        return -float(np.log1p(-max(found))) if found else 0.0


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Lexicon:
    """From `docs` (doc_id, text) and the rows of `labels` (doc_id, toxic) outside of the held-out fold."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(character_model(docs))
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = saved(known, "labels")
    part = min(1 << 20, -(-labelled * (1 << 20) // max(1, known.count())))
    some = saved(known.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < part), "chosen")
    texts = docs.where(F.octet_length("text") <= LABELLED_BYTES).join(small(some, 24), "doc_id").select(F.col("doc_id").alias("id"), "toxic", F.col("text").cast("binary").alias("text"))
    rows = saved(map_arrow(texts, _features, "family long, toxic int, features array<long>", shared, rows=512), "features")
    toxic = rows.where("toxic = 1").select("family", F.explode("features").alias("f")).distinct()
    often = saved(toxic.groupBy("f").agg(F.count("*").alias("t")).where(F.col("t") >= LEAST_TOXIC), "often")
    other = rows.where("toxic = 0").select("family", F.explode("features").alias("f")).distinct().join(small(often, 24), "f", "left_semi").groupBy("f").agg(F.count("*").alias("o"))
    sign = often.join(other, "f", "left").select("f", "t", F.coalesce("o", F.lit(0)).alias("o")).where(F.col("t") >= LEAST_SHARE * (F.col("t") + F.col("o")))
    sign = saved(sign, "signs")
    # both bounded by the sample of labelled documents
    pairs = toxic.join(small(sign, 24), "f").groupBy("f").agg(F.collect_list("family").alias("ids"), F.first("o").alias("o")).collect()
    totals = {r["toxic"]: r["k"] for r in rows.groupBy("toxic").agg(F.countDistinct("family").alias("k")).collect()}
    holders = {r["f"]: set(r["ids"]) for r in pairs}
    elsewhere = {r["f"]: r["o"] for r in pairs}
    weights: dict[int, float] = {}
    unexplained = set().union(*holders.values()) if holders else set()
    total = totals.get(1, 0)
    turn = sorted(holders, key=lambda f: (-len(holders[f]) + 2 * elsewhere[f], f))
    for f in turn:
        frequent = len(holders[f]) >= FREQUENT * total and elsewhere[f] <= len(holders[f]) / 50
        new = len(holders[f] & unexplained)
        if frequent or (new >= LEAST_NEW and new >= LEAST_SHARE * (new + elsewhere[f])):
            weights[f] = (len(holders[f]) + 0.2) / (len(holders[f]) + elsewhere[f] + 0.4)
            unexplained -= holders[f]
    covered = set().union(*(holders[f] for f in weights)) if weights else set()
    left = max(0, totals.get(1, 0) - len(covered))
    rest = (left + 0.5) / (left + totals.get(0, 0) + 5)
    return Lexicon(shared.value, weights, min(0.49, rest))


def _score(schema, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lexicon = shared.value
    memory = _Memory(lexicon.cost)
    base = -float(np.log1p(-lexicon.rest))
    for batch in batches:
        scores = []
        for t in octets_of(batch):
            cost = base + sum(map(memory.__getitem__, tokens(t.decode("utf-8", "replace")))) if t else base
            scores.append(min(1.0, -float(np.expm1(-cost))))
        yield record({"row": batch.column("row"), "score": scores}, schema)


def score_texts(docs: DataFrame, lexicon: Lexicon, keep: list[str] | None = None) -> DataFrame:
    """`row` (columns `keep` of `docs`) and score. Null and empty texts have the chance of one without signs."""
    from pyspark.sql.types import StructType

    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("binary").alias("text"))
    schema = StructType.fromDDL(f"row {rows.schema['row'].dataType.simpleString()}, score double")
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    return rows.mapInArrow(partial(_score, arrow_schema(schema), shared), schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5) of every row of `docs`."""
    out = score_texts(docs, learn(docs, labels), ["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
