"""A corpus from raw documents to token ids: five stages, each written as Parquet and read again by the next one.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm import bpe, decontaminate, near_dup, outliers, suffix_dedup
from millwatch.llm.queries import pretoken_pattern, vocabulary
from millwatch.llm.store import saved, short_batches, table


def _stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage under the session's setting for batches of documents."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        short_batches(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers for their language and source."""
    return outliers.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more, the least id stays."""
    return near_dup.drop_near_duplicates(docs, width=5, percent=80)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 100 or more that occur earlier; texts of which nothing is left go.

    Where a cut goes through a character, what is left of it is dropped.
    """
    out = suffix_dedup.dedup_spans(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    return out.where("n_removed = 0 or n_removed < n_bytes").select(*decontaminate.rewritten(docs, text))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows; texts that are mostly such words go as a whole."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the bytes that they decode to."""
    return bpe.token_report(docs, vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern())


STAGES = [
    ("quality rules", _stage(quality_rules)),
    ("MinHash near-dedup", _stage(near_duplicates)),
    ("suffix-array dedup", _stage(suffix_dedup_stage)),
    ("benchmark decontamination", _stage(decontamination)),
    ("byte-level BPE", _stage(byte_bpe)),
]

#: SQL has no robust covariance estimate and no byte-pair merges; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
