"""Counts and rates over readings, dead letters, alerts and offsets. All combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def dlq_counts(letters: DataFrame, by: str | Sequence[str]) -> DataFrame:
    keys = [by] if isinstance(by, str) else list(by)
    return letters.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def dlq_rate(rows: DataFrame, size: str = "5 minutes", limit: float = 0.01) -> DataFrame:
    """Windows in which more than ``limit`` of all rows are dead letters.

    ``rows`` are all parsed messages, with ``arrival_time`` and ``error_type``. (s)
    """
    return (
        rows.groupBy(F.window("arrival_time", size).alias("w"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("error_type").isNotNull()).alias("dlq"))
        .select(F.col("w.start").alias("window_start"), "total", "dlq",
                (F.col("dlq") / F.col("total")).alias("dlq_rate"))
        .where(F.col("dlq_rate") > limit)
    )


def repeat_errors(letters: DataFrame, n: int) -> DataFrame:
    """The same error at least n times from one device."""
    return dlq_counts(letters, ["device_id", "error_type"]).where(F.col("n") >= n)


#: Percent by name, and slices of a group's values in which ranks are looked up.
PERCENTS = {"p50": 50, "p95": 95, "p99": 99}
SLICES = 256


def latency_sketch(df: DataFrame, column: str = "latency_ms", by: Sequence[str] = (),
                   accuracy: int = 1_000_000) -> DataFrame:
    """p50, p95 and p99 from mergeable sketches: rank error at most rows/accuracy, so exact below it."""
    q = F.percentile_approx(column, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), accuracy)
    return df.groupBy(*by).agg(q.alias("_q"), F.count(column).alias("n")).select(
        *by, "n", *[F.col("_q")[i].alias(p) for i, p in enumerate(("p50", "p95", "p99"))])


def latency_percentiles(df: DataFrame, column: str = "latency_ms", by: Sequence[str] = ()) -> DataFrame:
    """Exact p50, p95 and p99 (the value of rank ceil(n * p)) of the values that are not null, and their number n.

    Equal values are counted before the shuffle. A group is cut into about SLICES slices by value; running counts of
    the slices tell which one has a rank, and only that one's values are counted through, so no group is in one task.
    """
    counts = df.groupBy(*by, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
    totals = counts.groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_k"))), F.lit(0)).alias("n"))
    counts = counts.where(F.col("_v").isNotNull())
    # edges only cut; ranks do not depend on where
    cuts = F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)])
    edges = counts.groupBy(*by).agg(F.percentile_approx("_v", cuts, 10_000).alias("_edges"))
    sliced = _same_group(counts, edges, by).select(
        *by, "_v", "_k", F.size(F.filter("_edges", lambda e: e < F.col("_v"))).alias("_s"))
    ends = Window.partitionBy(*by).orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    slices = sliced.groupBy(*by, "_s").agg(F.sum("_k").alias("_m")).withColumn("_end", F.sum("_m").over(ends))
    percents = F.explode(F.array(*[F.lit(p) for p in PERCENTS.values()])).alias("_p")
    ranks = totals.select(*by, "n", percents).selectExpr("*", "(n * _p + 99) div 100 as _rank")
    wanted = _same_group(slices, ranks, by).where("_rank > _end - _m and _rank <= _end").select(
        *by, "_s", "_p", F.expr("_rank - _end + _m").alias("_rank"))
    near = _same_group(sliced, wanted.select(*by, "_s").distinct(), [*by, "_s"])
    run = Window.partitionBy(*by, "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    read = _same_group(near.withColumn("_run", F.sum("_k").over(run)), wanted, [*by, "_s"]).where(
        "_rank > _run - _k and _rank <= _run")
    values = read.groupBy(*by).agg(*[F.max(F.when(F.col("_p") == p, F.col("_v"))).alias(name) for name, p in PERCENTS.items()])
    return _same_group(totals, values, by, "left").select(*by, "n", *PERCENTS)


def _same_group(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Joined where all of `by` are equal or both null."""
    right = right.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return left.join(right, reduce(and_, same, F.lit(True)), how).drop(*[f"_of_{c}" for c in by])


def lag(offsets: DataFrame) -> DataFrame:
    """Messages not yet committed per topic and partition: ``offset`` ends, ``committed`` read so far."""
    ends = offsets.groupBy("topic", "partition").agg(
        F.max("offset").alias("end_offset"), F.max("committed").alias("committed"))
    return ends.withColumn("lag", F.col("end_offset") - F.coalesce("committed", F.lit(-1)))


def counters(df: DataFrame, **conditions: Column | str) -> DataFrame:
    """Named counts in one pass: ``counters(df, trimmed="disposition like 'TRIMMED%'")``."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in conditions.items()])


def observed(df: DataFrame, name: str, **conditions: Column | str) -> DataFrame:
    """The same counts taken while the rows pass; they arrive with each progress report. (s)"""
    return df.observe(name, F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in conditions.items()])


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("status", "fault_code").agg(F.count(F.lit(1)).alias("n"))


def top_devices(df: DataFrame, n: int, key: str = "device_id") -> DataFrame:
    """The n devices with the most rows; ties go by id."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(key)).limit(n)
