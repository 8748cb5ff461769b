"""Machine KPIs: utilization, throughput and overall equipment effectiveness.

The formulas are this library's; every one is documented where it is computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.operators.ordered import Cuts, Timeline, previous, scan


def durations(df: DataFrame, key: str = "machine_id", *, cuts: Cuts | None = None) -> DataFrame:
    """Add ``held_ms``: how long a reading's state lasted, until the machine's next reading."""
    order = ["timestamp", *(["seq"] if "seq" in df.columns else [])]
    line = Timeline.of(df, [key], order, cuts=cuts, descending=True)
    return scan(df, line, {"_next": previous(["timestamp"])}).withColumn(
        "held_ms", F.coalesce(F.col("_next.timestamp") - F.col("timestamp"), F.lit(0))).drop("_next")


def utilization(df: DataFrame, key: str = "machine_id", *, cuts: Cuts | None = None) -> DataFrame:
    """Time in status ``running`` over all observed time, per machine."""
    held = durations(df.select(key, "timestamp", "status", *(["seq"] if "seq" in df.columns else [])), key,
                     cuts=cuts)
    running = F.sum(F.when(F.col("status") == "running", F.col("held_ms")).otherwise(0))
    return held.groupBy(key).agg(running.alias("running_ms"), F.sum("held_ms").alias("total_ms")).withColumn(
        "utilization", F.try_divide(F.col("running_ms").cast("double"), F.col("total_ms").cast("double")))


def throughput(runs: DataFrame, size: str = "1 day", key: str = "device_id") -> DataFrame:
    """Runs that ended by a trackout, per machine and window of their end."""
    ended = runs.where(F.col("closed_by") == "trackout").withColumn("_at", F.timestamp_millis("end_ts"))
    return (
        ended.groupBy(key, F.window("_at", size).alias("w")).agg(F.count(F.lit(1)).alias("runs"))
        .select(key, F.col("w.start").alias("window_start"), "runs")
    )


def oee(evaluated: DataFrame, ideal_per_hour: float, key: str = "machine_id", *,
        cuts: Cuts | None = None) -> DataFrame:
    """availability * performance * quality per machine.

    availability: running time over observed time. performance: readings per running hour over
    ``ideal_per_hour``, at most 1. quality: readings that passed over all readings.
    """
    keep = [key, "timestamp", "status", "passed", *(["seq"] if "seq" in evaluated.columns else [])]
    held = durations(evaluated.select(*keep), key, cuts=cuts)
    totals = held.groupBy(key).agg(
        F.sum(F.when(F.col("status") == "running", F.col("held_ms")).otherwise(0)).cast("double").alias("_run"),
        F.sum("held_ms").cast("double").alias("_all"),
        F.count(F.lit(1)).cast("double").alias("_n"),
        F.count_if(F.col("passed")).cast("double").alias("_good"),
    )
    performance = F.least(F.lit(1.0), F.try_divide(F.col("_n") * 3_600_000.0, F.col("_run") * ideal_per_hour))
    return totals.select(
        key, F.try_divide("_run", "_all").alias("availability"),
        performance.alias("performance"), (F.col("_good") / F.col("_n")).alias("quality"),
    ).withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))
