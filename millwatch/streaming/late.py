"""What arrives after its time: readings whose context is no longer in state, context after its readings, and rule results
that change later. Results of a stream are versions; these functions find what changes and put the last version together.

The tables here are written by the stream's own job (bronze, context events, outputs). They are joined by shuffles on the
machine, never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch.functions import scalars
from millwatch.operators import context as context_ops
from millwatch.operators.ordered import Cuts, asof

CONTEXT = ("run_id", "event_type", "start_ts", "end_ts", "context_ts")


def placed_again(placed: DataFrame, events: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """The rows of ``attach_context_stream``; those that it could not place are joined to a table of all context events."""
    lost = placed.where("unplaced")
    own = [c for c in placed.columns if c not in CONTEXT]
    found = context_ops.attach_context(lost.select(*own), events, cuts=cuts).withColumn("unplaced", F.lit(False))
    return placed.where("not unplaced").unionByName(found.select(*placed.columns))


def corrections(arrived: DataFrame, readings: DataFrame, events: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """The readings whose latest context is one of the events that have just arrived, with that context.

    ``readings`` have been given out before, ``events`` are all context events, the new ones among them. Only machines with
    new events are read, from the first of them on; a reading under an older or a later event is not touched.
    """
    tie = ["seq"] if "seq" in events.columns and "seq" in arrived.columns else []
    names = ["device_id", "timestamp", "run_id", "event_type", *tie]
    first = arrived.groupBy(F.col("device_id").alias("machine_id")).agg(F.min("timestamp").alias("_from"))
    touched = readings.join(first, "machine_id").where(F.col("timestamp") >= F.col("_from")).drop("_from")
    # one row of a repeated event is enough to know it by
    new = arrived.select(*names).distinct().withColumn("_new", F.lit(True))
    same = [events[n].eqNullSafe(new[n]) for n in names]
    marked = events.join(first.select(F.col("machine_id").alias("device_id")), "device_id", "left_semi").alias("e")
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    marked = marked.join(new, condition, "left").select("e.*", "_new")
    right = marked.withColumnRenamed("device_id", "machine_id").withColumn("context_ts", F.col("timestamp"))
    found = asof(touched, right, ["machine_id"], left_time="timestamp", right_time="timestamp",
                 left_tie="seq" if "seq" in touched.columns else None, right_tie="seq" if tie else None,
                 carry=[*CONTEXT, "_new"], into="_context", cuts=cuts)
    return found.where("_context._new").select(*touched.columns, *[F.col(f"_context.{c}").alias(c) for c in CONTEXT])


def last_version(versions: DataFrame, keys: list[str], order: str = "version") -> DataFrame:
    """The row of the highest version of each key. Versions of a key are few."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return versions.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def with_changes(evaluated: DataFrame, alerts: DataFrame) -> DataFrame:
    """Evaluated readings with the standing alerts of rules over several readings: ``passed`` and the worst ``alert``.

    Both are given by ``device_id`` and ``timestamp``; ``alert`` is a struct with ``rule_id`` and ``severity``.
    """
    names = evaluated.schema["alert"].dataType.names
    found = alerts.groupBy("device_id", F.col("alert_time").alias("timestamp")).agg(
        F.min(F.struct((-scalars.severity_rank(F.col("severity"))).alias("rank"), "rule_id", F.struct(*names).alias("alert"))).alias("_more"))
    own = F.when(F.col("alert").isNotNull(), F.struct(
        (-scalars.severity_rank(F.col("alert.severity"))).alias("rank"), F.col("alert.rule_id").alias("rule_id"), F.col("alert").alias("alert")))
    # least skips nulls
    return evaluated.join(found, ["device_id", "timestamp"], "left").withColumns({
        "passed": F.col("passed") & F.col("_more").isNull(), "alert": F.least(own, F.col("_more"))["alert"],
    }).drop("_more")
