"""Run context: the run a reading belongs to, implicit run closes and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import scalars
from millwatch.operators.ordered import Cuts, Timeline, asof, previous, scan

_CARRY = ("run_id", "event_type", "start_ts", "end_ts")


def _tie(df: DataFrame) -> str | None:
    return "seq" if "seq" in df.columns else None


def _line(df: DataFrame, keys: list[str], cuts: Cuts | None) -> Timeline:
    order = ["timestamp", *(["seq"] if "seq" in df.columns else [])]
    return Timeline.of(df, keys, order, cuts)


def attach_context(telemetry: DataFrame, context: DataFrame, *, active_only: bool = False,
                   anomalies: bool = False, cuts: Cuts | None = None) -> DataFrame:
    """Every reading with the latest context event at or before it; nulls if there is none.

    A trackout replaces the trackin. ``active_only`` blanks the context after a trackout.
    ``anomalies`` adds ``context_anomaly``, set on the first reading after an implicit close; if
    several closes precede one reading it shows the latest, and ``implicit_closes`` lists all.
    Tables with a ``seq`` column break ties by it. On streams use ``streaming.stateful``.
    """
    events = sequence_guard(context, cuts=cuts) if anomalies else context
    events = events.withColumnRenamed("device_id", "machine_id").withColumn("context_ts", F.col("timestamp"))
    carry = [*_CARRY, "context_ts", *(["context_anomaly"] if anomalies else [])]
    found = asof(telemetry, events, ["machine_id"], left_time="timestamp", right_time="timestamp",
                 left_tie=_tie(telemetry), right_tie=_tie(events), carry=carry, into="_context",
                 first="_first" if anomalies else None, cuts=cuts)
    held = F.col("_context")
    if active_only:
        held = F.when(held["event_type"] == schemas.TRACKIN, held)
    out = [held[c].alias(c) for c in (*_CARRY, "context_ts")]
    if anomalies:
        out.append(F.when(F.col("_first"), F.col("_context.context_anomaly")).alias("context_anomaly"))
    return found.select(*telemetry.columns, *out)


def sequence_guard(context: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """Context events with ``context_anomaly`` on a trackin that follows a trackin.

    The earlier run was never tracked out. It is flagged, not blocked.
    """
    line = _line(context, ["device_id"], cuts)
    seen = scan(context, line, {"_prev": previous(["event_type", "run_id"])})
    implicit = (F.col("event_type") == schemas.TRACKIN) & (F.col("_prev.event_type") == schemas.TRACKIN)
    return seen.withColumn("context_anomaly", F.when(
        implicit, anomaly(F.col("_prev.run_id"), F.col("run_id"), F.col("timestamp")))).drop("_prev")


def implicit_closes(context: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """Every implicit run close, one row each."""
    return (
        sequence_guard(context, cuts=cuts)
        .where(F.col("context_anomaly").isNotNull()).select("device_id", "context_anomaly")
    )


def anomaly(previous_run: Column, current_run: Column, ts: Column) -> Column:
    return F.struct(
        F.lit(schemas.IMPLICIT_RUN_CLOSE).alias("type"),
        previous_run.alias("previous_run_id"),
        current_run.alias("current_run_id"),
        ts.alias("implicit_transition_ts"),
        F.concat(F.lit("trackin of "), F.coalesce(current_run, F.lit("?")), F.lit(" before trackout of "),
                 F.coalesce(previous_run, F.lit("?"))).alias("reason"),
    )


def runs(context: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """One row per trackin: its run ends at the next context event, and is open if there is none."""
    line = _line(context, ["device_id"], cuts)
    seen = scan(context, line.reversed(), {"_next": previous(["event_type", "timestamp"])})
    return seen.where(F.col("event_type") == schemas.TRACKIN).select(
        "device_id", "run_id",
        F.col("timestamp").alias("start_ts"),
        F.col("_next.timestamp").alias("end_ts"),
        F.when(F.col("_next").isNull(), "open").when(F.col("_next.event_type") == schemas.TRACKOUT, "trackout")
        .otherwise("implicit").alias("closed_by"),
    )


def in_run(telemetry: DataFrame, run_table: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """Every reading with the run whose ``[start_ts, end_ts]`` holds it; nulls outside of runs.

    Finds the last run start by as-of, then checks the end, so no range join is needed.
    """
    starts = run_table.withColumnRenamed("device_id", "machine_id")
    found = asof(telemetry, starts, ["machine_id"], left_time="timestamp", right_time="start_ts",
                 left_tie=_tie(telemetry), carry=["run_id", "start_ts", "end_ts"], into="_run",
                 cuts=cuts)
    inside = F.when(
        F.col("_run.end_ts").isNull() | (F.col("timestamp") <= F.col("_run.end_ts")), F.col("_run"))
    return found.select(*telemetry.columns,
                        *[inside[c].alias(c) for c in ("run_id", "start_ts", "end_ts")])


def dlq_records(anomalies: DataFrame, now: Column | int | None = None) -> DataFrame:
    """Dead-letter records, one per anomaly, still to be resolved.

    The id depends only on the anomaly, so a replay writes the same record again.
    """
    a = F.col("context_anomaly")
    return anomalies.where(a.isNotNull()).select(
        scalars.stable_id(F.col("device_id"), a["previous_run_id"], a["current_run_id"],
                          a["implicit_transition_ts"]).alias("anomaly_id"),
        "device_id",
        F.lit(schemas.SEQUENCE_ANOMALY).alias("anomaly_type"),
        "context_anomaly",
        F.lit(schemas.UNRESOLVED).alias("status"),
        F.lit(schemas.MATCH_WITH_DELAYED_TRACKOUT).alias("resolution_action"),
        scalars.now_ms(now).alias("created_ts"),
        F.lit(None).cast("bigint").alias("resolved_ts"),
    )


def anomaly_dlq(evaluated: DataFrame, now: Column | int | None = None) -> DataFrame:
    """Dead-letter records of the evaluated rows that carry an anomaly. (s)"""
    return dlq_records(evaluated, now)


def reconcile(records: DataFrame, context: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """Resolve records whose previous run is tracked out at or after the implicit close.

    The first such trackout counts. It is found by a forward as-of per device and run.
    """
    outs = context.where(F.col("event_type") == schemas.TRACKOUT).select(
        "device_id", F.col("run_id").alias("_run"), F.col("timestamp").alias("_out"))
    open_ = records.withColumns({
        "_run": F.col("context_anomaly.previous_run_id"),
        "_at": F.col("context_anomaly.implicit_transition_ts"),
    })
    found = asof(open_, outs, ["device_id", "_run"], left_time="_at", right_time="_out",
                 carry=["_out"], forward=True, into="_late", cuts=cuts)
    late = F.when(F.col("_run").isNotNull(), F.col("_late._out"))
    return found.withColumns({
        "resolved_ts": late,
        "status": F.when(late.isNotNull(), schemas.RESOLVED).otherwise(schemas.UNRESOLVED),
    }).select(*records.columns)
