"""Edge trimming: drop or tag the readings at the start and the end of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.functions import scalars
from millwatch.operators.context import in_run
from millwatch.operators.ordered import Cuts

KEEP, TRIMMED_LEAD, TRIMMED_TRAIL, PENDING = "KEEP", "TRIMMED_LEAD", "TRIMMED_TRAIL", "PENDING"

# What a manifest that says nothing gets.
DEFAULT_LEAD_SECONDS, DEFAULT_TRAIL_SECONDS, DEFAULT_ACTION = 5.0, 5.0, "drop"


def trim_config(edge: Column) -> tuple[Column, Column, Column]:
    """Lead ms, trail ms and action of a manifest's ``edgeTrimming``, with defaults."""
    return (
        scalars.seconds_to_millis(F.coalesce(edge["leadSeconds"], F.lit(DEFAULT_LEAD_SECONDS))),
        scalars.seconds_to_millis(F.coalesce(edge["trailSeconds"], F.lit(DEFAULT_TRAIL_SECONDS))),
        F.coalesce(edge["action"], F.lit(DEFAULT_ACTION)),
    )


def disposition(ts: Column, start: Column, end: Column, lead_ms: Column | int, trail_ms: Column | int) -> Column:
    """KEEP, TRIMMED_LEAD, TRIMMED_TRAIL, or PENDING outside of any known run.

    The kept range is ``[start + lead, end - trail]``; an open run has no trail yet.
    """
    lead = F.lit(lead_ms) if isinstance(lead_ms, int) else lead_ms
    trail = F.lit(trail_ms) if isinstance(trail_ms, int) else trail_ms
    return (
        F.when(start.isNull(), PENDING).when(ts < start + lead, TRIMMED_LEAD)
        .when(end.isNotNull() & (ts > end - trail), TRIMMED_TRAIL).otherwise(KEEP)
    )


def edge_trim(telemetry: DataFrame, runs: DataFrame, lead_ms: int = 5000, trail_ms: int = 5000,
              action: str = DEFAULT_ACTION, *, cuts: Cuts | None = None) -> DataFrame:
    """Readings with their run and ``disposition``. ``drop`` leaves trimmed rows out, ``tag`` keeps them."""
    placed = in_run(telemetry, runs, cuts=cuts).withColumn(
        "disposition", disposition(F.col("timestamp"), F.col("start_ts"), F.col("end_ts"), lead_ms, trail_ms))
    return placed if action == "tag" else placed.where(~F.col("disposition").startswith("TRIMMED"))


def output_of(disposition: Column) -> Column:
    """Which output a reading belongs to: kept, trimmed or pending."""
    return F.when(disposition == PENDING, "pending").when(disposition.startswith("TRIMMED"), "trimmed").otherwise("kept")


def settle_pending(pending: DataFrame, runs: DataFrame, lead_ms: int = 5000, trail_ms: int = 5000, *,
                   cuts: Cuts | None = None) -> DataFrame:
    """Readings that were pending, decided by the runs that are known now. Those still outside of any stay pending."""
    bare = pending.drop("run_id", "start_ts", "end_ts", "disposition", "output")
    return edge_trim(bare, runs, lead_ms, trail_ms, "tag", cuts=cuts)


def edge_trim_by_manifest(telemetry: DataFrame, runs: DataFrame, manifests: DataFrame, *,
                          cuts: Cuts | None = None) -> DataFrame:
    """As ``edge_trim``, with lead, trail and action of the current manifest of each machine type."""
    from millwatch.operators.manifests import attach_manifest

    lead, trail, action = trim_config(F.col("_manifest.edgeTrimming"))
    placed = attach_manifest(in_run(telemetry, runs, cuts=cuts), manifests)
    tagged = placed.withColumns({
        "disposition": disposition(F.col("timestamp"), F.col("start_ts"), F.col("end_ts"), lead, trail),
        "_action": action,
    }).where((F.col("_action") == "tag") | ~F.col("disposition").startswith("TRIMMED"))
    return tagged.drop("_manifest", "_action")
