"""Time windows: statistics per machine, activity sessions, shifts. Work on tables and streams."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.operators.ordered import Cuts, Timeline, last_value, previous, scan

LATENESS = "60 seconds"


def with_event_time(df: DataFrame, lateness: str | None = None) -> DataFrame:
    """Add ``event_time`` from epoch ms, and a watermark on streams that ask for one."""
    if "event_time" not in df.columns:
        df = df.withColumn("event_time", F.timestamp_millis("timestamp"))
    return df.withWatermark("event_time", lateness) if lateness else df


_UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}


def millis(interval: str) -> int | None:
    """Milliseconds of an interval text like ``6 hours``; None for texts of another form."""
    number, _, unit = interval.strip().partition(" ")
    each = _UNITS.get(unit.strip().lower().removesuffix("s"))
    return int(number) * each if each and number.isdigit() and int(number) else None


def _multiple(value: Column, of: int) -> Column:
    return value - F.pmod(value, F.lit(of))


def _holding(pane: Column, size: int, slide: int) -> Column:
    """The windows of one size and slide that hold a pane."""
    begin, end = _multiple(pane - size, slide) + slide, _multiple(pane, slide)
    starts = F.when(begin <= end, F.sequence(begin, end, F.lit(slide).cast("bigint")))
    return F.transform(F.coalesce(starts, F.array().cast("array<bigint>")), lambda w: F.struct(
        F.lit(size).cast("bigint").alias("size"), F.lit(slide).cast("bigint").alias("slide"), w.alias("start")))


def folded(df: DataFrame, specs: Sequence[tuple[int, int]], measurements: Sequence[str], *,
           keys: Sequence[str] = ("machine_id",), spread: bool = True) -> DataFrame:
    """Every window of every (size, slide) in ms, from one scan: ``size``, ``slide``, ``start`` (ms), ``rows`` and, per
    measurement, ``_n``, ``_sum``, ``_min``, ``_max`` and, with ``spread``, ``_m2`` (the sum of squares about the mean).

    Readings are combined, before the shuffle, into panes of the greatest common divisor of all sizes and slides. Only
    panes are copied to the windows that hold them, and combined again.
    """
    pane = gcd(*[v for s in specs for v in s])
    time = F.col("timestamp") if "timestamp" in df.columns else F.unix_millis("event_time")
    first = [F.count(F.lit(1)).alias("rows")]
    for m in measurements:
        x = F.col(m).cast("double")
        first += [F.count(x).alias(f"{m}_n"), F.sum(x).alias(f"{m}_sum"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
        if spread:
            first.append((F.var_pop(x) * F.count(x)).alias(f"{m}_m2"))
    panes = df.groupBy(*keys, _multiple(time, pane).alias("_pane")).agg(*first)
    held = [_holding(F.col("_pane"), size, slide) for size, slide in specs]
    rows = panes.select("*", F.explode(F.concat(*held)).alias("_w")).select("*", "_w.*").drop("_w", "_pane")
    group = [*keys, "size", "slide", "start"]
    if spread:
        # squares are taken about a value close by, so nothing cancels
        whole = Window.partitionBy(*group)
        rows = rows.withColumns({f"_c_{m}": F.min(F.col(f"{m}_sum") / F.col(f"{m}_n")).over(whole) for m in measurements})
    second = [F.sum("rows").alias("rows")]
    for m in measurements:
        n, total = F.sum(f"{m}_n"), F.sum(f"{m}_sum")
        second += [n.alias(f"{m}_n"), total.alias(f"{m}_sum"), F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
        if spread:
            off = F.col(f"{m}_sum") / F.col(f"{m}_n") - F.col(f"_c_{m}")
            moved = F.sum(F.col(f"{m}_n") * off)
            second.append((F.sum(f"{m}_m2") + F.sum(F.col(f"{m}_n") * off * off) - moved * moved / n).alias(f"{m}_m2"))
    return rows.groupBy(*group).agg(*second)


def window_stats(df: DataFrame, size: str, slide: str | None = None, *,
                 measurements: Sequence[str] = ("gas_temperature",), key: str = "machine_id") -> DataFrame:
    """Count, min, max, mean and deviation per machine and window. (s)

    Combined before the shuffle, so a machine's size does not matter. Sliding windows of a table are folded from panes, so
    no reading is copied.
    """
    spans = (millis(size), millis(slide) if slide else None)
    if slide and not df.isStreaming and None not in spans:
        found = folded(df, [spans], measurements, keys=[key])
        out = [key, F.timestamp_millis("start").alias("window_start"), F.timestamp_millis(F.col("start") + F.col("size")).alias("window_end"),
               F.col("rows").alias("n")]
        for m in measurements:
            n = F.col(f"{m}_n")
            out += [f"{m}_min", f"{m}_max", F.try_divide(F.col(f"{m}_sum"), n).alias(f"{m}_avg"),
                    F.when(n > 1, F.sqrt(F.greatest(F.col(f"{m}_m2"), F.lit(0.0)) / (n - 1))).alias(f"{m}_stddev")]
        return found.select(*out)
    window = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    stats = [F.count(F.lit(1)).alias("n")]
    for m in measurements:
        stats += [F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"), F.avg(m).alias(f"{m}_avg"),
                  F.stddev_samp(m).alias(f"{m}_stddev")]
    return (
        with_event_time(df).groupBy(key, window.alias("w")).agg(*stats)
        .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "n", *[f"{m}_{s}" for m in measurements for s in ("min", "max", "avg", "stddev")])
    )


def session_stream(df: DataFrame, gap: str, *, key: str = "machine_id") -> DataFrame:
    """Activity sessions of a stream: readings of a machine no more than ``gap`` apart. (s)"""
    return (
        with_event_time(df).groupBy(key, F.session_window("event_time", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_time").alias("last_seen"))
        .select(key, F.col("w.start").alias("session_start"), "last_seen", "n")
    )


def sessions(df: DataFrame, gap_ms: int, *, key: str = "machine_id",
             cuts: Cuts | None = None) -> DataFrame:
    """Activity sessions of a table: a session ends where the next reading is ``gap_ms`` or more away.

    Every reading learns its session's start by a scan; the sessions are then a combined count
    per machine and start, so neither a busy machine nor a long session fills one task.
    """
    order = ["timestamp", *(["seq"] if "seq" in df.columns else [])]
    rows = df.select(key, *order)
    line = Timeline.of(rows, [key], order, cuts=cuts)
    seen = scan(rows, line, {"_prev": previous(["timestamp"])})
    gap = F.col("_prev").isNull() | (F.col("timestamp") - F.col("_prev.timestamp") >= gap_ms)
    marked = seen.withColumn("_start", F.when(gap, F.col("timestamp")))
    held = scan(marked, line, {"_session": last_value(F.col("_start"))})
    return held.groupBy(key, F.timestamp_millis("_session").alias("session_start")).agg(
        F.count(F.lit(1)).alias("n"), F.timestamp_millis(F.max("timestamp")).alias("last_seen"))


def shift_stats(evaluated: DataFrame, hours: int = 8, *, measurements: Sequence[str] = ("gas_temperature",),
                key: str = "machine_id") -> DataFrame:
    """End-of-shift statistics over the readings that passed. The shift length is the caller's."""
    return window_stats(evaluated.where("passed"), f"{hours} hours", measurements=measurements, key=key)
