"""Detectors along a machine's readings: EWMA, CUSUM, z-score.

Each is written in closed form with window sums, so it stays inside the JVM, and each treats a
machine of any size exactly: long series are worked on in blocks or slices and joined.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch.operators import ordered
from millwatch.operators.ordered import Cuts, Timeline, running_count, scan


def _order(df: DataFrame) -> list[str]:
    return ["timestamp", *(["seq"] if "seq" in df.columns else [])]


def ewma(df: DataFrame, column: str, alpha: float, *, key: str = "machine_id",
         cuts: Cuts | None = None) -> DataFrame:
    """Add ``<column>_ewma``: s = alpha*x + (1-alpha)*s, from the first value on.

    Readings are numbered and cut into blocks of B. Inside a block the weighted sum is a window
    sum of x*(1-alpha)^-i, with B small enough to stay far from overflow. A block then adds what
    the blocks before it still weigh; those whose weight is below double precision are left out.
    Readings without a value get null and do not count.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    x, w = F.col(column), 1.0 - alpha
    if w == 0:
        return df.withColumn(f"{column}_ewma", x.cast("double"))
    block = int(min(max(150 / -math.log10(w), 1), 100_000))
    back = max(1, math.ceil(40 / (block * -math.log(w))))  # blocks that still weigh more than e^-40
    line = Timeline.of(df, [key], _order(df), cuts=cuts)
    seen = scan(df, line, {"_n": running_count(x)}).withColumns({
        "_block": F.expr(f"(_n - 1) div {block}"),
        "_pos": F.expr(f"(_n - 1) % {block}"),
    })
    weight = F.when(F.col("_n") == 1, 1.0).otherwise(alpha)
    term = F.when(x.isNotNull(), x * weight * F.pow(F.lit(w), -F.col("_pos")))
    inside = Window.partitionBy(key, "_block").orderBy(*_order(df)).rowsBetween(
        Window.unboundedPreceding, 0)
    local = seen.withColumn("_sum", F.sum(term).over(inside))
    ends = seen.where(x.isNotNull()).groupBy(key, "_block").agg(
        (F.sum(term) * F.pow(F.lit(w), F.max("_pos"))).alias("_end"))
    starts = (
        ends.withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(back))))
        .groupBy(F.col(key).alias("_k"), (F.col("_block") + F.col("_ahead")).alias("_b"))
        .agg(F.sum(F.col("_end") * F.pow(F.lit(w), (F.col("_ahead") - 1) * block)).alias("_start"))
    )
    joined = local.join(starts, local[key].eqNullSafe(F.col("_k")) & (F.col("_block") == F.col("_b")), "left")
    value = (F.col("_sum") * F.pow(F.lit(w), F.col("_pos"))
             + F.coalesce(F.col("_start"), F.lit(0.0)) * F.pow(F.lit(w), F.col("_pos") + 1))
    return joined.select(*df.columns, F.when(x.isNotNull(), value).alias(f"{column}_ewma"))


def cusum(df: DataFrame, column: str, mu: float, k: float, h: float, *, key: str = "machine_id",
          cuts: Cuts | None = None) -> DataFrame:
    """Add ``<column>_cusum`` = max(0, previous + x - mu - k) and ``<column>_alarm`` where it exceeds h.

    With C the running sum of x-mu-k, the value is C - min(0, lowest C so far). A slice that
    starts from S adds it as max(value inside the slice, S + C inside the slice).
    """
    d = F.coalesce(F.col(column) - F.lit(mu) - F.lit(k), F.lit(0.0))
    line = Timeline.of(df, [key], _order(df), cuts=cuts)
    upto = line.window().rowsBetween(Window.unboundedPreceding, 0)
    rows = line.cut(df).withColumn("_c", F.sum(d).over(upto))
    rows = rows.withColumn("_v", F.col("_c") - F.least(F.lit(0.0), F.min("_c").over(upto)))
    value = F.col("_v")
    if line.hot is not None:
        tail = F.struct(*line.order)
        ends = (
            rows.where(F.col("_slice").isNotNull()).groupBy(key, "_slice")
            .agg(F.sum(d).alias("_total"), F.max_by("_v", tail).alias("_end"))
        )
        by = Window.partitionBy(key).orderBy("_slice")
        before = by.rowsBetween(Window.unboundedPreceding, -1)
        sums = ends.withColumn("_p", F.sum("_total").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        starts = sums.withColumn("_start", F.lag("_p").over(by) + F.max(
            F.greatest(F.col("_end") - F.col("_p"), F.lit(0.0) - F.col("_p"))).over(before))
        rows = ordered.join_slices(rows, starts, line, ["_start"])
        value = F.greatest(F.col("_v"), F.coalesce(F.col("_before__start"), F.lit(0.0)) + F.col("_c"))
    value = F.when(F.col(column).isNotNull(), value)
    return rows.select(*df.columns, value.alias(f"{column}_cusum"), (value > h).alias(f"{column}_alarm"))


def zscore(df: DataFrame, column: str, n: int, *, key: str = "machine_id",
           cuts: Cuts | None = None) -> DataFrame:
    """Add ``<column>_z``: distance from the mean of the ``n`` readings before, in their deviations.

    Null while fewer than two readings came before or if they do not vary. A machine that
    is cut is numbered and cut into blocks of rows; each block is also given the last ``n``
    rows of the block before it, so every frame is whole.
    """
    line = Timeline.of(df, [key], _order(df), cuts=cuts)
    rows, parts = df, [key]
    if line.hot is not None:
        size = max(line.cuts.max_rows, n)
        rows = scan(df, line, {"_n": running_count(F.lit(1))}).withColumn(
            "_block", F.expr(f"(_n - 1) div {size}"))
        late = F.expr(f"(_n - 1) % {size}") >= size - n
        rows = rows.withColumn("_for", F.explode(
            F.when(late, F.array(F.col("_block"), F.col("_block") + 1)).otherwise(F.array("_block"))))
        parts = [key, "_for"]
    w = Window.partitionBy(*parts).orderBy(*_order(df)).rowsBetween(-n, -1)
    x = F.col(column)
    out = rows.withColumns({"_mean": F.avg(x).over(w), "_sd": F.stddev_samp(x).over(w)})
    if line.hot is not None:
        out = out.where(F.col("_for") == F.col("_block"))
    return out.select(*df.columns, F.try_divide(x - F.col("_mean"), F.col("_sd")).alias(f"{column}_z"))
