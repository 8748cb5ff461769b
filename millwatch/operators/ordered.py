"""Scans along each key's timeline that stay balanced when one key is very large.

A window partitioned by machine puts all rows of a machine in one task. That is the best
plan while machines are of ordinary size: one shuffle, one sort. A machine that holds a large
share of all rows is cut into slices of time instead. Each slice is scanned on its own, each
slice is reduced to one row, those few rows are scanned to find what every slice starts from,
and that start is joined back. The result is the same row for row.

``measure`` finds the machines to cut by a map-side combined count. Operators measure what they
scan if they are not given ``cuts``; measure once and pass them on to run several operators.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

MAX_ROWS = 4_000_000     # rows of one key that one task scans
MAX_HOT_KEYS = 50_000    # largest keys that are cut; rows of the table of cuts
MAX_BROADCAST_SLICES = 200_000
FINE = 8                 # a slice can be up to 2**FINE times shorter than an even cut

_SLICE = "_slice"


@dataclass(frozen=True)
class Cuts:
    """The hot keys and the width of their slices. ``hot`` is None if no key is hot."""

    keys: int
    max_rows: int
    hot: DataFrame | None = None
    slices: int = 0


def measure(*tables: tuple[DataFrame, Sequence[str], str], max_rows: int = MAX_ROWS) -> Cuts:
    """Measure tables, each with its key columns and its epoch-ms column, counted together.

    Runs one aggregate over these columns only, and a second over the rows of hot keys if there
    are any. Keys beyond the ``MAX_HOT_KEYS`` largest are not cut; there is then no lack of keys
    to spread.
    """
    parts = [df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(time).alias("_t"))
             for df, keys, time in tables]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    names = [f"_k{i}" for i in range(len(tables[0][1]))]
    cuts = Cuts(len(names), max_rows)
    sizes = rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
    largest = (
        sizes.where((F.col("_n") > max_rows) & F.col("_lo").isNotNull())
        .orderBy(F.desc("_n")).limit(MAX_HOT_KEYS).collect()
    )
    if not largest:
        return cuts
    spark = rows.sparkSession
    hot = spark.createDataFrame([tuple(r) for r in largest], sizes.schema).withColumn(
        "_fine",
        F.greatest(F.lit(1), F.expr(f"(_hi - _lo + 1) div (ceil(_n / {max_rows}) * {1 << FINE})")),
    ).withColumnsRenamed({n: f"_h{n}" for n in names})
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_h{n}"))
    cells = (
        rows.join(F.broadcast(hot), same)
        .groupBy(*names, "_lo", "_fine", F.expr("(_t - _lo) div _fine").alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # The widest slice, by doubling, that keeps every slice within max_rows.
    levels = (
        cells.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(FINE))))
        .groupBy(*names, "_lo", "_fine", "_level", F.expr("shiftright(_cell, _level)").alias("_cell"))
        .agg(F.sum("_n").alias("_n"))
        .groupBy(*names, "_lo", "_fine", "_level")
        .agg(F.max("_n").alias("_n"), F.count(F.lit(1)).alias("_slices"))
        .where((F.col("_n") <= max_rows) | (F.col("_level") == 0))
        .groupBy(*names, F.col("_lo").alias("_origin"), "_fine")
        .agg(F.max("_level").alias("_level"), F.max_by("_slices", "_level").alias("_slices"))
        .select(*names, "_origin", F.expr("_fine * shiftleft(1L, _level)").alias("_width"), "_slices")
    )
    found = levels.collect()  # at most MAX_HOT_KEYS rows
    table = spark.createDataFrame(found, levels.schema)
    return replace(cuts, hot=table.drop("_slices"), slices=sum(r["_slices"] for r in found))


@dataclass(frozen=True)
class Timeline:
    """Keys and order of a scan. ``order[0]`` is a bigint time; the rest break ties.

    Cuts belong to the leading keys; further keys only divide a slice more.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: Cuts
    descending: bool = False

    @staticmethod
    def of(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts | None = None, *,
           descending: bool = False) -> Timeline:
        cuts = cuts or measure((df, keys, order[0]))
        return Timeline(tuple(keys), tuple(order), cuts, descending)

    @property
    def hot(self) -> DataFrame | None:
        return self.cuts.hot

    def reversed(self) -> Timeline:
        return replace(self, descending=not self.descending)

    def cut(self, df: DataFrame) -> DataFrame:
        """Add the slice number: null for keys that are not cut."""
        if self.hot is None:
            return df
        lead = self.keys[:self.cuts.keys]
        # at most MAX_HOT_KEYS rows
        return (
            df.join(F.broadcast(self.hot), _same(df, lead), "left")
            .withColumn(_SLICE, F.expr(f"(coalesce({self.order[0]}, 0) - _origin) div _width"))
            .drop(*[f"_k{i}" for i in range(len(lead))], "_origin", "_width")
        )

    def window(self) -> WindowSpec:
        parts = [*self.keys, *([_SLICE] if self.hot is not None else [])]
        return Window.partitionBy(*parts).orderBy(*self._sorted(self.order))

    def _sorted(self, names: Sequence[str]) -> list[Column]:
        return [F.col(n).desc() if self.descending else F.col(n).asc() for n in names]


def _same(df: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(F.col(f"_k{i}"))
    return cond


@dataclass(frozen=True)
class Scan:
    """One scanned column.

    ``local`` scans inside a slice, ``end`` reduces a slice, ``fold`` scans the reduced slices
    before this one, ``merge`` joins both.
    """

    local: Callable[[WindowSpec], Column]
    end: Callable[[Timeline], Column]
    fold: Callable[[Column, WindowSpec], Column]
    merge: Callable[[Column, Column], Column]


def _frame(w: WindowSpec, inclusive: bool) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def last_value(value: Column, *, inclusive: bool = True) -> Scan:
    """The latest non-null value up to this row (or before it)."""

    def end(line: Timeline) -> Column:
        pick = F.min_by if line.descending else F.max_by
        return pick(value, F.when(value.isNotNull(), F.struct(*line.order)))

    return Scan(
        local=lambda w: F.last(value, ignorenulls=True).over(_frame(w, inclusive)),
        end=end,
        fold=lambda c, w: F.last(c, ignorenulls=True).over(w),
        merge=F.coalesce,
    )


def running_sum(value: Column, *, inclusive: bool = True) -> Scan:
    return Scan(
        local=lambda w: F.sum(value).over(_frame(w, inclusive)),
        end=lambda line: F.sum(value),
        fold=lambda c, w: F.sum(c).over(w),
        merge=lambda here, before: F.when(
            here.isNotNull() | before.isNotNull(),
            F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0)),
        ),
    )


def running_count(value: Column, *, inclusive: bool = True) -> Scan:
    """How many non-null values there are up to this row."""
    return Scan(
        local=lambda w: F.count(value).over(_frame(w, inclusive)),
        end=lambda line: F.count(value),
        fold=lambda c, w: F.sum(c).over(w),
        merge=lambda here, before: here + F.coalesce(before, F.lit(0)),
    )


def running_max(value: Column, *, inclusive: bool = True) -> Scan:
    return Scan(
        local=lambda w: F.max(value).over(_frame(w, inclusive)),
        end=lambda line: F.max(value),
        fold=lambda c, w: F.max(c).over(w),
        merge=lambda here, before: F.when(before.isNull() | (here > before), here).otherwise(before),
    )


def scan(df: DataFrame, line: Timeline, columns: dict[str, Scan]) -> DataFrame:
    """Add scanned columns to every row."""
    rows = line.cut(df)
    w = line.window()
    out = rows.withColumns({n: s.local(w) for n, s in columns.items()})
    if line.hot is None:
        return out
    ends = (
        rows.where(F.col(_SLICE).isNotNull())
        .groupBy(*line.keys, _SLICE)
        .agg(*[s.end(line).alias(n) for n, s in columns.items()])
    )
    before = _frame(Window.partitionBy(*line.keys).orderBy(*line._sorted([_SLICE])), False)
    starts = ends.withColumns({n: s.fold(F.col(n), before) for n, s in columns.items()})
    joined = join_slices(out, starts, line, list(columns))
    return joined.select(
        *df.columns,
        *[s.merge(F.col(n), F.col(f"_before_{n}")).alias(n) for n, s in columns.items()],
    )


def join_slices(rows: DataFrame, starts: DataFrame, line: Timeline, names: list[str]) -> DataFrame:
    """Join per-slice values back as ``_before_<name>``."""
    side = starts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(line.keys)],
        F.col(_SLICE).alias("_s"),
        *[F.col(n).alias(f"_before_{n}") for n in names],
    )
    if line.cuts.slices <= MAX_BROADCAST_SLICES and len(line.keys) == line.cuts.keys:  # counted when the keys were measured
        side = F.broadcast(side)
    return rows.join(side, _same(rows, line.keys) & (rows[_SLICE] == F.col("_s")), "left")


def previous(columns: Sequence[str]) -> Scan:
    """The row before this one, as a struct of ``columns``; null on the first row."""
    return last_value(F.struct(*columns), inclusive=False)


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], *, left_time: str, right_time: str,
         carry: Sequence[str], left_tie: str | None = None, right_tie: str | None = None,
         forward: bool = False, into: str = "_match", first: str | None = None,
         cuts: Cuts | None = None) -> DataFrame:
    """Every left row with the latest right row at or before it (``forward``: first at or after it).

    One shuffle of the union by key; no inequality join. ``into`` is a struct of ``carry``, null
    where nothing matches. A right row at the same time counts as a match. ``first`` names a column
    that is true on the first left row of each match.
    """
    left_rank, right_rank = (0, 1) if forward else (1, 0)
    absent = F.lit(None).cast("bigint")
    both = left.withColumns({
        "_time": F.col(left_time), "_rank": F.lit(left_rank),
        "_tie": F.col(left_tie) if left_tie else absent,
    }).unionByName(
        right.select(
            *keys, F.col(right_time).alias("_time"), F.lit(right_rank).alias("_rank"),
            (F.col(right_tie) if right_tie else absent).alias("_tie"),
            F.struct(*carry).alias("_carry"),
        ),
        allowMissingColumns=True,
    )
    line = Timeline.of(both, keys, ("_time", "_rank", "_tie"), cuts, descending=forward)
    columns = {into: last_value(F.col("_carry"))}
    if first:
        columns["_before"] = last_value(F.col("_rank"), inclusive=False)
    matched = scan(both, line, columns).where(F.col("_rank") == left_rank)
    extra = [F.coalesce(F.col("_before") == right_rank, F.lit(False)).alias(first)] if first else []
    return matched.select(*left.columns, into, *extra)
