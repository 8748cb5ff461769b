"""Small helpers on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

CONFIG_ROWS = 20_000  # configuration up to this size is broadcast or inlined
BROADCAST_BYTES = 64 << 20


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row, however often it is used.

    A later filter on it would otherwise be pushed below it, with the whole expression copied into
    the filter for every use. Exploding an array of one keeps the column where it is. (s)
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def localize(df: DataFrame, max_rows: int = CONFIG_ROWS) -> tuple[DataFrame, list[Row] | None]:
    """A small configuration table as literal rows, so a plan that uses it often reads it once.

    Also gives the rows. A larger table is returned as it is, with None.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df, None
    return df.sparkSession.createDataFrame(rows, df.schema), rows


def guarded_broadcast(df: DataFrame, max_rows: int = 100_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when a bounded count shows that the side is small, in rows and in bytes as text.

    A larger side gets no hint and is joined by shuffle, with skewed partitions split at run time.
    """
    if df.isStreaming:
        return df
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))))
    rows, text = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and text <= max_bytes else df
