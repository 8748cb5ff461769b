"""Time-series reads over readings or the bronze table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import scalars

# Colour steps of a chart, each from its lower bound on.
COLOR_STEPS = ((None, "green"), (80.0, "red"))


def with_path(df: DataFrame, group: str = schemas.STORAGE_GROUP) -> DataFrame:
    return df.withColumn("device_path", scalars.device_path(group, F.col("machine_id")))


def bronze_rows(evaluated: DataFrame, group: str = schemas.STORAGE_GROUP) -> DataFrame:
    """The raw readings of evaluated rows: flags dropped, device path and date added. (s)"""
    if "machine_id" not in evaluated.columns:
        evaluated = evaluated.withColumnRenamed("device_id", "machine_id")
    rows = with_path(evaluated, group)
    time = F.timestamp_millis("timestamp")
    dims = [c for c in ("machine_type", "location", "seq") if c in rows.columns]
    return rows.select("machine_id", *dims, "timestamp", *schemas.MEASUREMENTS, "status", "fault_code",
                       "device_path", time.alias("event_time"), F.to_date(time).alias("date"))


def path_matches(path: Column, pattern: str) -> Column:
    """Whether a device path is under a wildcard such as ``root.factory1.*``."""
    return path.startswith(pattern[:-1]) if pattern.endswith("*") else path == pattern


def series(df: DataFrame, measurement: str | Sequence[str], since: Column | None = None,
           until: Column | None = None, devices: Sequence[str] | None = None,
           prefix: str | None = None) -> DataFrame:
    """One or more measurements by device and time; only these columns are read.

    ``since`` is exclusive. If the table has a ``date`` partition column, the bounds also prune
    partitions; device ids and epoch ms are pushed to the files. (s)
    """
    names = [measurement] if isinstance(measurement, str) else list(measurement)
    for bound, later in ((since, True), (until, False)):
        if bound is None:
            continue
        ms = F.unix_millis(bound.cast("timestamp"))
        df = df.where(F.col("timestamp") > ms if later else F.col("timestamp") <= ms)
        if "date" in df.columns:
            day = F.to_date(bound.cast("timestamp"))
            df = df.where(F.col("date") >= day if later else F.col("date") <= day)
    if devices is not None:
        df = df.where(F.col("machine_id").isin(*devices))
    if prefix is not None:
        path = F.col("device_path") if "device_path" in df.columns else scalars.device_path(
            schemas.STORAGE_GROUP, F.col("machine_id"))
        df = df.where(path_matches(path, prefix))
    return df.select("machine_id", F.timestamp_millis("timestamp").alias("event_time"), *names)


def last_hours(df: DataFrame, measurement: str | Sequence[str], hours: int = 6, ref: Column | None = None,
               **where) -> DataFrame:
    """The last ``hours`` before ``ref`` (now, if not given)."""
    ref = F.current_timestamp() if ref is None else ref
    return series(df, measurement, since=ref - F.make_interval(hours=F.lit(hours)), **where)


def ordered_series(df: DataFrame) -> DataFrame:
    return df.orderBy("machine_id", "event_time")


def series_wide(df: DataFrame, measurement: str, ids: Sequence[str]) -> DataFrame:
    """One column per device. The ids come from the caller, so no pass is needed to find them.

    Of several values at one time the last by ``seq`` counts, or the largest where there is no ``seq``.
    """
    pick = F.max_by(measurement, "seq") if "seq" in df.columns else F.max(measurement)
    return (
        df.where(F.col("machine_id").isin(*ids) & F.col(measurement).isNotNull()).groupBy(F.timestamp_millis("timestamp").alias("event_time"))
        .pivot("machine_id", list(ids)).agg(pick)
    )


def last_value(df: DataFrame, measurement: str) -> DataFrame:
    """The latest non-null value per machine and when it was read; combined before the shuffle.

    Of several at one time the last by ``seq`` counts, or the largest where there is no ``seq``.
    """
    order = F.struct("timestamp", "seq" if "seq" in df.columns else measurement)
    return (
        df.where(F.col(measurement).isNotNull()).groupBy("machine_id")
        .agg(F.max_by(measurement, order).alias(measurement), F.max("timestamp").alias("timestamp"))
    )


def count_by_device(df: DataFrame) -> DataFrame:
    return df.groupBy("machine_id").agg(F.count(F.lit(1)).alias("n"))


def count_by_path(df: DataFrame, group: str = schemas.STORAGE_GROUP) -> DataFrame:
    """Rows per device path, as a batch write reports them. (s)"""
    return with_path(df, group).groupBy("device_path").agg(F.count(F.lit(1)).alias("n"))


def series_list(df: DataFrame, measurements: Sequence[str] = schemas.MEASUREMENTS,
                group: str = schemas.STORAGE_GROUP) -> DataFrame:
    """Every (device, measurement) that has a value: one pass with five flags per device."""
    seen = df.groupBy("machine_id").agg(*[F.bool_or(F.col(m).isNotNull()).alias(m) for m in measurements])
    return (
        seen.unpivot(["machine_id"], list(measurements), "measurement", "present").where("present")
        .select(F.col("machine_id").alias("device_id"), "measurement",
                F.concat_ws(".", F.lit(group), "machine_id", "measurement").alias("path"))
    )


def first_n(df: DataFrame, n: int = 10, device: str | None = None) -> DataFrame:
    """The first n readings in time; ties go by machine."""
    rows = df if device is None else df.where(F.col("machine_id") == device)
    return rows.orderBy("timestamp", "machine_id").limit(n)


def exists(df: DataFrame) -> DataFrame:
    """One row telling whether there is any data; stops at the first row found."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("present"))


def dedupe(df: DataFrame, order: str = "seq") -> DataFrame:
    """One row per machine and timestamp: the last that arrived. Copies are combined before the shuffle."""
    names = df.columns
    return (
        df.groupBy("machine_id", "timestamp").agg(F.max_by(F.struct(*names), order).alias("_r"))
        .select("_r.*")
    )


def color_class(df: DataFrame, measurement: str, steps: Sequence[tuple[float | None, str]] = COLOR_STEPS) -> DataFrame:
    """Add ``color``: that of the highest step the value reaches. (s)"""
    x = F.col(measurement)
    base = next(c for b, c in steps if b is None)
    color = F.lit(base)
    for bound, name in sorted((s for s in steps if s[0] is not None), key=lambda s: s[0]):
        color = F.when(x >= bound, name).otherwise(color)
    return df.withColumn("color", F.when(x.isNotNull(), color))
