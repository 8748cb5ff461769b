"""Machine dimensions and fault bands. Work on tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions.frames import guarded_broadcast


def add_dims(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Readings with machine type and location. A registry too large to broadcast is shuffled."""
    rows = df.drop("machine_type", "location")
    return rows.join(guarded_broadcast(registry.select("machine_id", "machine_type", "location"), 1_000_000),
                     "machine_id", "left")


def fault_band_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(schemas.FAULT_BANDS), schemas.FAULT_BAND_SCHEMA)


def fault_bands(df: DataFrame, bands: DataFrame) -> DataFrame:
    """Add ``profiles``: names of the fault profiles all of whose bands hold the reading, sorted.

    Bands are gathered per profile into one small array that a scalar subquery hands to every
    row, so readings are neither multiplied nor shuffled.
    """
    per = bands.groupBy("profile").agg(F.collect_list(F.struct("measurement", "lo", "hi")).alias("bands"))
    table = per.agg(F.array_sort(F.collect_list(F.struct("profile", "bands")))).scalar()

    def holds(band):
        value = F.when(F.lit(False), F.lit(None).cast("double"))
        for m in schemas.MEASUREMENTS:
            value = value.when(band["measurement"] == m, F.col(m))
        return F.coalesce(value.between(band["lo"], band["hi"]), F.lit(False))

    hit = F.filter("_bands", lambda p: F.forall(p["bands"], holds))
    return df.withColumn("_bands", table).withColumn(
        "profiles", F.transform(hit, lambda p: p["profile"])).drop("_bands")
