"""Read message topics: Kafka, or files in Kafka's column shape, as a table or a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas

# What is read from the start, so that a new job knows the rules and the runs.
FROM_START = (schemas.CONTEXT_TOPIC, schemas.RULES_TOPIC, schemas.MANIFEST_TOPIC)
#: What a micro-batch takes at most where the options say nothing; the rest waits for the next one.
OFFSETS, FILES = 2_000_000, 1_000


def read_topic(spark: SparkSession, topic: str, *, options: Mapping[str, str] | None = None,
               streaming: bool = False, format: str = "kafka", path: str | None = None) -> DataFrame:
    """Records of a topic with key, value, topic, partition, offset and timestamp.

    ``format='kafka'`` needs the connector on the classpath and ``kafka.bootstrap.servers`` in
    ``options``; ``maxOffsetsPerTrigger`` and ``maxFilesPerTrigger`` bound a micro-batch. ``parquet`` reads the same columns
    from files under ``path``; ``text`` and ``json`` read one message per line, ``json`` being
    the lines as they are. Files of other topics in one folder are left out by ``topic``.
    """
    reader = spark.readStream if streaming else spark.read
    options = dict(options or {})
    if format == "kafka":
        if streaming:
            options.setdefault("startingOffsets", "earliest" if topic in FROM_START else "latest")
            options.setdefault("maxOffsetsPerTrigger", str(OFFSETS))
        return reader.format("kafka").option("subscribe", topic).options(**options).load()
    if streaming:
        options.setdefault("maxFilesPerTrigger", str(FILES))
    if path is None:
        raise ValueError(f"format {format} needs a path")
    if format == "parquet":
        rows = reader.schema(schemas.RECORD).options(**options).parquet(path)
        return rows.where(F.col("topic").isNull() | (F.col("topic") == topic))
    if format in ("text", "json"):
        lines = reader.options(**options).text(path)
        return lines.select(
            F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
            F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
            F.lit(None).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"))
    raise ValueError(f"unknown format {format}")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The bronze table. ``series`` prunes its ``date`` partitions."""
    return spark.read.parquet(path)
