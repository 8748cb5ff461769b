"""Write evaluated readings: bronze table, evaluation and dead-letter topics, alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from millwatch import schemas
from millwatch.operators import context, manifests, parse, rules
from millwatch.operators.series import bronze_rows
from millwatch.operators.trimming import output_of
from millwatch.sources.bronze import Bronze, open_table

# Fixed value: flush after this long.
FLUSH_INTERVAL = "3 seconds"
#: Small bronze files are put together after so many micro-batches.
COMPACT_EVERY = 50


@dataclass(frozen=True)
class Targets:
    """Where outputs go. A target is a folder, or a Kafka topic if ``kafka`` has the servers.

    An output without a target is not written.
    """

    bronze: str | None = None
    evaluation: str | None = None
    dlq: str | None = None
    errors: str | None = None
    alerts: str | None = None
    context: str | None = None    # a folder also where outputs go to Kafka: it is read again
    group: str = schemas.STORAGE_GROUP
    kafka: Mapping[str, str] = field(default_factory=dict)


def cluster_rows(df: DataFrame) -> DataFrame:
    """Lay rows out by date, machine and time for file skipping.

    Range partitioning samples the rows, so a busy machine is spread over several files.
    """
    return df.repartitionByRange("date", "machine_id", "timestamp").sortWithinPartitions(
        "date", "machine_id", "timestamp")


def write_bronze(df: DataFrame, path: str, *, group: str = schemas.STORAGE_GROUP, mode: str = "append") -> None:
    """Write all evaluated rows as raw readings, partitioned by date."""
    cluster_rows(bronze_rows(df, group)).write.mode(mode).partitionBy("date").parquet(path)


def _write(messages: DataFrame, target: str, batch_id: int | str, targets: Targets) -> None:
    if targets.kafka:
        messages.write.format("kafka").options(**targets.kafka).option("topic", target).save()
    else:
        messages.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


def write_batch(evaluated: DataFrame, batch_id: int, targets: Targets) -> None:
    """Fan one micro-batch out to all targets.

    The batch is computed once and kept in memory and on disk while it is written. A failed batch
    is run again by Spark: bronze knows the batches it holds, each folder output replaces its own ``batch_id``, and ids depend only
    on the rows, so a replay leaves the same data. Nothing is dropped on an error.
    """
    rows = evaluated.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if targets.bronze:
            own = bronze_rows(rows, targets.group)
            table = Bronze(rows.sparkSession, targets.bronze, own.schema)
            table.append(own, batch_id)
            if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
                table.compact()
        if targets.evaluation:
            _write(parse.to_message(rules.evaluation(rows)), targets.evaluation, batch_id, targets)
        if "context_anomaly" in rows.columns:
            write_dlq(rows.withColumnRenamed("machine_id", "device_id"), batch_id, targets)
        if targets.alerts:
            _write(parse.to_message(rules.alerts(rows), key="device_id"), targets.alerts, batch_id, targets)
    finally:
        rows.unpersist()


def write_dlq(anomalies: DataFrame, batch_id: int, targets: Targets) -> None:
    """Write the dead-letter records of the rows that carry a context anomaly."""
    if targets.dlq:
        _write(parse.to_message(context.dlq_records(anomalies)), targets.dlq, batch_id, targets)


def write_changes(alerts: DataFrame, batch_id: int, targets: Targets) -> None:
    """Write raised and withdrawn alerts of rules over several readings."""
    if targets.alerts:
        _write(parse.to_message(alerts, key="device_id"), targets.alerts, f"several-{batch_id}", targets)


def write_rejected(rejected: DataFrame, batch_id: int, targets: Targets) -> None:
    """Write the dead letters of rules that are not judged, keyed by rule."""
    if targets.errors:
        letters = rejected.select("rule_id", F.lit("rule-validator").alias("source"), F.lit(schemas.SCHEMA_VALIDATION_ERROR).alias("error_type"),
                                  "error_message")
        _write(parse.to_message(letters, key="rule_id"), targets.errors, f"rules-{batch_id}", targets)


def write_context(events: DataFrame, batch_id: int, targets: Targets) -> None:
    """Keep the context events of one micro-batch in a table."""
    events.write.mode("overwrite").parquet(f"{targets.context}/batch_id={batch_id}")


def write_trimmed(tagged: DataFrame, batch_id: int, path: str) -> None:
    """Write tagged readings of one micro-batch to the outputs kept, trimmed and pending, none dropped."""
    tagged.withColumn("output", output_of(F.col("disposition"))).write.mode("overwrite").partitionBy("output").parquet(
        f"{path}/batch_id={batch_id}")


def write_manifests(validated: DataFrame, batch_id: int, path: str) -> None:
    """Append validated manifests of one micro-batch to the audit trail, judged against the micro-batches before it."""
    spark = validated.sparkSession
    before = None
    if present(spark, path):
        earlier = spark.read.parquet(path).where(F.col("batch_id") < batch_id)
        before = manifests.highest_versions(earlier)
    rows = validated.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once; types are measured, then scanned
    try:
        manifests.manifest_history(rows, before=before).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    finally:
        rows.unpersist()


def read_bronze(spark: SparkSession, targets: Targets, **bounds) -> DataFrame:
    """Rows of the bronze table, by the bounds of ``Bronze.read``."""
    return open_table(spark, targets.bronze).read(**bounds)


def read_context(spark: SparkSession, targets: Targets) -> DataFrame:
    if present(spark, targets.context):
        return read_batches(spark, targets.context)
    return spark.createDataFrame([], schemas.CONTEXT)


def write_corrected(evaluated: DataFrame, batch_id: int, targets: Targets) -> None:
    """Write readings again whose context came after them."""
    if targets.evaluation:
        _write(parse.to_message(rules.evaluation(evaluated)), targets.evaluation, f"late-{batch_id}", targets)


def present(spark: SparkSession, path: str) -> bool:
    """Whether a folder has been written to, by Spark's own file system."""
    try:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").take(1))
    except AnalysisException:
        return False


def write_errors(parsed: DataFrame, batch_id: int, targets: Targets) -> None:
    """Write the dead letters of one micro-batch, keyed by device."""
    if targets.errors:
        letters = parse.dead_letters(parsed)
        _write(parse.to_message(letters, key="device_id"), targets.errors, batch_id, targets)


@contextmanager
def _partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """A query copies the session's settings when it starts, so they are set only for that moment."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(count or before))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *,
          once: bool = False, interval: str = FLUSH_INTERVAL, name: str | None = None,
          mode: str = "append", partitions: int | None = None) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``write``.

    ``once`` works off what there is and stops. A restart goes on from the checkpoint. A stateful
    query keeps the number of ``partitions`` of its first start; each has its own state store, so
    about one per core is right. The session's setting counts if none is given.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    with _partitions(df.sparkSession, partitions):
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def start_files(df: DataFrame, path: str, checkpoint: str, *, once: bool = False,
                interval: str = FLUSH_INTERVAL, partition_by: tuple[str, ...] = (),
                name: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Start a query into parquet files, exactly once by the sink's own log."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    with _partitions(df.sparkSession, partitions):
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def read_batches(spark, path: str) -> DataFrame:
    """All batches written to a folder target."""
    return spark.read.parquet(path).drop("batch_id")


