"""Parse JSON messages and part good rows from bad ones. Works on tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwatch import schemas
from millwatch.functions import scalars
from millwatch.functions.frames import once

_CORRUPT = "_corrupt_record"
#: A machine's clock may run ahead of a message's arrival by this much.
AHEAD_MS = 3_600_000
_RECORD = ("original_input", "topic", "partition", "offset", "arrival_time")
_ERROR = ("error_type", "error_message")


def parse_telemetry(raw: DataFrame) -> DataFrame:
    """Readings from the live vocabulary, ``machine_id`` / ``timestamp``. Unknown keys are ignored."""
    return parse(raw, schemas.TELEMETRY, required=("machine_id", "timestamp"), numeric=("timestamp",))


def parse_generic(raw: DataFrame, device_field: str = "deviceId", time_field: str = "ts") -> DataFrame:
    """Readings from the general vocabulary, ``deviceId`` / ``ts`` / ``measurements``.

    A manifest's ``defaults`` may name the first two fields otherwise.
    """
    shape = T.StructType([
        T.StructField(device_field, T.StringType()), T.StructField(time_field, T.LongType()),
        schemas.GENERIC_TELEMETRY["measurements"]])
    return parse(raw, shape, required=(device_field, time_field, "measurements"), numeric=(time_field,))


def to_readings(generic: DataFrame, device_field: str = "deviceId", time_field: str = "ts",
                time_unit: str = "ms") -> DataFrame:
    """General readings in the live vocabulary: one column per known measurement, epoch ms. (s)"""
    return generic.select(
        F.col(device_field).alias("machine_id"),
        scalars.to_millis(F.col(time_field), F.lit(time_unit)).alias("timestamp"),
        *[F.col("measurements")[m].alias(m) for m in schemas.MEASUREMENTS])


def parse_context(raw: DataFrame) -> DataFrame:
    return parse(raw, schemas.CONTEXT, required=("device_id", "timestamp"), numeric=("timestamp",))


def parse_rules(raw: DataFrame) -> DataFrame:
    return parse(raw, schemas.RULE, required=("rule_id",))


def parse(raw: DataFrame, schema: T.StructType, *, required: Sequence[str],
          numeric: Sequence[str] = ()) -> DataFrame:
    """Typed columns plus the record's own columns and ``error_type`` / ``error_message``.

    The record's offset, arrival time and text are kept, so bad rows can be traced and replayed.
    """
    text = F.col("value").cast("string")
    known = {"topic": "string", "partition": "int", "offset": "bigint", "timestamp": "timestamp"}
    record = raw.select(
        text.alias("original_input"),
        *[(F.col(c) if c in raw.columns else F.lit(None)).cast(t)
          .alias("arrival_time" if c == "timestamp" else c) for c, t in known.items()],
    )
    options = {"columnNameOfCorruptRecord": _CORRUPT, "allowNonNumericNumbers": "false"}
    shape = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = once(record, "_m", F.from_json("original_input", shape, options))
    return classify_errors(parsed, required, numeric).select(
        *_RECORD, *[F.col(f"_m.{f.name}").alias(f.name, metadata=f.metadata) for f in schema.fields], *_ERROR)


def classify_errors(parsed: DataFrame, required: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Tag every row with its first error; good rows are parsed once and not looked at again."""
    text = F.col("original_input")
    corrupt = F.col(f"_m.{_CORRUPT}").isNotNull()
    absent = [F.col(f"_m.{n}").isNull() for n in required]
    incomplete = F.lit(False)
    for a in absent:
        incomplete = incomplete | a
    suspect = corrupt | incomplete
    blank = text.isNull() | (F.trim(text) == "")
    # Only suspect rows reach these: the JSON text tells a missing key from a wrong type.
    unreadable = blank | (suspect & F.try_parse_json(text).isNull())
    gone = [a & F.get_json_object(text, f"$.{n}").isNull() for n, a in zip(required, absent)]
    kind, message = F.when(unreadable, schemas.JSON_PARSE_ERROR), F.when(unreadable, "Invalid JSON")
    for name, g in zip(required, gone):
        kind = kind.when(g, schemas.SCHEMA_VALIDATION_ERROR)
        message = message.when(g, f"Missing required field: {name}")
    for name in numeric:
        wrong = corrupt & F.col(f"_m.{name}").isNull()
        kind = kind.when(wrong, schemas.TYPE_CONVERSION_ERROR)
        message = message.when(wrong, f"Field '{name}' must be numeric")
    return parsed.withColumns({
        "error_type": kind.when(suspect, schemas.TYPE_CONVERSION_ERROR),
        "error_message": message.when(suspect, "Field has the wrong type"),
    })


def check_clock(parsed: DataFrame, ahead_ms: int = AHEAD_MS) -> DataFrame:
    """Tag rows whose ``timestamp`` is over ``ahead_ms`` after their arrival (now, where no arrival is known). (s)

    Such a time is a wrong clock. In a stream it would carry the watermark away from all other machines, so
    these rows become dead letters and never reach it.
    """
    arrival = F.unix_millis(F.coalesce("arrival_time", F.current_timestamp()))
    wrong = F.col("error_type").isNull() & (F.col("timestamp") > arrival + ahead_ms)
    return parsed.withColumns({
        "error_type": F.when(wrong, schemas.CLOCK_ERROR).otherwise(F.col("error_type")),
        "error_message": F.when(wrong, "Time is ahead of arrival").otherwise(F.col("error_message")),
    })


def good(df: DataFrame, *, keep_record: bool = False) -> DataFrame:
    """Rows without an error. The record's own columns go too, unless kept."""
    rows = df.where(F.col("error_type").isNull()).drop(*_ERROR)
    return rows if keep_record else rows.drop(*_RECORD)


def dead_letters(df: DataFrame, source: str = "telemetry-parser",
                 now: Column | int | None = None) -> DataFrame:
    """Rows with an error, as dead-letter messages. ``stack_trace`` is null: no exception is thrown.

    Rows that have a ``source`` column name their source themselves.
    """
    text = F.col("original_input")
    origin = F.col("source") if "source" in df.columns else F.lit(source)
    return df.where(F.col("error_type").isNotNull()).select(
        scalars.iso_instant(scalars.now_ms(now)).alias("timestamp"),
        origin.alias("source"),
        "error_type",
        "error_message",
        F.lit(None).cast("string").alias("stack_trace"),
        scalars.truncate(text).alias("original_input"),
        scalars.device_id_of(text).alias("device_id"),
        scalars.stable_id(origin, F.col("topic"), F.col("partition"), F.col("offset"), text)
        .alias("request_id"),
    )


def failures(parsed: DataFrame, source: str) -> DataFrame:
    """Rows with an error, with their source and without the columns of their topic, so topics can be put together. (s)"""
    return parsed.where(F.col("error_type").isNotNull()).select(F.lit(source).alias("source"), *_RECORD, *_ERROR)


def log_lines(letters: DataFrame) -> DataFrame:
    """Dead letters as short lines for a log: why, where from, which machine, then the start of the text."""
    machine = F.coalesce("device_id", F.lit("a machine without a name"))
    text = F.coalesce(scalars.truncate(F.col("original_input"), scalars.MAX_LOG), F.lit(""))
    return letters.select("request_id", F.concat(
        "error_type", F.lit(" in "), "source", F.lit(" from "), machine, F.lit(", no. "), "request_id", F.lit(": "), text).alias("line"))


def to_message(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON records for a topic. Null fields are written, and the key may be null."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(body) if key is None else df.select(F.col(key).cast("string").alias("key"), body)
