import json

import pytest
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import scalars
from millwatch.functions.safe import safe
from millwatch.operators import parse
from millwatch.sources.topics import read_topic

GOOD = '{"machine_id":"M1","timestamp":12,"gas_temperature":1.5,"extra":{"a":1}}'


def raw(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset bigint")


@pytest.mark.parametrize("text, kind", [
    (GOOD, None),
    (GOOD + " trailing", None),
    (None, "JSON_PARSE_ERROR"),
    ("", "JSON_PARSE_ERROR"),
    ("   ", "JSON_PARSE_ERROR"),
    ('{"machine_id":"M', "JSON_PARSE_ERROR"),
    ("not json", "JSON_PARSE_ERROR"),
    ("NaN", "JSON_PARSE_ERROR"),
    ("null", "SCHEMA_VALIDATION_ERROR"),
    ("[1]", "SCHEMA_VALIDATION_ERROR"),
    ("{}", "SCHEMA_VALIDATION_ERROR"),
    ('{"timestamp":12}', "SCHEMA_VALIDATION_ERROR"),
    ('{"machine_id":"M1"}', "SCHEMA_VALIDATION_ERROR"),
    ('{"machine_id":"M1","timestamp":null}', "SCHEMA_VALIDATION_ERROR"),
    ('{"machine_id":"M1","timestamp":"12"}', "TYPE_CONVERSION_ERROR"),
    ('{"machine_id":"M1","timestamp":1.5}', "TYPE_CONVERSION_ERROR"),
    ('{"machine_id":"M1","timestamp":12,"torque":"high"}', "TYPE_CONVERSION_ERROR"),
    ('{"machine_id":7,"timestamp":12}', None),
])
def test_error_types(spark, text, kind):
    row = parse.parse_telemetry(raw(spark, [text])).first()
    assert row["error_type"] == kind
    assert (row["error_message"] is None) == (kind is None)


def test_good_rows_and_units(spark):
    rows = parse.good(parse.parse_telemetry(raw(spark, [GOOD, "x"])))
    assert rows.schema["gas_temperature"].metadata == {"unit": "°C"}
    assert rows.columns == schemas.TELEMETRY.names
    assert [r["machine_id"] for r in rows.collect()] == ["M1"]


def test_messages(spark):
    rows = raw(spark, ['{"machine_id":"M1","timestamp":1.5}', '{"timestamp":1}', "x"])
    got = [r["error_message"] for r in parse.parse_telemetry(rows).orderBy("offset").collect()]
    assert got == ["Field 'timestamp' must be numeric", "Missing required field: machine_id", "Invalid JSON"]


def test_dead_letters(spark):
    rows = raw(spark, ["x" * 3000, '{"deviceId":"D9"}'])
    first = parse.dead_letters(parse.parse_telemetry(rows), now=0).orderBy(F.length("original_input").desc()).collect()
    assert len(first[0]["original_input"]) == 2051 and first[0]["original_input"].endswith("x...")
    assert first[0]["timestamp"] == "1970-01-01T00:00:00Z" and first[0]["stack_trace"] is None
    assert first[1]["device_id"] == "D9"
    again = parse.dead_letters(parse.parse_telemetry(rows), now=5)
    assert {r["request_id"] for r in again.collect()} == {r["request_id"] for r in first}
    line = parse.log_lines(parse.dead_letters(parse.parse_telemetry(raw(spark, ["{"])))).first()["line"]
    assert line.startswith("JSON_PARSE_ERROR in telemetry-parser from a machine without a name, no. ") and line.endswith(": {")


def test_generic_needs_measurements(spark):
    rows = raw(spark, ['{"deviceId":"D","ts":1,"measurements":{"t":2.5}}', '{"deviceId":"D","ts":1}'])
    got = parse.parse_generic(rows).orderBy("offset").collect()
    assert got[0]["measurements"] == {"t": 2.5} and got[0]["error_type"] is None
    assert got[1]["error_message"] == "Missing required field: measurements"


def test_generic_with_a_manifest_s_field_names(spark):
    rows = parse.parse_generic(raw(spark, ['{"id":"D","t":2,"measurements":{"torque":2.5}}']), "id", "t")
    got = parse.to_readings(parse.good(rows), "id", "t", "s").first()
    assert (got["machine_id"], got["timestamp"], got["torque"], got["humidity"]) == ("D", 2000, 2.5, None)


def test_rules_and_context(spark):
    rule = parse.good(parse.parse_rules(raw(spark, ['{"rule_id":"r","threshold":3,"window":{"type":"tumbling"}}']))).first()
    assert rule["threshold"] == 3.0 and rule["enabled"] is None and rule["window"]["type"] == "tumbling"
    ctx = parse.good(parse.parse_context(raw(spark, ['{"device_id":"d","run_id":"r","event_type":"trackin","timestamp":1}']))).first()
    assert ctx["event_type"] == "trackin"


def test_nulls_are_written(spark):
    body = parse.to_message(spark.sql("select 'a' as k, cast(null as string) as v"), key="k").first()
    assert json.loads(body["value"]) == {"k": "a", "v": None} and body["key"] == "a"


@pytest.mark.parametrize("text, want", [(None, None), ("x" * 2048, "x" * 2048), ("x" * 2049, "x" * 2048 + "...")])
def test_truncate(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalars.truncate(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("text, lo", [("[1, 2.5]", 1.0), ("[1]", None), ("[1,2,3]", None), ("3", None), ('["a",2]', None), (None, None)])
def test_threshold_range(spark, text, lo):
    got = spark.createDataFrame([(text,)], "t string").select(scalars.threshold_range(F.col("t"))["lo"]).first()[0]
    assert got == lo


def test_safe_turns_errors_into_data(spark):
    half = safe(lambda x: 10 // x, "bigint")
    got = spark.createDataFrame([(5,), (0,)], "x bigint").select(half("x").alias("r")).collect()
    assert got[0]["r"]["ok"] == 2 and got[0]["r"]["error"] is None
    assert got[1]["r"]["ok"] is None and got[1]["r"]["error"].startswith("ZeroDivisionError")


def test_file_topics(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text(GOOD + "\nbad\n")
    rows = read_topic(spark, schemas.TELEMETRY_TOPIC, format="json", path=str(tmp_path / "lines"))
    assert parse.parse_telemetry(rows).groupBy("error_type").count().count() == 2
    record = spark.createDataFrame([(None, bytearray(GOOD, "utf8"), schemas.TELEMETRY_TOPIC, 0, 5, None),
                                    (None, bytearray(b"{}"), "other", 0, 6, None)], schemas.RECORD)
    record.write.parquet(str(tmp_path / "records"))
    rows = read_topic(spark, schemas.TELEMETRY_TOPIC, format="parquet", path=str(tmp_path / "records"))
    assert [r["offset"] for r in parse.parse_telemetry(rows).collect()] == [5]
    with pytest.raises(ValueError):
        read_topic(spark, "t", format="csv", path="x")
