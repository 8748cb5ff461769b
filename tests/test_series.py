import datetime as dt

from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.operators import dims, kpi, quality, series, windows
from millwatch.streaming import sinks
from tests import data

DAY = 86_400_000


def test_last_value_skips_nulls(spark):
    t = data.readings(spark, [("a", 1, 5.0), ("a", 2, 6.0), ("a", 3, None)])
    row = series.last_value(t, "gas_temperature").first()
    assert (row["gas_temperature"], row["timestamp"]) == (6.0, 2)


def test_bronze_round_trip_prunes(spark, tmp_path):
    rows = [(m, d * DAY + i * 1000, float(i)) for m in ("a", "b") for d in range(3) for i in range(5)]
    sinks.write_bronze(data.readings(spark, rows), str(tmp_path / "b"))
    b = spark.read.parquet(str(tmp_path / "b"))
    assert b.count() == 30
    since = F.lit(dt.datetime(1970, 1, 3)).cast("timestamp")
    got = series.series(b, "gas_temperature", since=since, devices=["a"], prefix="root.factory1.*")
    assert got.count() == 4  # the bound itself is left out
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    scan = plan[plan.index("FileScan"):]
    assert "humidity" not in scan and "torque" not in scan


def test_list_wide_and_dedupe(spark):
    t = data.readings(spark, [("a", 1, None), ("b", 1, 2.0), ("a", 1, 3.0)])
    listed = {(r["device_id"], r["measurement"]) for r in series.series_list(t, ["gas_temperature"]).collect()}
    assert listed == {("a", "gas_temperature"), ("b", "gas_temperature")}
    wide = series.series_wide(t, "gas_temperature", ["a", "b", "c"]).first()
    assert (wide["a"], wide["b"], wide["c"]) == (3.0, 2.0, None)
    assert {r["seq"] for r in series.dedupe(t).collect()} == {1, 2}


def test_color_steps(spark):
    t = data.readings(spark, [("a", 1, 79.9), ("a", 2, 80.0), ("a", 3, None)])
    assert [r["color"] for r in series.color_class(t, "gas_temperature").orderBy("timestamp").collect()] == ["green", "red", None]


def test_exists(spark):
    t = data.readings(spark, [("a", 1)])
    assert series.exists(t).first()["present"] and not series.exists(t.where("false")).first()["present"]


def test_fault_bands(spark):
    t = data.readings(spark, [("a", 1, 500.0, 10.0), ("a", 2, 400.0, 50.0), ("a", 3, None, 15.0)]).withColumn("gas_pressure", F.lit(5.0))
    got = {r["timestamp"]: r["profiles"] for r in dims.fault_bands(t, dims.fault_band_table(spark)).collect()}
    assert got == {1: ["low_humidity", "overtemp"], 2: [], 3: ["low_humidity"]}


def test_utilization(spark):
    t = data.readings(spark, [("a", 0), ("a", 10), ("a", 40)]).withColumn(
        "status", F.when(F.col("timestamp") == 10, "fault").otherwise("running"))
    row = kpi.utilization(t).first()
    assert (row["running_ms"], row["total_ms"], row["utilization"]) == (10, 40, 0.25)


def test_sessions_end_at_the_gap(spark):
    t = data.readings(spark, [("a", 0), ("a", 999), ("a", 1999), ("b", 5)])
    got = sorted((r["machine_id"], r["n"]) for r in windows.sessions(t, 1000).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1)]


def test_lag_and_counters(spark):
    rows = spark.createDataFrame([("t", 0, 5, 3), ("t", 0, 9, None), ("t", 1, 2, None)],
                                 "topic string, partition int, offset bigint, committed bigint")
    assert {r["partition"]: r["lag"] for r in quality.lag(rows).collect()} == {0: 6, 1: 3}
    row = quality.counters(rows, first="partition = 0", late=F.col("offset") > 4).first()
    assert (row["total"], row["first"], row["late"]) == (3, 2, 2)


def test_dlq_rate_needs_more_than_the_limit(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), "x" if i == 0 else None) for i in range(100)],
                                 "arrival_time timestamp, error_type string")
    assert quality.dlq_rate(rows).collect() == []
    assert quality.dlq_rate(rows, limit=0.009).count() == 1


def test_units_are_fixed():
    assert list(schemas.UNITS) == list(schemas.MEASUREMENTS)


def test_percentiles_are_exact_ranks(spark):
    rows = [(g, v) for g, n in (("a", 20_000), ("b", 7), (None, 100)) for v in range(n)] + [("c", None)] + [("a", 5)] * 900 + [(None, None)]
    df = spark.createDataFrame(rows, "g string, latency_ms long").repartition(4)
    got = {r["g"]: tuple(r)[1:] for r in quality.latency_percentiles(df, by=["g"]).collect()}
    held = {}
    for g, v in rows:
        held.setdefault(g, []).extend([v] if v is not None else [])
    for g, values in held.items():
        values.sort()
        n = len(values)
        want = tuple(values[-(-n * p // 100) - 1] if n else None for p in (50, 95, 99))
        assert got[g] == (n, *want), g
    assert len(got) == 4
    everything = sorted(v for _, v in rows if v is not None)
    one = quality.latency_percentiles(df).collect()
    assert [tuple(r) for r in one] == [(len(everything), *(everything[-(-len(everything) * p // 100) - 1] for p in (50, 95, 99)))]
    assert [tuple(r) for r in quality.latency_percentiles(df.limit(0)).collect()] == [(0, None, None, None)]


def test_percentiles_of_over_a_million_rows(spark):
    # ranks of a sketch may be off by rows / 1,000,000
    n = 3_000_001
    df = spark.range(n).select(((F.col("id") * 1_000_003) % n).alias("latency_ms"))
    want = tuple(-(-n * p // 100) - 1 for p in (50, 95, 99))
    assert tuple(quality.latency_percentiles(df).first()) == (n, *want)
    assert "percentile_approx(latency_ms" not in quality.latency_percentiles(df)._jdf.queryExecution().toString()
