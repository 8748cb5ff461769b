"""Windows folded from panes against Spark's own windows."""

import random

import pytest
from pyspark.sql import functions as F

from millwatch.operators import rules, windows
from tests.test_rule_state import SET, TEL, readings, rule_rows


def table(spark, n=400, seed=4):
    rows = readings(n, seed)
    return spark.createDataFrame([tuple(r.get(f.split()[0]) for f in TEL.split(", ")) for r in rows], TEL)


def by_spark(df, size, slide):
    w = F.window(F.timestamp_millis("timestamp"), size, slide)
    return df.groupBy("machine_id", w.alias("w")).agg(
        F.count(F.lit(1)).alias("n"), *[f("torque").alias(f"torque_{n}") for n, f in (
            ("min", F.min), ("max", F.max), ("avg", F.avg), ("stddev", F.stddev_samp))]
    ).select("machine_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
             *[f"torque_{s}" for s in ("min", "max", "avg", "stddev")])


def close(df):
    return sorted((r["machine_id"], r["window_start"], r["window_end"], r["n"], *[
        None if r[f"torque_{s}"] is None else round(r[f"torque_{s}"], 6) for s in ("min", "max", "avg", "stddev")]) for r in df.collect())


@pytest.mark.parametrize("size, slide", [("12 seconds", "4 seconds"), ("10 seconds", "4 seconds"), ("1 minute", "1 second"), ("9 seconds", "9 seconds")])
def test_sliding_windows_are_sparks(spark, size, slide):
    df = table(spark)
    assert close(windows.window_stats(df, size, slide, measurements=["torque"])) == close(by_spark(df, size, slide))


def test_deviation_of_large_values(spark):
    rnd = random.Random(1)
    rows = [("m", t * 1000, 1e9 + rnd.random()) for t in range(200)]
    df = spark.createDataFrame(rows, "machine_id string, timestamp bigint, torque double")
    got = windows.window_stats(df, "20 seconds", "5 seconds", measurements=["torque"]).collect()
    want = {r["window_start"]: r["torque_stddev"] for r in by_spark(df, "20 seconds", "5 seconds").collect()}
    assert len(got) == len(want) and all(abs(r["torque_stddev"] - want[r["window_start"]]) < 1e-6 for r in got if want[r["window_start"]] is not None)


def test_one_scan_and_no_copied_readings(spark, tmp_path):
    table(spark).write.parquet(f"{tmp_path}/t")
    alerts = rules.windowed_rules(spark.read.parquet(f"{tmp_path}/t"), rule_rows(spark, *SET))
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    # the explode is over panes, behind the first aggregation
    assert plan.index("Generate") < plan.index("FileScan") and plan.rindex("Generate") < plan.rindex("HashAggregate")


def test_interval_texts():
    assert [windows.millis(t) for t in ("1 day", "90 minutes", "250 milliseconds", "1 month", "x", "0 days")] == [86_400_000, 5_400_000, 250, None, None, None]
