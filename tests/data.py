"""Small hand-made tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from millwatch import schemas

TEL = "machine_id string, machine_type string, timestamp bigint, seq bigint, gas_temperature double, humidity double"
CTX = "device_id string, run_id string, event_type string, timestamp bigint, start_ts bigint, end_ts bigint, seq bigint"


def readings(spark, rows):
    """(machine, timestamp[, temperature[, humidity]]) rows as telemetry."""
    full = [(r[0], "pump", r[1], i, r[2] if len(r) > 2 else 1.0, r[3] if len(r) > 3 else 50.0)
            for i, r in enumerate(rows)]
    return spark.createDataFrame(full, TEL).withColumns({
        "gas_pressure": F.lit(1.0), "spin_rate": F.lit(1.0), "torque": F.lit(1.0),
        "status": F.lit("running"), "fault_code": F.lit(None).cast("string")})


def context(spark, rows):
    """(device, run, event_type, timestamp) rows as context events."""
    return spark.createDataFrame(
        [(d, r, e, t, t if e == schemas.TRACKIN else None, t if e == schemas.TRACKOUT else None, i)
         for i, (d, r, e, t) in enumerate(rows)], CTX)


def lopsided(spark, n=600, seed=7):
    """Readings and context in which one machine has a third of all rows, some at the same time."""
    rnd = random.Random(seed)
    names = ["hot"] * (n // 3) + [f"m{rnd.randrange(20)}" for _ in range(n - n // 3)]
    tel = [(m, rnd.randrange(2000) * 10, round(rnd.uniform(0, 100), 2), float(rnd.randrange(100))) for m in names]
    ctx = [(rnd.choice(["hot", "hot", "m1", "m2", "m3"]), f"r{i}", rnd.choice([schemas.TRACKIN, schemas.TRACKOUT]),
            rnd.randrange(2000) * 10) for i in range(n // 4)]
    return tel, ctx


def rule(spark, **fields):
    base = dict(rule_id="r", device_type=None, measurement="gas_temperature", condition="greater_than", threshold=None,
                lo=None, hi=None, severity="warning", enabled=True, durationSec=None, offset=0)
    return {**base, **fields}


RULES = ("rule_id string, device_type string, measurement string, condition string, threshold double, lo double, "
         "hi double, severity string, enabled boolean, durationSec double, offset bigint, params map<string,string>")


def rule_table(spark, *rules):
    names = [f.split()[0] for f in RULES.split(", ")]
    return spark.createDataFrame([tuple({**rule(spark), **r}.get(n) for n in names) for r in rules], RULES)
