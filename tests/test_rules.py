import pytest
from pyspark.sql import functions as F

from millwatch.operators import context, rules
from tests import data


def fired(spark, rule, values):
    t = data.readings(spark, [("a", i, v) for i, v in enumerate(values)])
    rows = rules.evaluate(t, data.rule_table(spark, rule)).orderBy("seq").collect()
    assert all(r["passed"] == (r["alert"] is None) for r in rows)
    return [not r["passed"] for r in rows]


@pytest.mark.parametrize("rule, values, want", [
    (dict(condition="greater_than", threshold=5.0), [4.0, 5.0, 6.0, None], [False, False, True, False]),
    (dict(condition="less_than", threshold=5.0), [4.0, 5.0, 6.0, None], [True, False, False, False]),
    (dict(condition="between", lo=5.0, hi=6.0), [4.0, 5.0, 6.0, 7.0, None], [False, True, True, False, False]),
    (dict(condition="outside", lo=5.0, hi=6.0), [4.0, 5.0, 6.0, 7.0, None], [True, False, False, True, False]),
    (dict(condition="custom", params={"expr": "gas_temperature * 2 > 9 AND machine_id = 'a'"}), [4.0, 5.0, None],
     [False, True, False]),
    (dict(condition="greater_than", threshold=5.0, device_type="pump"), [6.0], [True]),
    (dict(condition="greater_than", threshold=5.0, device_type="turbine"), [6.0], [False]),
    (dict(condition="no_such", threshold=5.0), [6.0], [False]),
])
def test_conditions(spark, rule, values, want):
    assert fired(spark, rule, values) == want


def test_no_rules_pass_everything(spark):
    t = data.readings(spark, [("a", 1)])
    row = rules.evaluate(t, data.rule_table(spark, {}).where("false")).first()
    assert row["passed"] and row["alerts"] == []


def test_worst_alert_and_all_alerts(spark):
    table = data.rule_table(
        spark, dict(rule_id="b", threshold=1.0, severity="critical"), dict(rule_id="a", threshold=1.0, severity="critical"),
        dict(rule_id="0", threshold=1.0, severity="info"))
    e = rules.evaluate(data.readings(spark, [("m", 1, 9.0)]), table)
    assert e.first()["alert"]["rule_id"] == "a"
    assert sorted(r["rule_id"] for r in rules.alerts(e).collect()) == ["0", "a", "b"]
    assert e.first()["alert"]["message"] == "rule a on gas_temperature (greater_than)"


def test_latest_rule_wins_and_null_is_enabled(spark):
    table = data.rule_table(spark, dict(rule_id="x", threshold=1.0, offset=0), dict(rule_id="x", threshold=2.0, offset=1),
                            dict(rule_id="y", enabled=None), dict(rule_id="z", enabled=False),
                            dict(rule_id="w", enabled=True, offset=0), dict(rule_id="w", enabled=False, offset=3))
    got = {r["rule_id"]: r["threshold"] for r in rules.latest_rules(table).collect()}
    assert got == {"x": 2.0, "y": None}


def test_table_path_for_many_rules(spark, monkeypatch):
    monkeypatch.setattr(rules, "localize", lambda df: (df, None))
    table = data.rule_table(spark, dict(rule_id="p", threshold=5.0, device_type="pump"), dict(rule_id="q", threshold=7.0),
                            dict(rule_id="c", condition="custom", params={"expr": "gas_temperature > 8"}))
    e = rules.evaluate(data.readings(spark, [("m", i, float(i)) for i in range(10)]), table)
    assert sorted(r["rule_id"] for r in rules.alerts(e).collect()) == sorted("pppp" + "qq" + "c")


def test_rate(spark):
    t = data.readings(spark, [("a", 0, 1.0), ("a", 1000, 3.0), ("a", 1000, 9.0), ("a", 2000, None), ("a", 3000, 5.0)])
    got = [r["gas_temperature_rate"] for r in rules.rate_of_change(t, "gas_temperature").orderBy("seq").collect()]
    assert got == [None, 2.0, None, None, -2.0]


def test_rate_rules(spark):
    t = rules.rate_of_change(data.readings(spark, [("a", 0, 1.0), ("a", 1000, 3.0), ("a", 2000, 1.0)]), "gas_temperature")
    table = data.rule_table(spark, dict(rule_id="up", condition="rate_above", threshold=1.0),
                            dict(rule_id="down", condition="rate_below", threshold=-1.0))
    got = [(r["timestamp"], r["alert"] and r["alert"]["rule_id"]) for r in rules.evaluate(t, table).orderBy("seq").collect()]
    assert got == [(0, None), (1000, "up"), (2000, "down")]
    bare = rules.evaluate(data.readings(spark, [("a", 0, 1.0), ("a", 1000, 3.0), ("a", 2000, 1.0)]), table)
    assert [r["passed"] for r in bare.orderBy("seq").collect()] == [True, False, False]


@pytest.mark.parametrize("times, values, want", [
    ([0, 4000, 10000], [9.0, 9.0, 9.0], [10000]),
    ([0, 4000, 6000, 10000], [9.0, 9.0, 1.0, 9.0], []),
    ([0, 4000, 6000, 10000], [9.0, 9.0, None, 9.0], []),
])
def test_sustained(spark, times, values, want):
    t = data.readings(spark, [("a", ts, v) for ts, v in zip(times, values)])
    got = rules.sustained_rules(t, data.rule_table(spark, dict(threshold=5.0, durationSec=10.0)))
    assert [r["alert_time"] for r in got.collect()] == want


def test_rules_with_a_duration_are_not_instant(spark):
    t = data.readings(spark, [("a", 0, 9.0)])
    assert rules.evaluate(t, data.rule_table(spark, dict(threshold=5.0, durationSec=10.0))).first()["passed"]


def test_windowed(spark):
    window = F.struct(F.lit("tumbling").alias("type"), F.lit(10.0).alias("sizeSeconds"), F.lit(0.0).alias("slideSeconds"))
    table = data.rule_table(spark, dict(threshold=5.0)).withColumn("window", window)
    t = data.readings(spark, [("a", 0, 4.0), ("a", 9999, 8.0), ("a", 10000, 5.0)])
    got = rules.windowed_rules(t, table).collect()
    assert [(r["alert_time"], r["value"]) for r in got] == [(10000, 6.0)]
    assert rules.windowed_rules(t, table.where("false")).collect() == []


def test_no_shuffle_of_readings(spark):
    t = data.readings(spark, [("a", 0, 9.0)])
    plan = rules.evaluate(t, data.rule_table(spark, dict(threshold=5.0)))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_one_shuffle_for_rates_context_and_rules(spark):
    t, c = data.readings(spark, [("a", 0, 9.0)]), data.context(spark, [("a", "r", "trackin", 0)])
    rated = rules.rate_of_change(t, "gas_temperature")
    e = rules.evaluate(context.attach_context(rated, c, anomalies=True), data.rule_table(spark, dict(threshold=5.0)))
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(machine_id") == 1
    assert plan.count("Exchange hashpartitioning(device_id") == 1


def _readings(spark, values, kind="pump"):
    rows = [("m", kind, t * 1000, float(v), float(v)) for t, v in values]
    df = spark.createDataFrame(rows, "machine_id string, machine_type string, timestamp long, gas_temperature double, gas_pressure double")
    for m in ("humidity", "spin_rate", "torque"):
        df = df.withColumn(m, F.lit(None).cast("double"))
    return df


def _rules(spark, *rows):
    schema = ("rule_id string, measurement string, condition string, threshold double, lo double, hi double, severity string, "
              "durationSec double, window struct<type:string,sizeSeconds:double,slideSeconds:double>, params map<string,string>")
    base = dict.fromkeys(("rule_id", "measurement", "condition", "threshold", "lo", "hi", "severity", "durationSec", "window", "params"))
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


def _fired(df):
    return sorted((r["rule_id"], r["alert_time"] // 1000) for r in df.collect())


def test_rate_and_custom_conditions_last(spark):
    readings = _readings(spark, [(0, 0), (1, 5), (2, 10), (3, 15), (4, 15)])
    rows = _rules(spark,
                  {"rule_id": "rate", "measurement": "gas_pressure", "condition": "rate_above", "threshold": 2.0, "durationSec": 2.0},
                  {"rule_id": "own", "measurement": "gas_temperature", "condition": "custom", "durationSec": 2.0, "params": {"expr": "gas_temperature + gas_pressure >= 20"}})
    assert _fired(rules.sustained_rules(readings, rows)) == [("own", 4), ("rate", 3)]


def test_instant_type_with_a_size_fires_once_per_reading(spark):
    readings = _readings(spark, [(0, 5), (1, 5)])
    rows = _rules(spark, {"rule_id": "r", "measurement": "gas_pressure", "condition": "greater_than", "threshold": 1.0, "window": ("instant", 60.0, None)})
    assert rules.alerts(rules.evaluate(readings, rows)).count() == 2
    assert rules.windowed_rules(readings, rows).count() == 0


def test_windows_that_must_last(spark):
    readings = _readings(spark, [(t, 9 if t < 45 else 0) for t in range(0, 60, 5)])
    w = ("tumbling", 10.0, None)
    rows = _rules(spark, {"rule_id": "r", "measurement": "gas_pressure", "condition": "greater_than", "threshold": 8.0, "window": w, "durationSec": 20.0})
    assert _fired(rules.windowed_rules(readings, rows)) == [("r", 30), ("r", 40)]


def test_window_aggregates_and_rates_over_windows(spark):
    readings = _readings(spark, [(0, 1), (5, 3), (10, 50), (15, 50)])
    w = ("tumbling", 10.0, None)
    rows = _rules(spark, *[
        {"rule_id": a, "measurement": "gas_pressure", "condition": "greater_than", "threshold": x, "window": w, "params": {"aggregate": a}}
        for a, x in (("avg", 40.0), ("min", 40.0), ("max", 2.0), ("sum", 3.0), ("count", 1.0), ("stddev", 1.0), ("median", 0.0))],
        {"rule_id": "rate", "measurement": "gas_pressure", "condition": "rate_above", "threshold": 4.0, "window": w})
    assert _fired(rules.windowed_rules(readings, rows)) == [
        ("avg", 20), ("count", 10), ("count", 20), ("max", 10), ("max", 20), ("min", 20), ("rate", 20), ("stddev", 10), ("sum", 10), ("sum", 20)]


def test_bad_rules_are_rejected_and_the_others_fire(spark):
    readings = _readings(spark, [(0, 5)])
    rows = _rules(spark,
                  {"rule_id": "good", "measurement": "gas_pressure", "condition": "greater_than", "threshold": 1.0},
                  {"rule_id": "expr", "measurement": "gas_pressure", "condition": "custom", "params": {"expr": "gas_pressure > 1 and abs(gas_temperature) < 9"}},
                  {"rule_id": "cond", "measurement": "gas_pressure", "condition": "over", "threshold": 1.0},
                  {"rule_id": "name", "measurement": "nosuch", "condition": "greater_than", "threshold": 1.0},
                  {"rule_id": "none", "measurement": "gas_pressure", "condition": "less_than"},
                  {"rule_id": "range", "measurement": "gas_pressure", "condition": "between", "lo": 1.0},
                  {"rule_id": "column", "measurement": "gas_pressure", "condition": "custom", "params": {"expr": "nosuch > 1"}},
                  {"rule_id": "call", "measurement": "gas_pressure", "condition": "custom", "params": {"expr": "reflect('java.lang.System', 'nanoTime') is not null"}},
                  {"rule_id": "agg", "measurement": "gas_pressure", "condition": "greater_than", "threshold": 0.0, "window": ("tumbling", 10.0, None), "params": {"aggregate": "median"}})
    assert {r["rule_id"] for r in rules.alerts(rules.evaluate(readings, rows)).collect()} == {"good", "expr"}
    assert {r["rule_id"] for r in rules.rejected_rules(rows, readings).collect()} == {"cond", "name", "none", "range", "column", "call", "agg"}
    assert {r["rule_id"] for r in rules.good_rules(rows, readings).collect()} == {"good", "expr"}


def test_latest_rules_without_enabled(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2)], "rule_id string, offset long")
    assert [tuple(r) for r in rules.latest_rules(rows).collect()] == [("a", 2)]


def test_rates_that_rules_need_are_added(spark):
    t = rules.rate_of_change(_readings(spark, [(0, 0), (1, 5)]), "gas_temperature")
    rows = _rules(spark, {"rule_id": "r", "measurement": "gas_pressure", "condition": "rate_above", "threshold": 2.0})
    out = rules.evaluate(t, rows)
    assert "gas_pressure_rate" not in out.columns and rules.alerts(out).count() == 1


BYPASSES = [
    "`reflect`('java.lang.System', 'nanoTime') is not null", "reflect/**/('java.lang.System', 'nanoTime') is not null",
    "status = \"'\" or reflect('java.lang.System', 'nanoTime') = \"'\"", "java_method('java.lang.System', 'exit', 0) > 0",
    "gas_temperature = (select 1)", "exists(select 1)", "gas_temperature in (select 1)", "count(*) > 1", "sum(gas_temperature) over () > 1",
    "system.builtin.reflect('java.lang.System', 'nanoTime') is not null", "transform(array(1), x -> x)[0] = 1", "raise_error('x') is null",
    "input_file_name() = 'x'", "gas_temperature; drop table x", "gas_temperature", "machine_id > 1", "nosuch > 1", "*", "", "abs(*) > 1",
    "cast(machine_id as int) > 1", "gas_temperature > machine_id", "abs(1, 2) > 1", "machine_id rlike '('", "timestamp > interval 1 day",
    "-" * 300 + "1 > 0", "(" * 3000, "1 > 0 and " * 800 + "true",
]


@pytest.mark.parametrize("text", BYPASSES, ids=range(len(BYPASSES)))
def test_texts_that_are_not_plain_conditions_are_refused(spark, text):
    from millwatch.operators.expressions import usable

    assert not usable(text, data.readings(spark, [("a", 1, 9.0)]).limit(0))


@pytest.mark.parametrize("text, want", [
    ("gas_temperature + 1 > 9 and not (machine_id like 'b%')", True), ("gas_temperature / 0 > 1", None), ("gas_temperature % 0 = 1", None),
    ("timestamp + 9223372036854775807 > 0", None), ("gas_temperature div 2 = 4", True), ("-gas_temperature between -9.5 and -8.5", True),
    ("case when gas_temperature > 8 then humidity else 0 end = 50", True), ("if(machine_id = 'a', 1, 0) = 1", True),
    ("machine_id in ('x', 'a')", True), ("coalesce(fault_code, 'none') = 'none'", True), ("nullif(gas_temperature, 9) is null", True),
    ("greatest(gas_temperature, humidity, 3) = 50 and sqrt(gas_temperature) = 3", True), ("fault_code = 'x'", None), ("null", None),
    ("pow(gas_temperature, 2) = 81 and pmod(-gas_temperature, 2) = 1 and round(gas_temperature / 4) = 2 and mod(9, 0) is null", True),
    ("fault_code <=> null and isnull(fault_code) and upper(machine_id) = 'A' and length(status) = 7", True), ("`gas_temperature` /* x */ > 8", True),
])
def test_conditions_are_built_from_their_text(spark, text, want):
    from millwatch.operators.expressions import condition

    row = data.readings(spark, [("a", 1, 9.0)])
    assert row.select(condition(text, row.limit(0)).alias("c")).first()["c"] is want
