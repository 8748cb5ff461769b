"""Rules over several readings on streams: in any order of arrival the log of changes adds up to the tables' answer."""

import random

import pytest
from pyspark.sql import functions as F

from millwatch.operators import rules
from millwatch.streaming import rule_state
from tests.test_streaming import drain, stream, write_file

TEL = ("machine_id string, machine_type string, timestamp bigint, seq bigint, gas_temperature double, gas_pressure double, "
       "humidity double, spin_rate double, torque double")
LAST = 10_000_000
WINDOW = "window struct<type:string,sizeSeconds:double,slideSeconds:double>"
RULES = ("rule_id string, device_type string, measurement string, condition string, threshold double, lo double, hi double, "
         f"severity string, durationSec double, {WINDOW}, params map<string,string>")


def rule_rows(spark, *rows):
    names = [f.split()[0] for f in RULES.replace(f", {WINDOW}", "").split(", ")]
    names.insert(9, "window")
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RULES)


SET = [
    dict(rule_id="up", measurement="gas_temperature", condition="rate_above", threshold=2.0),
    dict(rule_id="down", measurement="torque", condition="rate_below", threshold=-1.0, device_type="pump"),
    dict(rule_id="hot", measurement="gas_temperature", condition="greater_than", threshold=40.0, durationSec=6.0),
    dict(rule_id="band", measurement="torque", condition="between", lo=20.0, hi=90.0, durationSec=4.0, device_type="pump"),
    dict(rule_id="off", measurement="torque", condition="outside", lo=20.0, hi=40.0, durationSec=3.0),
    dict(rule_id="climb", measurement="torque", condition="rate_above", threshold=0.5, durationSec=2.0),
    dict(rule_id="text", condition="custom", params={"expr": "gas_temperature > 30 and torque < 80"}, durationSec=5.0),
    *[dict(rule_id=a, measurement="torque", condition="greater_than", threshold=x, window=w, params={"aggregate": a})
      for a, x, w in (("avg", 50.0, ("tumbling", 10.0, None)), ("max", 90.0, ("sliding", 12.0, 4.0)), ("count", 3.0, ("tumbling", 6.0, 0.0)),
                      ("stddev", 30.0, ("sliding", 20.0, 10.0)), ("sum", 150.0, ("sliding", 10.0, 4.0)))],
    dict(rule_id="low", measurement="gas_temperature", condition="less_than", threshold=20.0, window=("tumbling", 8.0, None), params={"aggregate": "min"}, device_type="pump"),
]


def readings(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        m = rnd.choice(["a", "a", "b", "c"])
        out.append({"machine_id": m, "machine_type": "pump" if m != "b" else "turbine", "timestamp": rnd.randrange(120) * 1000, "seq": i,
                    "gas_temperature": None if rnd.random() < 0.1 else rnd.choice([10.0, 35.0, 50.0, 60.0]),
                    "torque": None if rnd.random() < 0.1 else float(rnd.randrange(100))})
    return out


def wanted(spark, rows, table):
    t = spark.createDataFrame([tuple(r.get(f.split()[0]) for f in TEL.split(", ")) for r in rows], TEL)
    rate = rules.alerts(rules.evaluate(t, table.where(rules.is_rate() & rules.is_instant())))
    found = rate.select("device_id", "rule_id", "alert_time", "value")
    for other in (rules.sustained_rules(t, table), rules.windowed_rules(t, table)):
        found = found.unionByName(other.select(*found.columns))
    return listed(found)


def listed(df):
    return sorted((r["rule_id"], r["device_id"], r["alert_time"], None if r["value"] is None else round(r["value"], 6)) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_what_tables_give(spark, tmp_path, seed):
    rows, table = readings(240, seed), rule_rows(spark, *SET)
    parts = random.Random(seed)
    files = [[] for _ in range(4)]
    for r in rows:
        # mostly in order, some far behind the watermark
        files[min(3, r["timestamp"] // 30_000 + parts.choice([0, 0, 0, 1, 3]))].append(r)
    for i, f in enumerate(files):
        write_file(tmp_path / "t", f"{i}.json", f + [{"machine_id": "clock", "timestamp": 60_000 + 30_000 * (i + 1)}])
    write_file(tmp_path / "t", "9.json", [{"machine_id": "clock", "timestamp": LAST}])
    log = drain(spark, rule_state.rule_changes_stream(stream(spark, tmp_path / "t", TEL), table), tmp_path)
    assert log.where("change < 0").count() > 0  # something had to be corrected
    got = rule_state.alerts_of(rule_state.standing(log), table)
    want = wanted(spark, rows, table)
    assert listed(got) == want and {w[0] for w in want} == {r["rule_id"] for r in SET}
    assert rule_state.beyond(log).count() == 0


def test_alerts_come_at_once_and_are_corrected(spark, tmp_path):
    table = rule_rows(spark, dict(rule_id="hot", measurement="torque", condition="greater_than", threshold=5.0, durationSec=4.0))

    def run(name, *rows):
        write_file(tmp_path / "t", name, [{"machine_id": "a", "timestamp": t, "seq": 0, "torque": x} for t, x in rows])
        log = drain(spark, rule_state.rule_changes_stream(stream(spark, tmp_path / "t", TEL), table, lateness="1 second"), tmp_path)
        return sorted((r["timestamp"], r["change"]) for r in log.collect())

    assert run("0.json", (1000, 9.0), (5000, 9.0), (6000, 9.0)) == [(5000, 1), (6000, 1)]
    # a late quiet reading splits the stretch: nothing has lasted
    assert run("1.json", (3000, 1.0)) == [(5000, -1), (5000, 1), (6000, -1), (6000, 1)]
    assert run("2.json", (9000, 9.0)) == [(5000, -1), (5000, 1), (6000, -1), (6000, 1), (9000, 1)]


def test_what_is_older_than_the_state_is_not_lost(spark, tmp_path):
    table = rule_rows(spark, dict(rule_id="up", measurement="torque", condition="rate_above", threshold=0.5),
                      dict(rule_id="hot", measurement="torque", condition="greater_than", threshold=1.0, durationSec=20.0))

    def run(name, *rows):
        write_file(tmp_path / "t", name, [{"machine_id": m, "timestamp": t, "seq": 0, "torque": x} for m, t, x in rows])
        df = rule_state.rule_changes_stream(stream(spark, tmp_path / "t", TEL), table, lateness="1 second", keep_ms=5000)
        return drain(spark, df, tmp_path)

    run("0.json", ("a", 1000, 1.0), ("a", 10_000, 2.0))
    run("1.json", ("b", 30_000, 0.0))
    log = run("2.json", ("a", 5000, 50.0), ("a", 31_000, 30.0))
    assert [tuple(r) for r in rule_state.beyond(log).collect()] == [("a", 5000, 0)]
    # the last value, and since when it has lasted, outlive the readings
    assert sorted((r["rule_id"], r["timestamp"]) for r in rule_state.standing(log).collect()) == [("hot", 31_000), ("up", 31_000)]


def test_rules_that_streams_do_not_judge_are_named(spark):
    w = ("tumbling", 10.0, None)
    table = rule_rows(spark, *SET, dict(rule_id="lasting", measurement="torque", condition="greater_than", threshold=1.0, window=w, durationSec=5.0),
                      dict(rule_id="slope", measurement="torque", condition="rate_above", threshold=1.0, window=w),
                      dict(rule_id="now", measurement="torque", condition="greater_than", threshold=1.0),
                      dict(rule_id="wrong", measurement="nosuch", condition="rate_above", threshold=1.0))
    empty = spark.createDataFrame([], TEL)
    listed_rules, texts, refused = rule_state.several(table, empty)
    assert {r.rule_id for r in listed_rules} == {r["rule_id"] for r in SET} and texts == ["gas_temperature > 30 and torque < 80"]
    assert {r["rule_id"] for r in refused.collect()} == {"lasting", "slope"}


def test_moments_fold():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 2))
    x[rng.random((50, 2)) < 0.2] = np.nan
    folded = rule_state.folded([rule_state.moments(x[a:b]) for a, b in ((0, 7), (7, 8), (8, 50))])
    for m in range(2):
        v = x[~np.isnan(x[:, m]), m]
        for name, want in (("count", len(v)), ("avg", v.mean()), ("sum", v.sum()), ("min", v.min()), ("max", v.max()), ("stddev", v.std(ddof=1))):
            assert abs(rule_state.aggregate(folded, m, name) - want) < 1e-12


class Kept:
    """State and timers of one bucket, in memory, that count their calls."""

    def __init__(self):
        self.calls, self.held, self.timers, self.mark = 0, {}, set(), -1

    def _state(self, name, *_):
        return Slot(self, name)

    getListState = getValueState = _state

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def getCurrentWatermarkInMs(self):
        return self.mark


class Slot:
    def __init__(self, kept, name):
        self.kept, self.name = kept, name

    def exists(self):
        return self.name in self.kept.held

    def get(self):
        self.kept.calls += 1
        return self.kept.held.get(self.name, [])

    def put(self, rows):
        self.kept.calls += 1
        self.kept.held[self.name] = rows

    update = put

    def appendList(self, rows):
        self.put([*self.kept.held.get(self.name, []), *rows])

    def clear(self):
        self.kept.held.pop(self.name, None)


def test_a_bucket_of_machines_is_judged_in_one_call():
    import pandas as pd

    w = dict(device_type=None, condition="greater_than", measurement=0, threshold=5.0, lo=None, hi=None, text=None)
    set_ = [rule_state.Rule("hot", duration_ms=2000, size_ms=None, slide_ms=None, aggregate="avg", **w),
            rule_state.Rule("avg", duration_ms=0, size_ms=4000, slide_ms=2000, aggregate="avg", **w)]
    machines = [f"m{i}" for i in range(400)] + [None]

    def frame(times, x):
        rows = [(m, "pump", t, 0, x, False) for t in times for m in machines]
        return pd.DataFrame(rows, columns=["machine_id", "machine_type", "timestamp", "seq", "x0", "tick"])

    def run(kept, own, *, mark, times, x):
        kept.calls, kept.mark = 0, mark
        out = list(own.handleInputRows((0,), iter([frame(times, x)]), kept))
        assert kept.calls < 20  # however many machines
        return pd.concat(out) if out else frame([], x).assign(rule_id=None, change=0)

    kept, own = Kept(), rule_state.RuleState(set_, 1, 0, 60_000)
    own.init(kept)
    first = run(kept, own, mark=0, times=[1000, 3000, 5000], x=9.0)
    assert first.groupby(["rule_id", "timestamp"])["change"].sum().to_dict() == {("hot", 3000): 401, ("hot", 5000): 401}
    late = run(kept, own, mark=20_000, times=[2000], x=-99.0)  # windows are over by now; a stretch is split
    log = pd.concat([first, late]).groupby(["rule_id", "timestamp"])["change"].sum()
    assert log[log != 0].to_dict() == {("hot", 5000): 401, ("avg", 2000): 401, ("avg", 8000): 401}
    assert late["machine_id"].isna().sum() == len(late) // 401
