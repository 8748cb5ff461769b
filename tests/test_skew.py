"""Cut timelines give row for row what uncut ones and a plain Python loop give."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from millwatch.operators import context, detectors, kpi, rules, trimming, windows
from millwatch.operators.ordered import Timeline, asof, measure, running_count, running_max, running_sum, scan
from tests import data


@pytest.fixture(scope="module")
def tables(spark):
    tel, ctx = data.lopsided(spark)
    t, c = data.readings(spark, tel).cache(), data.context(spark, ctx).cache()
    cuts = measure((t, ["machine_id"], "timestamp"), (c, ["device_id"], "timestamp"), max_rows=15)
    return t, c, cuts, tel, ctx


def same(a, b):
    assert a.columns == b.columns
    left, right = sorted(map(repr, a.collect())), sorted(map(repr, b.collect()))
    assert len(left) == len(right)
    assert left == right


def near(a, b, column):
    left = {r["seq"]: r[column] for r in a.collect()}
    right = b if isinstance(b, dict) else {r["seq"]: r[column] for r in b.collect()}
    assert left.keys() == right.keys()
    for k, v in left.items():
        assert (v is None) == (right[k] is None) and (v is None or math.isclose(v, right[k], abs_tol=1e-8)), k


def by_machine(tel):
    out = {}
    for i, r in sorted(enumerate(tel), key=lambda p: (p[1][1], p[0])):
        out.setdefault(r[0], []).append((i, r))
    return out


def test_slices_are_bounded(tables):
    t, _, _, _, _ = tables
    cuts = measure((t, ["machine_id"], "timestamp"), max_rows=15)
    assert cuts.slices > 10
    line = Timeline.of(t, ["machine_id"], ["timestamp", "seq"], cuts)
    sizes = line.cut(t).groupBy("machine_id", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 15


def test_nothing_is_cut_below_the_limit(tables):
    t, _, _, _, _ = tables
    assert measure((t, ["machine_id"], "timestamp")).hot is None


def test_hot_null_key_is_cut(spark):
    rows = data.readings(spark, [(None, i) for i in range(50)])
    cuts = measure((rows, ["machine_id"], "timestamp"), max_rows=10)
    line = Timeline.of(rows, ["machine_id"], ["timestamp"], cuts)
    got = {r["timestamp"]: r["n"] for r in scan(rows, line, {"n": running_count(F.lit(1))}).collect()}
    assert got == {i: i + 1 for i in range(50)}


def test_burst_inside_a_long_time(spark):
    rows = data.readings(spark, [("m", i) for i in range(200)] + [("m", 10_000_000)])
    cuts = measure((rows, ["machine_id"], "timestamp"), max_rows=20)
    line = Timeline.of(rows, ["machine_id"], ["timestamp", "seq"], cuts)
    got = {r["seq"]: r["n"] for r in scan(rows, line, {"n": running_count(F.lit(1))}).collect()}
    assert got == {i: i + 1 for i in range(201)}


def test_running_scans(tables):
    t, _, cuts, tel, _ = tables
    line = Timeline.of(t, ["machine_id"], ["timestamp", "seq"], cuts)
    x = F.col("gas_temperature")
    got = scan(t, line, {"s": running_sum(x), "m": running_max(x, inclusive=False)}).collect()
    want = {}
    for rows in by_machine(tel).values():
        total, top = 0.0, None
        for i, r in rows:
            total += r[2]
            want[i] = (total, top)
            top = r[2] if top is None else max(top, r[2])
    for r in got:
        s, m = want[r["seq"]]
        assert math.isclose(r["s"], s) and r["m"] == m


@pytest.mark.parametrize("forward", [False, True])
def test_asof_against_brute_force(tables, forward):
    t, c, cuts, tel, ctx = tables
    right = c.withColumnRenamed("device_id", "machine_id")
    args = dict(left_time="timestamp", right_time="timestamp", left_tie="seq", right_tie="seq", carry=["run_id"],
                forward=forward)
    cut = asof(t, right, ["machine_id"], cuts=cuts, **args)
    same(cut, asof(t, right, ["machine_id"], **args))
    for r in cut.collect():
        m, ts = r["machine_id"], r["timestamp"]
        if forward:
            found = min(((e[3], i) for i, e in enumerate(ctx) if e[0] == m and e[3] >= ts), default=None)
        else:
            found = max(((e[3], i) for i, e in enumerate(ctx) if e[0] == m and e[3] <= ts), default=None)
        assert (r["_match"] and r["_match"]["run_id"]) == (found and ctx[found[1]][1])


def test_context_operators(tables):
    t, c, cuts, _, _ = tables
    same(context.attach_context(t, c, anomalies=True, cuts=cuts), context.attach_context(t, c, anomalies=True))
    same(context.implicit_closes(c, cuts=cuts), context.implicit_closes(c))
    runs = context.runs(c)
    same(context.runs(c, cuts=cuts), runs)
    same(context.in_run(t, runs, cuts=cuts), context.in_run(t, runs))
    same(trimming.edge_trim(t, runs, 500, 500, cuts=cuts), trimming.edge_trim(t, runs, 500, 500))
    records = context.dlq_records(context.implicit_closes(c), 0)
    same(context.reconcile(records, c, cuts=cuts), context.reconcile(records, c))


def test_rules_and_windows(tables):
    t, _, cuts, _, _ = tables
    near(rules.rate_of_change(t, "gas_temperature", cuts=cuts), rules.rate_of_change(t, "gas_temperature"),
         "gas_temperature_rate")
    b = t.select("machine_id", F.lit("r").alias("rule_id"), "timestamp", "seq",
                 (F.col("gas_temperature") > 20).alias("breached"))
    same(rules.sustained(b, 300, cuts=cuts), rules.sustained(b, 300))
    same(windows.sessions(t, 200, cuts=cuts), windows.sessions(t, 200))
    same(kpi.utilization(t, cuts=cuts), kpi.utilization(t))


@pytest.mark.parametrize("alpha", [0.001, 0.3, 0.9, 1.0])
def test_ewma_against_the_loop(tables, alpha):
    t, _, cuts, tel, _ = tables
    want = {}
    for rows in by_machine(tel).values():
        s = None
        for i, r in rows:
            s = r[2] if s is None else alpha * r[2] + (1 - alpha) * s
            want[i] = s
    near(detectors.ewma(t, "gas_temperature", alpha), want, "gas_temperature_ewma")
    near(detectors.ewma(t, "gas_temperature", alpha, cuts=cuts), want, "gas_temperature_ewma")


def test_ewma_over_many_blocks(spark, monkeypatch):
    xs = [math.sin(i) * 10 + 20 for i in range(4000)]
    t = data.readings(spark, [("m", i, x) for i, x in enumerate(xs)])
    want, s = {}, None
    for i, x in enumerate(xs):
        s = x if s is None else 0.3 * x + 0.7 * s
        want[i] = s
    near(detectors.ewma(t, "gas_temperature", 0.3), want, "gas_temperature_ewma")


def test_cusum_against_the_loop(tables):
    t, _, cuts, tel, _ = tables
    want = {}
    for rows in by_machine(tel).values():
        s = 0.0
        for i, r in rows:
            s = max(0.0, s + r[2] - 50 - 2)
            want[i] = s
    near(detectors.cusum(t, "gas_temperature", 50, 2, 90), want, "gas_temperature_cusum")
    near(detectors.cusum(t, "gas_temperature", 50, 2, 90, cuts=cuts), want, "gas_temperature_cusum")


@pytest.mark.parametrize("n", [5, 40])
def test_zscore_against_the_loop(tables, n):
    t, _, cuts, tel, _ = tables
    want = {}
    for rows in by_machine(tel).values():
        for j, (i, r) in enumerate(rows):
            before = [p[1][2] for p in rows[max(0, j - n):j]]
            sd = statistics.stdev(before) if len(before) > 1 else 0
            want[i] = (r[2] - statistics.fmean(before)) / sd if sd else None
    near(detectors.zscore(t, "gas_temperature", n), want, "gas_temperature_z")
    near(detectors.zscore(t, "gas_temperature", n, cuts=cuts), want, "gas_temperature_z")
