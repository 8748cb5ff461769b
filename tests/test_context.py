from millwatch.operators import context, trimming
from tests import data

IN, OUT = "trackin", "trackout"


def runs_of(rows):
    return [(r["timestamp"], r["run_id"]) for r in rows.orderBy("machine_id", "timestamp").collect()]


def test_asof(spark):
    t = data.readings(spark, [("a", 2), ("a", 4), ("b", 3)])
    c = data.context(spark, [("a", "r1", IN, 1), ("a", "r2", IN, 3)])
    assert runs_of(context.attach_context(t, c)) == [(2, "r1"), (4, "r2"), (3, None)]


def test_asof_tie_takes_the_context(spark):
    t, c = data.readings(spark, [("a", 5)]), data.context(spark, [("a", "r1", IN, 5)])
    assert runs_of(context.attach_context(t, c)) == [(5, "r1")]


def test_trackout_replaces_trackin(spark):
    t = data.readings(spark, [("a", 9)])
    c = data.context(spark, [("a", "r1", IN, 1), ("a", "r1", OUT, 5)])
    row = context.attach_context(t, c).first()
    assert (row["event_type"], row["end_ts"]) == (OUT, 5)
    assert context.attach_context(t, c, active_only=True).first()["run_id"] is None


def closed(spark, rows):
    c = data.context(spark, rows)
    return c, context.dlq_records(context.implicit_closes(c), 0)


def test_implicit_close_does_not_block(spark):
    c, records = closed(spark, [("a", "r1", IN, 1), ("a", "r2", IN, 3), ("a", "r2", OUT, 5)])
    got = records.collect()
    assert len(got) == 1
    a = got[0]["context_anomaly"]
    assert (a["previous_run_id"], a["current_run_id"], a["implicit_transition_ts"]) == ("r1", "r2", 3)
    assert (got[0]["anomaly_type"], got[0]["status"]) == ("SEQUENCE_ANOMALY", "UNRESOLVED")
    t = data.readings(spark, [("a", 2), ("a", 4), ("a", 4), ("a", 6)])
    rows = context.attach_context(t, c, anomalies=True).orderBy("seq").collect()
    assert [r["context_anomaly"] is not None for r in rows] == [False, True, False, False]
    assert context.reconcile(records, c).first()["status"] == "UNRESOLVED"


def test_delayed_trackout_resolves(spark):
    c, records = closed(spark, [("a", "r1", IN, 1), ("a", "r2", IN, 3), ("a", "r2", OUT, 5), ("a", "r1", OUT, 7),
                                ("a", "r1", OUT, 9)])
    row = context.reconcile(records, c).first()
    assert (row["status"], row["resolved_ts"]) == ("RESOLVED", 7)


def test_record_ids_are_stable(spark):
    rows = [("a", "r1", IN, 1), ("a", "r2", IN, 3)]
    assert closed(spark, rows)[1].first()["anomaly_id"] == closed(spark, rows)[1].first()["anomaly_id"]


def test_runs(spark):
    c = data.context(spark, [("a", "r1", IN, 1), ("a", "r2", IN, 3), ("a", "r2", OUT, 5), ("a", "r3", IN, 8)])
    got = {r["run_id"]: (r["start_ts"], r["end_ts"], r["closed_by"]) for r in context.runs(c).collect()}
    assert got == {"r1": (1, 3, "implicit"), "r2": (3, 5, "trackout"), "r3": (8, None, "open")}


def trimmed(spark, times, events, action="drop"):
    t, c = data.readings(spark, [("a", x) for x in times]), data.context(spark, events)
    rows = trimming.edge_trim(t, context.runs(c), 5000, 5000, action)
    return {r["timestamp"]: r["disposition"] for r in rows.collect()}


def test_trim_normal(spark):
    assert trimmed(spark, [1005, 6000, 6005], [("a", "r", IN, 1000)]) == {6000: "KEEP", 6005: "KEEP"}


def test_trim_tag(spark):
    assert trimmed(spark, [1005, 6000], [("a", "r", IN, 1000)], "tag") == {1005: "TRIMMED_LEAD", 6000: "KEEP"}


def test_trim_empty_window(spark):
    assert trimmed(spark, [1005], [("a", "r", IN, 1000), ("a", "r", OUT, 7000)]) == {}


def test_trim_trail_and_outside(spark):
    events = [("a", "r", IN, 1000), ("a", "r", OUT, 20000)]
    got = trimmed(spark, [500, 15000, 15001, 20000, 20001], events, "tag")
    assert got == {500: "PENDING", 15000: "KEEP", 15001: "TRIMMED_TRAIL", 20000: "TRIMMED_TRAIL", 20001: "PENDING"}
