"""Streams give what the table operators give, in any arrival order, and survive restarts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.operators import context, detectors, parse, rules, trimming
from millwatch.operators.quality import lag, observed
from millwatch.plans.guard import start_guard
from millwatch.streaming import monitor, sinks, stateful
from tests import data

MINUTE = 60_000
LAST = 10_000_000  # a late reading of another machine that moves the watermark past everything


def write_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    at = 1_700_000_000 + int(name.split(".")[0])  # files arrive in the order of their names
    os.utime(folder / name, (at, at))


def tel(machine, ts, x=1.0, seq=0):
    return {"machine_id": machine, "timestamp": ts, "seq": seq, "gas_temperature": x}


def ctx(machine, run, kind, ts):
    return {"device_id": machine, "run_id": run, "event_type": kind, "timestamp": ts, "seq": 0}


TEL = "machine_id string, timestamp bigint, seq bigint, gas_temperature double"
CTX = "device_id string, run_id string, event_type string, timestamp bigint, start_ts bigint, end_ts bigint, seq bigint"


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").json(str(folder))


def drain(spark, df, base):
    sinks.start_files(df, f"{base}/out", f"{base}/check", once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out").where(F.col(df.columns[0]) != "clock")


READINGS = [tel("a", t * 1000, float(t), t) for t in range(1, 40)]
EVENTS = [ctx("a", "r1", "trackin", 5000), ctx("a", "r1", "trackout", 12000), ctx("a", "r2", "trackin", 20000),
          ctx("a", "r3", "trackin", 31000)]
CLOCK = tel("clock", LAST)


@pytest.fixture(params=["one file", "out of order"])
def folders(request, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    if request.param == "one file":
        write_file(t, "0.json", READINGS)
        write_file(c, "0.json", EVENTS)
    else:  # all within the allowed minute
        write_file(t, "0.json", READINGS[20:])
        write_file(t, "1.json", READINGS[:10])
        write_file(t, "2.json", READINGS[10:20])
        write_file(c, "0.json", EVENTS[2:])
        write_file(c, "1.json", EVENTS[:2])
    write_file(t, "9.json", [CLOCK])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    return t, c


def tables(spark):
    t = spark.createDataFrame([(r["machine_id"], r["timestamp"], r["seq"], r["gas_temperature"]) for r in READINGS], TEL)
    c = spark.createDataFrame([(e["device_id"], e["run_id"], e["event_type"], e["timestamp"], None, None, 0) for e in EVENTS], CTX)
    return t, c


def rows(df, *names):
    return sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))


@pytest.mark.parametrize("salts", [1, 3])
def test_context(spark, folders, tmp_path, salts):
    t, c = folders
    got = drain(spark, stateful.attach_context_stream(stream(spark, t, TEL), stream(spark, c, CTX), salts=salts), tmp_path)
    names = ["machine_id", "timestamp", "gas_temperature", "run_id", "event_type", "context_ts"]
    assert rows(got, *names) == rows(context.attach_context(*tables(spark)), *names)


def test_trim(spark, folders, tmp_path):
    t, c = folders
    got = drain(spark, stateful.edge_trim_stream(stream(spark, t, TEL), stream(spark, c, CTX), 2000, 2000, "tag", salts=2), tmp_path)
    bt, bc = tables(spark)
    want = trimming.edge_trim(bt, context.runs(bc), 2000, 2000, "tag")
    names = ["timestamp", "run_id", "start_ts", "disposition"]
    assert rows(got, *names) == rows(want, *names)
    assert {r["disposition"] for r in got.collect()} == {"KEEP", "TRIMMED_LEAD", "TRIMMED_TRAIL", "PENDING"}


def test_guard(spark, folders, tmp_path):
    got = drain(spark, stateful.implicit_closes_stream(stream(spark, folders[1], CTX)), tmp_path)
    assert rows(got, "device_id", "context_anomaly") == rows(context.implicit_closes(tables(spark)[1]), "device_id", "context_anomaly")


def test_ewma(spark, folders, tmp_path):
    got = drain(spark, stateful.ewma_stream(stream(spark, folders[0], TEL), "gas_temperature", 0.3), tmp_path)
    want = {r["timestamp"]: r["gas_temperature_ewma"] for r in detectors.ewma(tables(spark)[0], "gas_temperature", 0.3).collect()}
    assert {r["timestamp"]: round(r["gas_temperature_ewma"], 9) for r in got.collect()} == {k: round(v, 9) for k, v in want.items()}


def test_late_trackin_within_the_grace(spark, tmp_path):
    """A reading waits for its trackin; one that never gets one is PENDING."""
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", [tel("a", 30_000), tel("b", 30_000)])
    write_file(c, "0.json", [ctx("x", "r", "trackin", 30_000)])
    write_file(c, "1.json", [ctx("a", "late", "trackin", 10_000)])
    write_file(t, "1.json", [tel("x", 40_000)])
    write_file(t, "9.json", [CLOCK])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    got = drain(spark, stateful.edge_trim_stream(stream(spark, t, TEL), stream(spark, c, CTX), 5000, 5000), tmp_path)
    assert {r["machine_id"]: (r["run_id"], r["disposition"]) for r in got.collect() if r["machine_id"] != "x"} == {
        "a": ("late", "KEEP"), "b": (None, "PENDING")}


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", READINGS[:20])
    write_file(c, "0.json", EVENTS[:2])

    def run():
        return drain(spark, stateful.attach_context_stream(stream(spark, t, TEL), stream(spark, c, CTX)), tmp_path)

    run()
    write_file(t, "1.json", READINGS[20:])
    write_file(c, "1.json", EVENTS[2:])
    run()
    write_file(t, "9.json", [CLOCK])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    got = run()
    names = ["timestamp", "run_id", "event_type"]
    assert rows(got, *names) == rows(context.attach_context(*tables(spark)), *names)


def test_dedupe_keeps_the_first(spark, tmp_path):
    t = tmp_path / "t"
    write_file(t, "0.json", [tel("a", 1000, 1.0)])
    write_file(t, "1.json", [tel("a", 1000, 2.0), tel("a", 2000, 3.0)])
    got = drain(spark, stateful.dedupe_stream(stream(spark, t, TEL)), tmp_path)
    assert sorted(r["gas_temperature"] for r in got.collect()) == [1.0, 3.0]


def test_new_series_once(spark, tmp_path):
    t = tmp_path / "t"
    write_file(t, "0.json", [tel("a", 1000)])
    write_file(t, "1.json", [tel("a", 2000), tel("b", 2000)])
    seen = stream(spark, t, TEL).select(F.col("machine_id").alias("device_id"), F.lit("m").alias("measurement"))
    assert drain(spark, stateful.new_series_stream(seen), tmp_path).count() == 2


def full(t, x):
    return {"machine_id": "a", "timestamp": t, "gas_temperature": x, "machine_type": "pump", "status": "running"}


def test_fan_out_and_replay(spark, tmp_path):
    folder = tmp_path / "raw"
    write_file(folder, "0.json", [full(1000, 5.0), full(2000, 50.0), {"timestamp": 3}])
    raw = spark.readStream.text(str(folder))
    parsed = parse.parse_telemetry(raw)
    table = data.rule_table(spark, dict(threshold=10.0))
    targets = sinks.Targets(**{n: f"{tmp_path}/{n}" for n in ("bronze", "evaluation", "dlq", "errors", "alerts")})

    def write(batch, batch_id):
        sinks.write_errors(batch, batch_id, targets)
        evaluated = rules.evaluate(parse.good(batch), table).withColumn(
            "context_anomaly", F.when(F.col("timestamp") == 1000, context.anomaly(F.lit("r1"), F.lit("r2"), F.lit(1000))))
        sinks.write_batch(evaluated, batch_id, targets)
        sinks.write_batch(evaluated, batch_id, targets)  # a replay of the same batch changes nothing

    sinks.start(parsed, write, f"{tmp_path}/check", once=True).awaitTermination()
    assert sinks.read_bronze(spark, targets).count() == 2
    assert sinks.read_bronze(spark, targets).select("device_path").first()[0] == "root.factory1.a"
    messages = [json.loads(r["value"]) for r in sinks.read_batches(spark, targets.evaluation).collect()]
    assert sorted(m["passed"] for m in messages) == [False, True]
    assert all("fault_code" in m and m["fault_code"] is None for m in messages)
    alert = sinks.read_batches(spark, targets.alerts).collect()
    assert len(alert) == 1 and alert[0]["key"] == "a" and json.loads(alert[0]["value"])["value"] == 50.0
    dlq = [json.loads(r["value"]) for r in sinks.read_batches(spark, targets.dlq).collect()]
    assert [d["context_anomaly"]["current_run_id"] for d in dlq] == ["r2"]
    assert sinks.read_batches(spark, targets.errors).count() == 1


def test_the_whole_job(spark, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", [full(6000, 50.0), full(1000, 5.0), {"machine_id": "a"}])
    write_file(c, "0.json", [ctx("a", "r1", "trackin", 500), ctx("a", "r2", "trackin", 5000)])
    write_file(t, "9.json", [full(LAST, 0.0)])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    targets = sinks.Targets(**{n: f"{tmp_path}/{n}" for n in ("bronze", "evaluation", "dlq", "errors", "alerts")})
    table = data.rule_table(spark, dict(threshold=10.0))

    def text(folder):
        return spark.readStream.option("maxFilesPerTrigger", "1").text(str(folder))

    for q in start_guard(text(t), text(c), lambda: table, targets, f"{tmp_path}/check", once=True):
        q.awaitTermination()
    got = {m["timestamp"]: (m["run_id"], m["passed"])
           for m in (json.loads(r["value"]) for r in sinks.read_batches(spark, targets.evaluation).collect())}
    assert got == {1000: ("r1", True), 6000: ("r2", False)}
    assert sinks.read_bronze(spark, targets).count() == 2
    assert sinks.read_batches(spark, targets.alerts).count() == 1
    assert sinks.read_batches(spark, targets.errors).count() == 1
    dlq = [json.loads(r["value"]) for r in sinks.read_batches(spark, targets.dlq).collect()]
    assert [d["context_anomaly"]["previous_run_id"] for d in dlq] == ["r1"]


def test_late_rows_are_kept_and_marked(spark, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", [tel("a", 1_000_000), tel("a", 900_000)])
    write_file(c, "0.json", [ctx("a", "r1", "trackin", 500_000), ctx("a", "r2", "trackin", 800_000)])

    def run():
        return drain(spark, stateful.attach_context_stream(stream(spark, t, TEL), stream(spark, c, CTX), salts=2), tmp_path)

    run()
    write_file(t, "1.json", [tel("a", 600_000, 2.0)])
    write_file(t, "9.json", [CLOCK])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    got = {r["timestamp"]: (r["run_id"], r["late"]) for r in run().collect()}
    assert got == {1_000_000: ("r2", False), 900_000: ("r2", False), 600_000: ("r1", True)}


def test_a_wrong_clock_is_a_dead_letter(spark, tmp_path):
    """A time in the far future stops nobody else, a rate rule does not stop the job, bad context is reported too."""
    t, c = tmp_path / "t", tmp_path / "c"
    future = 4_102_444_800_000
    write_file(t, "0.json", [full(1000, 50.0), full(future, 5.0)])
    write_file(t, "1.json", [full(2000, 5.0)])
    write_file(t, "9.json", [full(LAST, 0.0)])
    write_file(c, "0.json", [ctx("a", "r1", "trackin", 500), {"device_id": "a"}])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    targets = sinks.Targets(**{n: f"{tmp_path}/{n}" for n in ("bronze", "evaluation", "dlq", "errors", "alerts")})
    table = data.rule_table(spark, dict(threshold=10.0), dict(rule_id="rate", condition="rate_above", threshold=1.0))

    def text(folder):
        return spark.readStream.option("maxFilesPerTrigger", "1").text(str(folder))

    for q in start_guard(text(t), text(c), lambda: table, targets, f"{tmp_path}/check", once=True):
        q.awaitTermination()
    kept = [json.loads(r["value"])["timestamp"] for r in sinks.read_batches(spark, targets.evaluation).collect()]
    assert sorted(kept) == [1000, 2000]  # LAST still waits for the watermark
    assert sinks.read_bronze(spark, targets).count() == 2
    letters = sorted((m["source"], m["error_type"]) for m in (
        json.loads(r["value"]) for r in sinks.read_batches(spark, targets.errors).collect()))
    assert letters == [("context-parser", "SCHEMA_VALIDATION_ERROR"), ("telemetry-parser", "CLOCK_ERROR")]
    assert sinks.read_batches(spark, targets.alerts).count() == 1


def _run_job(spark, tmp_path, table, *, keep_ms=stateful.KEEP_MS):
    targets = sinks.Targets(**{n: f"{tmp_path}/out-{n}" for n in ("bronze", "evaluation", "dlq", "errors", "alerts", "context")})

    def text(folder):
        return spark.readStream.option("maxFilesPerTrigger", "1").text(str(folder))

    for q in start_guard(text(tmp_path / "t"), text(tmp_path / "c"), lambda: table, targets, f"{tmp_path}/check", once=True, keep_ms=keep_ms):
        q.awaitTermination()

    def messages(target):
        return [json.loads(r["value"]) for r in sinks.read_batches(spark, target).collect()]

    return targets, messages


def test_all_kinds_of_rules_in_the_job(spark, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", [full(1000, 50.0), full(3000, 60.0), full(9000, 70.0)])
    write_file(t, "9.json", [full(LAST, 0.0)])
    write_file(c, "0.json", [ctx("a", "r1", "trackin", 500), ctx("a", "r2", "trackin", 2000)])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    window = "window struct<type:string,sizeSeconds:double,slideSeconds:double>"
    table = data.rule_table(
        spark, dict(rule_id="hot", threshold=65.0), dict(rule_id="climb", condition="rate_above", threshold=4.0),
        dict(rule_id="long", threshold=40.0, durationSec=5.0), dict(rule_id="mean", threshold=55.0),
        dict(rule_id="wrong", condition="custom", params={"expr": "reflect('java.lang.System', 'nanoTime') is not null"}),
        dict(rule_id="hard", condition="rate_above", threshold=1.0))
    wide = F.when(F.col("rule_id").isin("mean", "hard"), F.from_json(F.lit('{"type":"tumbling","sizeSeconds":10.0}'), window.split(" ", 1)[1]))
    targets, messages = _run_job(spark, tmp_path, table.withColumn("window", wide))
    alerts = sorted((m["rule_id"], m["alert_time"], m.get("change")) for m in messages(targets.alerts))
    assert alerts == [("climb", 3000, 1), ("hot", 9000, None), ("long", 9000, 1), ("mean", 10_000, 1)]
    assert {(m["rule_id"], m["error_message"].split(",")[0]) for m in messages(targets.errors)} == {
        ("wrong", "unusable expression"), ("hard", "a window that must last")}
    closes = {m["timestamp"]: m["context_anomaly"] and m["context_anomaly"]["previous_run_id"] for m in messages(targets.evaluation)}
    assert closes == {1000: None, 3000: "r1", 9000: None}


def test_late_readings_and_late_context_in_the_job(spark, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", [full(1_000_000, 50.0), full(2_000_000, 50.0)])
    write_file(c, "0.json", [ctx("a", "r1", "trackin", 500_000), ctx("a", "r2", "trackin", 1_500_000)])
    write_file(t, "1.json", [full(6_000_000, 50.0)])
    write_file(c, "1.json", [ctx("b", "r9", "trackin", 6_000_000)])
    table = data.rule_table(spark, dict(rule_id="hot", threshold=10.0))
    _run_job(spark, tmp_path, table, keep_ms=1000)
    # its context is long gone from state; and a run that nobody knew of begins before a reading that was given out
    write_file(t, "2.json", [full(1_200_000, 50.0)])
    write_file(c, "2.json", [ctx("a", "r3", "trackin", 1_900_000)])
    _run_job(spark, tmp_path, table, keep_ms=1000)
    write_file(t, "9.json", [full(LAST, 0.0)])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    targets, messages = _run_job(spark, tmp_path, table, keep_ms=1000)
    rows = sinks.read_batches(spark, targets.evaluation)
    runs = {(m["timestamp"], m["run_id"]) for m in messages(targets.evaluation)}
    assert {(1_000_000, "r1"), (1_200_000, "r1"), (2_000_000, "r2"), (2_000_000, "r3")} <= runs and rows.count() == 5


def test_microseconds_survive_the_state(spark, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", [tel("a", 1000)])
    write_file(t, "9.json", [CLOCK])
    write_file(c, "0.json", [ctx("clock", "r", "trackin", LAST)])
    exact = stream(spark, t, TEL).withColumn("at", F.timestamp_micros(F.lit(1_700_000_000_123_456)))
    got = drain(spark, stateful.attach_context_stream(exact, stream(spark, c, CTX)), tmp_path)
    assert {r["us"] for r in got.select(F.unix_micros("at").alias("us")).collect()} == {1_700_000_000_123_456}


def test_rules_change_between_batches(spark, tmp_path):
    """Rules are read again for every micro-batch; earlier rows keep their verdict."""
    folder, out = tmp_path / "raw", tmp_path / "out"
    write_file(folder, "0.json", [full(1000, 50.0)])
    limits = {"now": 10.0}

    def write(batch, batch_id):
        table = data.rule_table(spark, dict(threshold=limits["now"]))
        rules.evaluate(parse.good(batch), table).select("timestamp", "passed").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    def run():
        parsed = parse.parse_telemetry(spark.readStream.text(str(folder)))
        sinks.start(parsed, write, f"{tmp_path}/check", once=True).awaitTermination()

    run()
    limits["now"] = 100.0
    write_file(folder, "1.json", [full(2000, 50.0)])
    run()
    got = {r["timestamp"]: r["passed"] for r in sinks.read_batches(spark, str(out)).collect()}
    assert got == {1000: False, 2000: True}


def test_rules_join_a_plain_stream(spark, tmp_path):
    folder = tmp_path / "raw"
    write_file(folder, "0.json", [full(1000, 50.0), full(2000, 5.0)])
    parsed = parse.good(parse.parse_telemetry(spark.readStream.text(str(folder))))
    e = rules.evaluation(rules.evaluate(parsed, data.rule_table(spark, dict(threshold=10.0))))
    got = drain(spark, e.select("device_id", "timestamp", "passed"), tmp_path)
    assert {r["timestamp"]: r["passed"] for r in got.collect()} == {1000: False, 2000: True}


def test_progress_is_a_table(spark, tmp_path):
    log = monitor.ProgressLog()
    spark.streams.addListener(log)
    try:
        write_file(tmp_path / "t", "0.json", [tel("a", 1)])
        drain(spark, observed(stream(spark, tmp_path / "t", TEL), "seen", early="timestamp < 5"), tmp_path)
        for _ in range(50):
            if log.reports:
                break
            spark.sparkContext._jvm.java.lang.Thread.sleep(100)
        assert log.table(spark).agg(F.sum("input_rows")).first()[0] == 1
        counts = {r["counter"]: r["n"] for r in log.counter_table(spark).groupBy("counter").agg(F.sum("value").alias("n")).collect()}
        assert counts == {"total": 1, "early": 1}
    finally:
        spark.streams.removeListener(log)
    log.offsets["t", 0] = (9, 4)
    assert lag(log.offset_table(spark)).first()["lag"] == 5


def test_kafka_is_only_an_option(spark):
    from millwatch.sources.topics import read_topic
    with pytest.raises(Exception, match="kafka"):
        read_topic(spark, schemas.TELEMETRY_TOPIC, streaming=True, options={"kafka.bootstrap.servers": "x:1"})


def test_trimming_with_outputs_and_pending_settled_later(spark, tmp_path):
    t, c = tmp_path / "t", tmp_path / "c"
    write_file(t, "0.json", READINGS)
    write_file(t, "9.json", [CLOCK])
    write_file(c, "9.json", [ctx("clock", "r", "trackin", LAST)])
    write_file(c, "0.json", EVENTS[2:])  # the first run is not known yet
    rows_ = stateful.edge_trim_stream(stream(spark, t, TEL), stream(spark, c, CTX), 2000, 2000, "tag", salts=2)
    sinks.start(rows_, lambda b, i: sinks.write_trimmed(b, i, f"{tmp_path}/out"), f"{tmp_path}/check", once=True).awaitTermination()
    out = sinks.read_batches(spark, f"{tmp_path}/out").where("machine_id = 'a'")
    counts = {r["output"]: r["n"] for r in out.groupBy("output").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"pending": 19, "trimmed": 5, "kept": 15} and sum(counts.values()) == len(READINGS)
    bt, bc = tables(spark)
    again = trimming.settle_pending(out.where("output = 'pending'"), context.runs(bc), 2000, 2000)
    want = trimming.edge_trim(bt.where("timestamp < 20000"), context.runs(bc), 2000, 2000, "tag")
    names = ["timestamp", "run_id", "start_ts", "disposition"]
    assert rows(again, *names) == rows(want, *names)


def test_a_bucket_is_settled_in_pieces(monkeypatch):
    import pandas as pd

    from tests.test_rule_state import Kept

    machines = [f"m{i % 50}" for i in range(1000)]
    frame = pd.DataFrame({
        "machine_id": machines, "is_context": [i % 3 == 0 for i in range(1000)], "timestamp": [i * 37 % 1000 for i in range(1000)], "seq": range(1000),
        "body": "{}", "run_id": [f"r{i}" for i in range(1000)], "event_type": ["trackin", "trackout"] * 500, "start_ts": None, "end_ts": None, "tick": False})

    def run(piece):
        monkeypatch.setattr(stateful, "PIECE", piece)
        kept, own, out, sizes = Kept(), stateful.RunContext(5, 100), [], []
        own.init(kept)
        settle = own.settle
        monkeypatch.setattr(own, "settle", lambda held, *rest: (sizes.append(len(held)), settle(held, *rest))[1])
        for mark, rows in ((-1, frame[:600]), (500, frame[600:]), (800, frame[:0]), (5000, frame[:0])):
            kept.mark = mark
            list(own.handleInputRows((0,), iter([rows[:300], rows[300:]]), kept))
            out += list(own.handleExpiredTimer((0,), kept, None))
        keys = ["machine_id", "run_id", "context_ts", "run_name", "late", "closes", "closed_run", "unplaced"]
        return pd.concat(out)[keys].astype(str).sort_values(keys).values.tolist(), max(sizes)

    whole, most = run(10_000)
    parts, least = run(100)
    assert parts == whole and len(whole) == 666 and most > 500 and least < 200


def test_ticks_have_a_bucket_of_their_own(spark):
    rows = spark.createDataFrame([("a", 1, 3, 0)], "machine_id string, timestamp bigint, bucket int, salt int")
    ticks = spark.createDataFrame([(9,)], "timestamp bigint")
    got = stateful._watched(rows, ticks, "1 minute").select("bucket", "salt", "tick").collect()
    assert sorted(map(tuple, got)) == [(-1, -1, True), (3, 0, False)]
