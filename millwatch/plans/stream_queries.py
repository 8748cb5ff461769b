"""The stream operators run over the whole events table as a stream of files, read back as tables.

A stream can only settle what its watermark has passed. The input here is finite, so a tick at its end
moves the watermark past all of it, and the answers are for every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.operators import manifests, parse, rules, series, windows
from millwatch.plans import guard, views
from millwatch.plans.queries import HOUR, Query, current_manifests, flat, off_ties, rounded
from millwatch.session import shared_folder
from millwatch.sources.bronze import Bronze
from millwatch.streaming import late, rule_state, sinks, stateful

QUERIES: dict[str, Query] = {}
DAY = 24 * HOUR


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _cores(spark: SparkSession) -> int:
    """One state store per core."""
    return spark.sparkContext.defaultParallelism


def settle(spark: SparkSession, df: DataFrame, name: str, *, base: str | None = None, **options) -> DataFrame:
    """Run a stream until it has read everything, and read its output."""
    base = base or shared_folder(spark, name)
    sinks.start_files(df, f"{base}/out", f"{base}/checkpoint", once=True, partitions=_cores(spark),
                      **options).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


#: A time after all input, in epoch ms.
END = 4_102_444_800_000


def tick(spark: SparkSession, path: str, at: int) -> DataFrame:
    """Add a tick to a folder of ticks, and give the folder as a stream."""
    spark.range(1).select(F.lit(at).cast("bigint").alias("timestamp")).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("timestamp bigint").parquet(path)


def end(spark: SparkSession) -> DataFrame:
    """The tick that closes an input read in one micro-batch."""
    return tick(spark, f"{shared_folder(spark, 'ticks')}", END)


def closed(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Readings behind a watermark that an end tick moves. The tick's own row has no machine; leave it out when reading."""
    return windows.with_event_time(readings.unionByName(end(spark), allowMissingColumns=True), windows.LATENESS)


@query
def stream_parse(spark, sf):
    rows = parse.parse_telemetry(views.raw_telemetry_of(views.event_stream(spark, sf)))
    return settle(spark, rows.select("offset", "machine_id", "timestamp", "gas_temperature", "error_type"), "parse")


@query
def stream_context(spark, sf):
    ev = views.event_stream(spark, sf)
    rows = stateful.attach_context_stream(views.telemetry_of(ev), views.context_of(ev), salts=2, ticks=end(spark))
    return settle(spark, rows.select("machine_id", "timestamp", "seq", "gas_temperature", "event_type", "context_ts"),
                  "context")


@query
def stream_trim(spark, sf):
    ev = views.event_stream(spark, sf)
    rows = stateful.edge_trim_stream(views.telemetry_of(ev), views.context_of(ev), HOUR, HOUR, "tag", salts=2,
                                     ticks=end(spark))
    return settle(spark, rows.select("machine_id", "timestamp", "seq", "run_id", "start_ts", "disposition"), "trim")


@query
def stream_trim_outputs(spark, sf):
    """What the trimming stream keeps, trims and leaves pending, each in its own output."""
    ev, base = views.event_stream(spark, sf), shared_folder(spark, "trim-outputs")
    rows = stateful.edge_trim_stream(views.telemetry_of(ev), views.context_of(ev), HOUR, HOUR, "tag", salts=2, ticks=end(spark))
    sinks.start(rows, lambda b, i: sinks.write_trimmed(b, i, f"{base}/out"), f"{base}/checkpoint", once=True,
                partitions=_cores(spark)).awaitTermination()
    return sinks.read_batches(spark, f"{base}/out").select("machine_id", "timestamp", "seq", "run_id", "output")


@query
def stream_trim_manifest(spark, sf):
    ev = views.event_stream(spark, sf)
    rows = stateful.edge_trim_stream(views.telemetry_of(ev), views.context_of(ev), manifests=current_manifests(spark, sf), salts=2,
                                     ticks=end(spark))
    return settle(spark, rows.select("machine_id", "timestamp", "seq", "run_id", "disposition"), "trim-manifest")


@query
def stream_ewma(spark, sf):
    rows = stateful.ewma_stream(views.telemetry_of(views.event_stream(spark, sf)), "gas_temperature", 0.3,
                                ticks=end(spark))
    return settle(spark, rows.select("machine_id", "timestamp", "seq", off_ties("gas_temperature_ewma")), "ewma")


@query
def stream_guard(spark, sf):
    rows = stateful.implicit_closes_stream(views.context_of(views.event_stream(spark, sf)), ticks=end(spark))
    return settle(spark, rows.select("device_id", "context_anomaly.previous_run_id", "context_anomaly.current_run_id",
                                     "context_anomaly.implicit_transition_ts"), "guard")


@query
def stream_stats(spark, sf):
    rows = closed(spark, views.telemetry_of(views.event_stream(spark, sf)))
    stats = windows.window_stats(rows, "1 hour")
    return settle(spark, stats.select("machine_id", F.unix_millis("window_start").alias("window_start"), "n",
                                      "gas_temperature_min", "gas_temperature_max"), "stats").where("machine_id is not null")


@query
def stream_sessions(spark, sf):
    rows = closed(spark, views.telemetry_of(views.event_stream(spark, sf)))
    found = windows.session_stream(rows, "12 hours")
    return settle(spark, found.select("machine_id", F.unix_millis("session_start").alias("session_start"),
                                      F.unix_millis("last_seen").alias("last_seen"), "n"), "sessions").where("machine_id is not null")


@query
def stream_late(spark, sf):
    """Every tenth reading arrives when the watermark has passed all others, and its context is no longer in state.

    None is lost, and each finds its context, in the table of all context events where it must.
    """
    base, readings, delayed = shared_folder(spark, "late"), views.telemetry(spark, sf), F.col("seq") % 10 == 0
    ticks = tick(spark, f"{base}/ticks", 0)
    readings.where(~delayed).write.parquet(f"{base}/in")
    rows = stateful.attach_context_stream(
        spark.readStream.schema(readings.schema).parquet(f"{base}/in"), views.context_of(views.event_stream(spark, sf)),
        salts=2, ticks=ticks)
    settle(spark, rows, "late", base=base)
    readings.where(delayed).write.mode("append").parquet(f"{base}/in")
    tick(spark, f"{base}/ticks", END)
    placed = late.placed_again(settle(spark, rows, "late", base=base), views.context_of(views.events(spark, sf)))
    return placed.select("machine_id", "timestamp", "seq", "event_type", "context_ts", "late")


@query
def stream_late_context(spark, sf):
    """All context comes when every reading has been given out: what it changes is given out again."""
    base, readings = shared_folder(spark, "late-context"), views.telemetry(spark, sf)
    events = views.context_of(views.events(spark, sf))
    events.limit(0).write.parquet(f"{base}/events")
    rows = stateful.attach_context_stream(
        views.telemetry_of(views.event_stream(spark, sf)), spark.readStream.schema(events.schema).parquet(f"{base}/events"),
        salts=2, ticks=end(spark))
    names = ["machine_id", "timestamp", "seq", "gas_temperature", "event_type", "context_ts"]
    placed = settle(spark, rows.select(*names), "late-context", base=base)
    events.write.mode("append").parquet(f"{base}/events")
    targets = sinks.Targets(context=f"{base}/context")

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_context(batch, batch_id, targets)
        changed = late.corrections(batch, readings, sinks.read_context(spark, targets))
        changed.select(*names).write.mode("overwrite").parquet(f"{base}/changed/batch_id={batch_id}")

    arriving = spark.readStream.schema(events.schema).parquet(f"{base}/events")
    sinks.start(arriving, write, f"{base}/corrections", once=True, partitions=_cores(spark)).awaitTermination()
    versions = placed.withColumn("version", F.lit(-1).cast("bigint")).unionByName(
        spark.read.parquet(f"{base}/changed").withColumn("version", F.col("batch_id").cast("bigint")).drop("batch_id"))
    return late.last_version(versions, ["machine_id", "timestamp", "seq"]).select(*names)


@query
def stream_evaluation(spark, sf):
    """The running job's evaluation, all rules of the plant and implicit closes in it, read back from its outputs."""
    base, events = shared_folder(spark, "evaluation"), views.context(spark, sf)
    events.write.parquet(f"{base}/events")
    targets = sinks.Targets(**{n: f"{base}/{n}" for n in ("bronze", "evaluation", "dlq", "errors", "alerts")})
    started = guard.start_evaluation(
        views.telemetry_of(views.event_stream(spark, sf)), spark.readStream.schema(events.schema).parquet(f"{base}/events"),
        lambda: views.rules(spark), targets, f"{base}/checkpoint", once=True, partitions=_cores(spark), ticks=end(spark), keep_ms=40 * DAY)
    for q in started:
        q.awaitTermination()
    shape = "alert_id string, alert_time bigint, rule_id string, severity string, device_id string, change int, alert_type string"
    sent = sinks.read_batches(spark, targets.alerts).select(F.from_json("value", shape).alias("a")).select("a.*")
    rates = sent.where(F.col("alert_type").isin("rate_above", "rate_below"))
    standing = rates.groupBy("device_id", "alert_time", "rule_id", "severity").agg(F.sum("change").alias("n")).where("n > 0")
    body = ("device_id string, timestamp bigint, gas_temperature double, gas_pressure double, humidity double, spin_rate double, torque double, "
            "status string, fault_code string, run_id string, event_type string, start_ts bigint, end_ts bigint, passed boolean, "
            "alert struct<rule_id:string,severity:string>, context_anomaly struct<previous_run_id:string>")
    rows = sinks.read_batches(spark, targets.evaluation).select(F.from_json("value", body).alias("e")).select("e.*")
    out = late.with_changes(rows, standing)
    return out.select(*[c for c in out.columns if c not in ("alert", "context_anomaly")],
                      F.col("alert.rule_id").alias("alert_rule"), F.col("alert.severity").alias("alert_severity"),
                      F.col("context_anomaly.previous_run_id").alias("closed_run"))


@query
def stream_clock(spark, sf):
    """Where each message ends: placed in its run, or a dead letter. One in 97 has a clock 50 years ahead."""
    ahead, wrong = 50 * 365 * 24 * HOUR, F.col("event_id") % 97 == 0
    ev = views.event_stream(spark, sf)
    bad = ev.withColumn("ms", F.when(wrong, F.col("ms") + ahead).otherwise(F.col("ms")))
    arrival = F.when(F.col("offset") % 97 == 0, F.timestamp_millis(F.unix_millis("timestamp") - ahead))
    raw = views.raw_telemetry_of(bad).withColumn("timestamp", F.coalesce(arrival, "timestamp"))
    parsed = parse.check_clock(parse.parse_telemetry(raw))
    rows = stateful.attach_context_stream(parse.good(parsed, keep_record=True), views.context_of(ev), salts=2,
                                          ticks=end(spark))
    placed = settle(spark, rows.select("offset", F.lit("placed").alias("outcome")), "clock")
    failed = settle(spark, parse.failures(parsed, "telemetry-parser").select("offset", "error_type"), "clock")
    return placed.unionByName(failed.withColumnRenamed("error_type", "outcome"))


@query
def stream_dedupe(spark, sf):
    """Readings stamped by the day, so that many share a machine and time, in three micro-batches: the last one stays."""
    base = shared_folder(spark, "dedupe")
    day = views.telemetry(spark, sf).withColumn("timestamp", F.expr(f"timestamp div {DAY} * {DAY}"))
    own = series.bronze_rows(day)
    table = Bronze(spark, f"{base}/bronze", own.schema)
    day.limit(0).write.parquet(f"{base}/in")
    arriving = spark.readStream.schema(day.schema).parquet(f"{base}/in")
    for part in (2, 0, 1):  # a later one of the same time may come first
        day.where(F.col("seq") % 3 == part).write.mode("append").parquet(f"{base}/in")
        sinks.start(arriving, lambda b, i: table.replace_last(series.bronze_rows(b), i), f"{base}/checkpoint", once=True,
                    partitions=_cores(spark)).awaitTermination()
    return table.read().select(*day.columns)


def _bronze(spark: SparkSession, sf: str) -> Bronze:
    """A bronze table of all readings, written in four micro-batches and compacted."""
    rows = series.bronze_rows(views.telemetry(spark, sf))
    table = Bronze(spark, shared_folder(spark, "bronze"), rows.schema)
    for i in range(4):
        table.append(rows.where(F.col("seq") % 4 == i), i)
    table.compact()
    return table


@query
def bronze_6h(spark, sf):
    """The last six hours of a bronze table; the manifest says where they end and in which files they are."""
    table = _bronze(spark, sf)
    last = table.zones().agg(F.max("last_ts")).first()[0] or 0
    rows = table.read(since=last - 6 * HOUR + 1)
    return rows.select("machine_id", F.unix_millis("event_time").alias("event_time"), "gas_temperature")


@query
def bronze_devices(spark, sf):
    names = [f"MC{i:06d}" for i in range(1, 11)]
    rows = _bronze(spark, sf).read(machines=names)
    return rows.select("machine_id", F.unix_millis("event_time").alias("event_time"), "gas_temperature", "torque")


@query
def stream_rules(spark, sf):
    """Readings judged in the stream, fanned out per micro-batch, and the alert messages read back."""
    readings = parse.good(parse.parse_telemetry(views.raw_telemetry_of(views.event_stream(spark, sf))))
    simple = rules.latest_rules(views.rules(spark)).where(
        rules.is_instant() & ~F.col("condition").isin("rate_above", "rate_below"))
    base = shared_folder(spark, "rules")
    targets = sinks.Targets(bronze=f"{base}/bronze", evaluation=f"{base}/evaluation", alerts=f"{base}/alerts")

    def write(batch: DataFrame, batch_id: int) -> None:
        # rules are read again for every micro-batch
        sinks.write_batch(rules.evaluate(batch, simple), batch_id, targets)

    sinks.start(readings, write, f"{base}/checkpoint", once=True,
                partitions=_cores(spark)).awaitTermination()
    body = F.col("value")
    return sinks.read_batches(spark, targets.alerts).select(
        F.get_json_object(body, "$.device_id").alias("device_id"),
        F.get_json_object(body, "$.alert_time").cast("bigint").alias("alert_time"),
        F.get_json_object(body, "$.rule_id").alias("rule_id"), F.col("key").alias("key"))


def _in_any_order(spark: SparkSession, sf: str, which: Column, name: str) -> DataFrame:
    """Alerts that stand after the readings have come in three parts, one in ten of them five days late."""
    base, readings = shared_folder(spark, name), views.telemetry(spark, sf)
    arrives = F.col("timestamp") + F.when(F.col("seq") % 10 == 0, 5 * DAY).otherwise(0)
    first, last = readings.agg(F.min(arrives), F.max(arrives)).first()
    part = F.floor((arrives - (first or 0)) * 3 / ((last or 0) - (first or 0) + 1))
    current = rules.latest_rules(views.rules(spark)).where(which)
    ticks = tick(spark, f"{base}/ticks", 0)
    readings.limit(0).write.parquet(f"{base}/in")
    log = rule_state.rule_changes_stream(spark.readStream.schema(readings.schema).parquet(f"{base}/in"), current,
                                         ticks=ticks, keep_ms=6 * DAY)
    for i in range(3):
        readings.where(part == i).write.mode("append").parquet(f"{base}/in")
        if i == 2:
            tick(spark, f"{base}/ticks", END)
        changes = settle(spark, log, name, base=base)
    return rule_state.alerts_of(rule_state.standing(changes), current)


@query
def stream_rule_rate(spark, sf):
    return flat(_in_any_order(spark, sf, rules.is_instant() & rules.is_rate(), "rule-rate"))


@query
def stream_rule_sustained(spark, sf):
    return flat(_in_any_order(spark, sf, F.col("durationSec") > 0, "rule-sustained"))


@query
def stream_rule_windowed(spark, sf):
    rows = _in_any_order(spark, sf, F.col("window").isNotNull(), "rule-windowed")
    return rows.select("device_id", "rule_id", "alert_time", "measurement", "severity", rounded("value"), "threshold")


@query
def stream_manifests(spark, sf):
    """The audit trail as a stream writes it: each micro-batch is judged against what the trail holds by then."""
    base, ev = shared_folder(spark, "manifests"), views.event_table(spark, sf)
    bounds = ev.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - (bounds[0] or 0)) * 3 / ((bounds[1] or 0) - (bounds[0] or 0) + 1))
    ev.limit(0).write.parquet(f"{base}/in")
    arriving = views.raw_manifests_of(views.prepare(spark.readStream.schema(ev.schema).parquet(f"{base}/in")))
    for i in range(3):
        ev.where(part == i).write.mode("append").parquet(f"{base}/in")
        sinks.start(manifests.validate_manifests(arriving), lambda b, n: sinks.write_manifests(b, n, f"{base}/trail"),
                    f"{base}/checkpoint", once=True, partitions=_cores(spark)).awaitTermination()
    return sinks.read_batches(spark, f"{base}/trail").select("offset", "device_type", "version", "event", "status", "reason")


@query
def stream_bronze(spark, sf):
    """Bronze written by the stream, read by device."""
    readings = parse.good(parse.parse_telemetry(views.raw_telemetry_of(views.event_stream(spark, sf))))
    base = shared_folder(spark, "bronze")
    targets = sinks.Targets(bronze=f"{base}/bronze")
    sinks.start(readings, lambda b, i: sinks.write_batch(b, i, targets), f"{base}/checkpoint", once=True,
                partitions=_cores(spark)).awaitTermination()
    return sinks.read_bronze(spark, targets).groupBy("device_path", F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.max("gas_temperature").alias("max_temperature"))


@query
def stream_dead_letters(spark, sf):
    """Dead letters of the stream, keyed by device."""
    rows = parse.parse_telemetry(views.raw_telemetry_of(views.event_stream(spark, sf)))
    base = shared_folder(spark, "errors")
    targets = sinks.Targets(errors=f"{base}/errors")
    sinks.start(rows, lambda b, i: sinks.write_errors(b, i, targets), f"{base}/checkpoint", once=True,
                partitions=_cores(spark)).awaitTermination()
    return sinks.read_batches(spark, targets.errors).groupBy(
        "key", F.get_json_object("value", "$.error_type").alias("error_type")).agg(F.count(F.lit(1)).alias("n"))


