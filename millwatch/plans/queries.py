"""Named queries over the plant's tables. Every one reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import scalars
from millwatch.functions.safe import safe
from millwatch.operators import (
    context, detectors, dims, kpi, manifests, parse, quality, rules, series, trimming, windows,
)
from millwatch.functions.frames import localize
from millwatch.plans import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = 1_735_689_600_000  # the "current" time of queries that stamp rows: 2025-01-01 UTC
HOUR = 3_600_000
GAP = 12 * HOUR


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _ms(name: str):
    return F.unix_millis(name).alias(name)


def rounded(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


def off_ties(name: str):
    """Rounded a little off the decimal grid, where two ways of adding up could round a tie apart."""
    return F.round(F.col(name) + 1.2345678901e-7, 6).alias(name)


# Parsing and dead letters

@query
def parse_telemetry(spark, sf):
    return parse.good(parse.parse_telemetry(views.raw_telemetry(spark, sf)))


@query
def parse_generic(spark, sf):
    rows = parse.parse_generic(views.raw_generic(spark, sf))
    m = F.col("measurements")
    return rows.select("offset", F.col("deviceId").alias("device_id"), "ts", m["temperature"].alias("temperature"),
                       m["humidity"].alias("humidity"), "error_type", "error_message")


@query
def parse_context(spark, sf):
    return parse.good(parse.parse_context(views.raw_context(spark, sf)))


@query
def parse_rules(spark, sf):
    rows = parse.good(parse.parse_rules(views.raw_rules(spark, sf)), keep_record=True)
    return rows.select("offset", "rule_id", "version", "measurement", "condition", "threshold", "severity", "enabled")


@query
def error_split(spark, sf):
    rows = parse.parse_telemetry(views.raw_telemetry(spark, sf))
    return rows.select("offset", "machine_id", "error_type", "error_message")


def _letters(spark, sf):
    return parse.dead_letters(parse.parse_telemetry(views.raw_telemetry(spark, sf)), now=NOW)


@query
def dead_letters(spark, sf):
    rows = _letters(spark, sf)
    return rows.groupBy("timestamp", "source", "error_type", "error_message", "device_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("request_id").alias("ids"),
        F.count("stack_trace").alias("traces"))


@query
def dlq_by_device(spark, sf):
    return quality.dlq_counts(_letters(spark, sf), "device_id")


@query
def dlq_by_type(spark, sf):
    return quality.dlq_counts(_letters(spark, sf), "error_type")


@query
def dlq_rate_5m(spark, sf):
    rows = parse.parse_telemetry(views.raw_telemetry(spark, sf))
    return quality.dlq_rate(rows).select(_ms("window_start"), "total", "dlq", "dlq_rate")


@query
def repeat_errors(spark, sf):
    return quality.repeat_errors(_letters(spark, sf), 2)


@query
def safe_map(spark, sf):
    """A user's Python function that fails on some rows."""
    def parity(text: str) -> int:
        k = int(text.split(":")[1].strip(" }"))
        if k % 10 == 0:
            raise ValueError(f"round value {k}")
        return k

    guarded = safe(parity, "bigint")
    rows = views.event_table(spark, sf).select("event_id", guarded("props").alias("_s"))
    return rows.select("event_id", F.col("_s.ok").alias("ok"), F.col("_s.error").alias("error"))


@query
def scalar_functions(spark, sf):
    """The scalar functions over every event."""
    ev = views.events(spark, sf)
    unit = F.element_at(F.array(*map(F.lit, schemas.TIMESTAMP_UNITS)), (F.col("event_id") % 3 + 1).cast("int"))
    version = F.when(F.col("event_id") % 4 == 0, "1.x").otherwise(
        F.concat_ws(".", F.lit("1"), (F.col("event_id") % 20).cast("string"), (F.col("user_id") % 5).cast("string")))
    names = F.array(F.col("event_type"), F.lit("view"), F.lit("click"))
    return ev.select(
        "event_id",
        scalars.truncate(F.repeat("event_type", 5), 22).alias("cut"),
        scalars.device_path(schemas.STORAGE_GROUP, F.col("machine_id")).alias("path"),
        scalars.path_from_pattern(F.lit("root.sg.weather.${deviceId}"), F.col("machine_id")).alias("pattern_path"),
        scalars.to_millis(F.col("ms"), unit).alias("millis"),
        scalars.seconds_to_millis(F.col("value")).alias("value_ms"),
        scalars.iso_instant(F.col("ms")).alias("iso"),
        scalars.is_semver(version).alias("semver_ok"),
        scalars.semver(version)["minor"].alias("semver_minor"),
        scalars.join_errors(scalars.duplicates(names)).alias("repeated"),
        scalars.severity_rank(F.element_at(F.array(*map(F.lit, schemas.SEVERITIES)),
                                           (F.col("event_id") % 3 + 1).cast("int"))).alias("severity_rank"),
        scalars.stable_id(F.col("machine_id"), F.col("ms")).alias("id"),
    )


# Run context

@query
def context_asof(spark, sf):
    cuts = views.cuts(spark, sf)
    return context.attach_context(views.telemetry(spark, sf), views.context(spark, sf, cuts), cuts=cuts).select(
        "machine_id", "timestamp", "seq", "gas_temperature", "run_id", "event_type", "start_ts", "end_ts", "context_ts")


@query
def context_active(spark, sf):
    cuts = views.cuts(spark, sf)
    rows = context.attach_context(views.telemetry(spark, sf), views.context(spark, sf, cuts), active_only=True, cuts=cuts)
    return rows.groupBy("machine_id", "run_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("gas_temperature").alias("max_temperature"))


@query
def implicit_close(spark, sf):
    cuts = views.cuts(spark, sf)
    return context.implicit_closes(views.context(spark, sf, cuts), cuts=cuts).select("device_id", "context_anomaly.*")


@query
def runs(spark, sf):
    return _runs(spark, sf, views.cuts(spark, sf))


def _runs(spark, sf, cuts):
    return context.runs(views.context(spark, sf, cuts), cuts=cuts)


@query
def run_interval_join(spark, sf):
    cuts = views.cuts(spark, sf)
    rows = context.in_run(views.telemetry(spark, sf), _runs(spark, sf, cuts), cuts=cuts)
    return rows.select("machine_id", "timestamp", "seq", "run_id", "start_ts", "end_ts")


@query
def dlq_records(spark, sf):
    cuts = views.cuts(spark, sf)
    rows = context.dlq_records(context.implicit_closes(views.context(spark, sf, cuts), cuts=cuts), NOW)
    return rows.select("anomaly_id", "device_id", "anomaly_type", "context_anomaly.*", "status",
                       "resolution_action", "created_ts", "resolved_ts")


@query
def reconcile_trackout(spark, sf):
    cuts = views.cuts(spark, sf)
    ctx = views.context_late(spark, sf, cuts)
    rows = context.reconcile(context.dlq_records(context.implicit_closes(ctx, cuts=cuts), NOW), ctx, cuts=cuts)
    return rows.select("device_id", "context_anomaly.previous_run_id", "context_anomaly.current_run_id",
                       "context_anomaly.implicit_transition_ts", "status", "resolved_ts")


@query
def anomaly_dlq(spark, sf):
    """Dead-letter records of the readings that carry an anomaly."""
    cuts = views.cuts(spark, sf)
    rows = context.attach_context(views.telemetry(spark, sf), views.context(spark, sf, cuts), anomalies=True, cuts=cuts)
    out = context.anomaly_dlq(rows.withColumnRenamed("machine_id", "device_id"), NOW)
    return out.select("anomaly_id", "device_id", "context_anomaly.previous_run_id",
                      "context_anomaly.current_run_id", "context_anomaly.implicit_transition_ts", "status")


# Rules

def _current_rules(spark):
    return rules.latest_rules(views.rules(spark))


def flat(alert_rows):
    return alert_rows.select("device_id", "alert_id", "alert_time", "rule_id", "alert_type", "measurement", "value",
                             "threshold", "severity", "message")


def _evaluated(spark, sf):
    cuts = views.cuts(spark, sf)
    rated = rules.rate_of_change(views.telemetry(spark, sf), ["gas_temperature", "torque"], cuts=cuts)
    placed = context.attach_context(rated, views.context(spark, sf, cuts), anomalies=True, cuts=cuts)
    return rules.evaluate(placed, _current_rules(spark))


@query
def rules_latest(spark, sf):
    rows = parse.good(parse.parse_rules(views.raw_rules(spark, sf)), keep_record=True)
    return rules.latest_rules(rows).select("rule_id", "version", "threshold", "offset")


@query
def rule_validate(spark, sf):
    """What is wrong with each rule that was sent; an empty text if nothing is."""
    found = rules.rule_errors(views.sent_rules(spark, sf), views.telemetry(spark, sf))
    return found.select("rule_id", F.concat_ws(", ", "errors").alias("errors"))


@query
def rules_in_force(spark, sf):
    """Every reading against the version of its type's rule that was in force when it was taken."""
    return flat(rules.in_force(views.telemetry(spark, sf), views.limit_versions(spark, sf)))


@query
def rule_instant(spark, sf):
    simple = _current_rules(spark).where(~F.col("condition").isin("rate_above", "rate_below", "custom"))
    return flat(rules.alerts(rules.evaluate(views.telemetry(spark, sf), simple)))


@query
def rule_join(spark, sf):
    """The same instant rules judged by the measurement join: one row per reading and rule."""
    simple = _current_rules(spark).where(rules.is_instant() & F.col("condition").isin(
        "greater_than", "less_than", "between", "outside"))
    return rules.judge(views.telemetry(spark, sf), simple).groupBy("machine_id", "rule_id").agg(
        F.count(F.lit(1)).alias("judged"), F.count_if("breached").alias("breached"))


@query
def rule_custom(spark, sf):
    custom = _current_rules(spark).where(F.col("condition") == "custom")
    return flat(rules.alerts(rules.evaluate(views.telemetry(spark, sf), custom)))


@query
def rate_of_change(spark, sf):
    rows = rules.rate_of_change(views.telemetry(spark, sf), ["gas_temperature", "torque"])
    return rows.select("machine_id", "timestamp", "seq", "gas_temperature_rate", "torque_rate")


@query
def rule_rate(spark, sf):
    rates = _current_rules(spark).where(F.col("condition").isin("rate_above", "rate_below"))
    rated = rules.rate_of_change(views.telemetry(spark, sf), ["gas_temperature", "torque"])
    return flat(rules.alerts(rules.evaluate(rated, rates)))


@query
def rule_sustained(spark, sf):
    return flat(rules.sustained_rules(views.telemetry(spark, sf), _current_rules(spark)))


@query
def rule_windowed(spark, sf):
    rows = rules.windowed_rules(views.telemetry(spark, sf), _current_rules(spark))
    return rows.select("device_id", "rule_id", "alert_time", "measurement", "severity", rounded("value"), "threshold")


@query
def evaluation(spark, sf):
    rows = rules.evaluation(_evaluated(spark, sf))
    return rows.select(*[c for c in rules.EVALUATION if c not in ("alert", "context_anomaly")],
                       F.col("alert.rule_id").alias("alert_rule"), F.col("alert.severity").alias("alert_severity"),
                       F.col("context_anomaly.previous_run_id").alias("closed_run"))


@query
def evaluation_messages(spark, sf):
    """The evaluation as JSON, read back by path."""
    body = parse.to_message(rules.evaluation(_evaluated(spark, sf)))
    get = F.get_json_object
    return body.select(
        get("value", "$.device_id").alias("device_id"), get("value", "$.timestamp").cast("bigint").alias("timestamp"),
        get("value", "$.passed").alias("passed"), get("value", "$.alert.rule_id").alias("rule_id"),
        F.col("value").contains('"fault_code":null').alias("null_kept"))


@query
def alerts(spark, sf):
    return flat(rules.alerts(_evaluated(spark, sf)))


@query
def alert_counts(spark, sf):
    return rules.alert_counts(rules.alerts(_evaluated(spark, sf)))


# Series reads

@query
def series_6h(spark, sf):
    rows = views.telemetry(spark, sf)
    ref = F.timestamp_millis(rows.agg(F.max("timestamp")).scalar())
    return series.last_hours(rows, "gas_temperature", 6, ref=ref).select(
        "machine_id", _ms("event_time"), "gas_temperature")


_TEN = [f"MC{i:06d}" for i in range(1, 11)]


@query
def series_devices(spark, sf):
    return series.series(views.telemetry(spark, sf), ["gas_temperature", "torque"], devices=_TEN,
                         prefix="root.factory1.*").select("machine_id", _ms("event_time"), "gas_temperature", "torque")


@query
def series_ordered(spark, sf):
    rows = series.ordered_series(series.series(views.telemetry(spark, sf), "humidity", prefix="root.factory1.MC00000*"))
    return rows.select("machine_id", _ms("event_time"), "humidity")


@query
def series_pivot(spark, sf):
    return series.series_wide(views.telemetry(spark, sf), "gas_temperature", _TEN).withColumn(
        "event_time", F.unix_millis("event_time"))


@query
def last_value(spark, sf):
    return series.last_value(views.telemetry(spark, sf), "gas_temperature")


@query
def count_by_device(spark, sf):
    return series.count_by_device(views.telemetry(spark, sf))


@query
def count_by_path(spark, sf):
    return series.count_by_path(views.telemetry(spark, sf))


@query
def timeseries_list(spark, sf):
    return series.series_list(views.telemetry(spark, sf))


@query
def first_10(spark, sf):
    return series.first_n(views.telemetry(spark, sf), 10)


@query
def any_message(spark, sf):
    return series.exists(views.raw_telemetry(spark, sf))


@query
def bronze_projection(spark, sf):
    rows = series.bronze_rows(_evaluated(spark, sf))
    return rows.withColumns({"event_time": F.unix_millis("event_time"), "date": F.col("date").cast("string")})


@query
def dedupe_series(spark, sf):
    """Readings stamped by the day, so that many share a machine and timestamp."""
    day = views.telemetry(spark, sf).withColumn("timestamp", F.expr("timestamp div 86400000 * 86400000"))
    return series.dedupe(day)


@query
def color_class(spark, sf):
    rows = series.color_class(views.telemetry(spark, sf), "gas_temperature")
    return rows.select("machine_id", "timestamp", "seq", "gas_temperature", "color")


@query
def noisiest(spark, sf):
    return quality.top_devices(rules.alerts(_evaluated(spark, sf)), 10)


# Windows and detectors

@query
def stats_1m(spark, sf):
    rows = windows.window_stats(views.telemetry(spark, sf), "1 minute", measurements=["gas_temperature", "humidity"])
    return rows.select("machine_id", _ms("window_start"), _ms("window_end"), "n", *[
        rounded(f"{m}_{s}") for m in ("gas_temperature", "humidity") for s in ("min", "max", "avg", "stddev")])


@query
def sliding_stats(spark, sf):
    rows = windows.window_stats(views.telemetry(spark, sf), "1 day", "6 hours")
    return rows.select("machine_id", _ms("window_start"), "n", "gas_temperature_min", "gas_temperature_max",
                       rounded("gas_temperature_avg"), rounded("gas_temperature_stddev"))


@query
def sessions(spark, sf):
    rows = windows.sessions(views.telemetry(spark, sf), GAP)
    return rows.select("machine_id", _ms("session_start"), _ms("last_seen"), "n")


@query
def shift_agg(spark, sf):
    rows = windows.shift_stats(_evaluated(spark, sf), 8)
    return rows.select("machine_id", _ms("window_start"), "n", "gas_temperature_min", "gas_temperature_max",
                       rounded("gas_temperature_avg"))


@query
def ewma(spark, sf):
    rows = detectors.ewma(views.telemetry(spark, sf), "gas_temperature", 0.3)
    return rows.select("machine_id", "timestamp", "seq", off_ties("gas_temperature_ewma"))


@query
def cusum(spark, sf):
    rows = detectors.cusum(views.telemetry(spark, sf), "gas_temperature", 50.0, 5.0, 150.0)
    return rows.select("machine_id", "timestamp", "seq", rounded("gas_temperature_cusum"), "gas_temperature_alarm")


@query
def zscore(spark, sf):
    rows = detectors.zscore(views.telemetry(spark, sf), "humidity", 10)
    return rows.select("machine_id", "timestamp", "seq", rounded("humidity_z"))


@query
def latency_pct(spark, sf):
    rows = views.event_table(spark, sf).select(
        "event_type", scalars.seconds_to_millis(F.col("value")).alias("latency_ms"))
    return quality.latency_percentiles(rows, by=["event_type"])


# Edge trimming

@query
def edge_trim(spark, sf):
    cuts = views.cuts(spark, sf)
    rows = trimming.edge_trim(views.telemetry(spark, sf), _runs(spark, sf, cuts), HOUR, HOUR, cuts=cuts)
    return rows.select("machine_id", "timestamp", "seq", "run_id", "start_ts", "end_ts", "disposition")


@query
def edge_trim_tag(spark, sf):
    cuts = views.cuts(spark, sf)
    rows = trimming.edge_trim(views.telemetry(spark, sf), _runs(spark, sf, cuts), HOUR, HOUR, "tag", cuts=cuts)
    return rows.groupBy("machine_id", "disposition").agg(F.count(F.lit(1)).alias("n"))


@query
def edge_trim_manifest(spark, sf):
    cuts = views.cuts(spark, sf)
    rows = trimming.edge_trim_by_manifest(
        views.telemetry(spark, sf), _runs(spark, sf, cuts), current_manifests(spark, sf), cuts=cuts)
    return rows.select("machine_id", "timestamp", "seq", "run_id", "disposition")


# Manifests

def _history(spark, sf):
    return manifests.manifest_history(manifests.validate_manifests(views.raw_manifests(spark, sf)),
                                      cuts=views.manifest_cuts(spark, sf))


def current_manifests(spark, sf):
    return localize(manifests.current_manifests(_history(spark, sf)), 1000)[0]


@query
def manifest_validate(spark, sf):
    rows = manifests.validate_manifests(views.raw_manifests(spark, sf))
    return rows.select("offset", F.col("manifest.version").alias("version"), "valid",
                       scalars.join_errors(F.col("errors")).alias("errors"))


@query
def manifest_history(spark, sf):
    return _history(spark, sf).select("offset", "device_type", "version", "event", "status", "reason")


@query
def manifest_intervals(spark, sf):
    rows = manifests.manifest_intervals(_history(spark, sf))
    return rows.select("device_type", "version", "valid_from", "valid_to")


@query
def manifest_versions(spark, sf):
    return manifests.manifest_versions(_history(spark, sf))


@query
def manifest_current(spark, sf):
    return manifests.current_manifests(_history(spark, sf)).select(
        "device_type", "version", F.col("manifest.storageGroup").alias("storage_group"),
        F.col("manifest.edgeTrimming.leadSeconds").alias("lead_seconds"),
        F.size("manifest.kpivRules").cast("bigint").alias("rules"))


@query
def manifest_lookup(spark, sf):
    rows = manifests.attach_manifest(views.telemetry(spark, sf), current_manifests(spark, sf))
    first = scalars.first_named(F.col("_manifest.measurements"), "name", "gas_pressure")
    return rows.groupBy("machine_type", F.col("_manifest.version").alias("version"), first["unit"].alias("unit")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def manifest_rules(spark, sf):
    """Alerts of the rules that the current manifests bring along."""
    brought = manifests.manifest_rules(current_manifests(spark, sf)).withColumn(
        "rule_id", F.concat_ws("/", "device_type", "rule_id"))
    return rules.alert_counts(rules.alerts(rules.evaluate(views.telemetry(spark, sf), brought)))


def _devices(spark, sf):
    return views.registry(spark, sf).select(F.col("machine_id").alias("device_id"), F.col("machine_type").alias("device_type"))


@query
def schema_requests(spark, sf):
    return manifests.schema_requests(current_manifests(spark, sf), _devices(spark, sf))


@query
def new_series(spark, sf):
    """Series with readings that no request has registered: here, those the manifests leave out."""
    seen = series.series_list(views.telemetry(spark, sf))
    asked = manifests.schema_requests(current_manifests(spark, sf), _devices(spark, sf)).where(
        F.col("kind") == "CREATE_TIMESERIES")
    known = asked.select(F.substring_index("device_path", ".", -1).alias("device_id"), "measurement")
    return manifests.new_series(seen, known)


@query
def unknown_devices(spark, sf):
    return manifests.unknown_devices(_devices(spark, sf), current_manifests(spark, sf))


@query
def normalize_units(spark, sf):
    """Readings as text, some not of their declared type, in the manifests' units."""
    t = views.telemetry(spark, sf)
    humidity = F.when(F.col("seq") % 20 == 0, F.lit("n/a")).otherwise(F.col("humidity").cast("int").cast("string"))
    rows = t.select(
        F.col("machine_id").alias("device_id"), F.col("machine_type").alias("device_type"),
        F.col("timestamp").alias("ts"),
        F.col("gas_temperature").cast("string").alias("gas_temperature"),
        F.col("gas_pressure").cast("string").alias("gas_pressure"), humidity.alias("humidity"),
        "status", F.col("torque").cast("string").alias("torque"),
    ).unpivot(["device_id", "device_type", "ts"], ["gas_temperature", "gas_pressure", "humidity", "status", "torque"],
              "measurement", "raw")
    return manifests.normalize(rows, current_manifests(spark, sf), views.units(spark)).drop("flag")


# Dimensions and KPIs

@query
def dim_join(spark, sf):
    bare = views.telemetry(spark, sf).drop("machine_type", "location")
    return dims.add_dims(bare, views.registry(spark, sf)).groupBy("machine_type", "location").agg(
        F.count(F.lit(1)).alias("n"), F.max("gas_temperature").alias("max_temperature"))


@query
def fault_bands(spark, sf):
    rows = dims.fault_bands(views.telemetry(spark, sf), dims.fault_band_table(spark))
    return rows.select("machine_id", "timestamp", "seq", F.array_join("profiles", ",").alias("profiles"))


@query
def status_counts(spark, sf):
    return quality.status_counts(views.telemetry(spark, sf))


@query
def utilization(spark, sf):
    return kpi.utilization(views.telemetry(spark, sf))


@query
def throughput(spark, sf):
    rows = kpi.throughput(_runs(spark, sf, views.cuts(spark, sf)))
    return rows.select("device_id", _ms("window_start"), "runs")


@query
def oee(spark, sf):
    rows = kpi.oee(_evaluated(spark, sf), 0.1, cuts=views.cuts(spark, sf))
    return rows.select("machine_id", rounded("availability", 9), rounded("performance", 9), rounded("quality", 9), rounded("oee", 9))


@query
def counters(spark, sf):
    cuts = views.cuts(spark, sf)
    rows = trimming.edge_trim(views.telemetry(spark, sf), _runs(spark, sf, cuts), HOUR, HOUR, "tag", cuts=cuts)
    return quality.counters(rows, kept="disposition = 'KEEP'", trimmed="disposition LIKE 'TRIMMED%'",
                            pending="disposition = 'PENDING'")


@query
def manifest_counters(spark, sf):
    return quality.counters(_history(spark, sf), loaded="event = 'LOAD'", updated="event = 'UPDATE'",
                            rejected="status = 'REJECTED'", downgrades="reason = 'version downgrade'")


@query
def topic_lag(spark, sf):
    """Ends of all partitions against what was read before 2024-01-25."""
    rows = views.raw_telemetry(spark, sf).withColumn(
        "committed", F.when(F.col("timestamp") < F.lit("2024-01-25").cast("timestamp"), F.col("offset")))
    return quality.lag(rows)
