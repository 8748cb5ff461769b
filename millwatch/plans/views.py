"""The plant's tables as views over ``events``: readings, run context, machines, raw messages.

view, click and error events are readings; signup is a trackin and purchase a trackout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.operators.ordered import Cuts, Timeline, last_value, measure, scan


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as they are. The schema is given, so no file is opened to plan a query."""
    return spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(event_table(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """The events table as a stream of files."""
    reader = spark.readStream.schema(schemas.EVENTS).option("pathGlobFilter", "events.parquet").options(**options)
    return prepare(reader.parquet(sf_dir))


def prepare(df: DataFrame) -> DataFrame:
    """Add the machine id and epoch milliseconds, truncated."""
    return df.withColumns({
        "machine_id": F.concat(F.lit("MC"), F.lpad(F.col("user_id").cast("string"), 6, "0")),
        "ms": F.unix_millis(F.col("ts").cast("timestamp")),
    })


def _pick(index: str, values: tuple[str, ...]):
    return F.element_at(F.array(*map(F.lit, values)),
                        (F.col(index) % len(values) + 1).cast("int"))


def telemetry_of(ev: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    fault = F.col("event_type") == "error"
    return ev.where(F.col("event_type").isin("view", "click", "error")).select(
        "machine_id",
        _pick("user_id", schemas.MACHINE_TYPES).alias("machine_type"),
        _pick("user_id", schemas.LOCATIONS).alias("location"),
        F.col("ms").alias("timestamp"),
        F.col("value").alias("gas_temperature"),
        (F.col("value") / 8).alias("gas_pressure"),
        k.alias("humidity"),
        (k * 32).alias("spin_rate"),
        (F.col("value") / 4).alias("torque"),
        F.when(fault, "fault").otherwise("running").alias("status"),
        F.when(fault, F.concat(F.lit("F000"), (F.col("user_id") % 4 + 1).cast("string"))).alias("fault_code"),
        F.col("event_id").alias("seq"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_of(events(spark, sf_dir))


def context_of(ev: DataFrame) -> DataFrame:
    """Context events that carry no run on trackout, as a stream sees them."""
    start = F.col("event_type") == "signup"
    return ev.where(F.col("event_type").isin("signup", "purchase")).select(
        F.col("machine_id").alias("device_id"),
        F.when(start, F.concat(F.lit("R"), F.col("event_id").cast("string"))).alias("run_id"),
        F.when(start, schemas.TRACKIN).otherwise(schemas.TRACKOUT).alias("event_type"),
        F.col("ms").alias("timestamp"),
        F.when(start, F.col("ms")).alias("start_ts"),
        F.when(~start, F.col("ms")).alias("end_ts"),
        F.col("event_id").alias("seq"),
    )


def cuts(spark: SparkSession, sf_dir: str) -> Cuts:
    """The machines to cut, measured once over all events for every operator of a query."""
    return measure((events(spark, sf_dir), ["machine_id"], "ms"))


def context(spark: SparkSession, sf_dir: str, cuts: Cuts | None = None) -> DataFrame:
    """Context events; a trackout names the run of the latest trackin."""
    bare = context_of(events(spark, sf_dir))
    line = Timeline.of(bare, ["device_id"], ["timestamp", "seq"], cuts)
    trackin = F.when(F.col("event_type") == schemas.TRACKIN, F.struct("run_id", "start_ts"))
    return scan(bare, line, {"_match": last_value(trackin)}).select(
        "device_id", F.col("_match.run_id").alias("run_id"), "event_type", "timestamp",
        F.col("_match.start_ts").alias("start_ts"), "end_ts", "seq")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = event_table(spark, sf_dir).select("user_id").distinct()
    return ids.select(
        F.concat(F.lit("MC"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("machine_id"),
        _pick("user_id", schemas.MACHINE_TYPES).alias("machine_type"),
        _pick("user_id", schemas.LOCATIONS).alias("location"),
    )


def raw_telemetry_of(ev: DataFrame) -> DataFrame:
    """Readings as JSON records. Some are broken on purpose, by event number."""
    rows = telemetry_of(ev)
    names = schemas.TELEMETRY.names
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    no_machine = F.to_json(F.struct(*[n for n in names if n != "machine_id"]), {"ignoreNullFields": "false"})
    quoted = F.to_json(
        F.struct(*[F.col(n).cast("string").alias(n) if n == "timestamp" else F.col(n) for n in names]),
        {"ignoreNullFields": "false"})
    case = F.col("seq") % 50
    value = (
        F.when(case == 0, F.substring(whole, 1, 20)).when(case == 1, no_machine)
        .when(case == 2, quoted).when(case == 3, "").otherwise(whole)
    )
    return rows.select(
        F.col("machine_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(schemas.TELEMETRY_TOPIC).alias("topic"),
        (F.col("seq") % 8).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.timestamp_millis("timestamp").alias("timestamp"),
    )


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_telemetry_of(events(spark, sf_dir))


def context_late(spark: SparkSession, sf_dir: str, cuts: Cuts | None = None) -> DataFrame:
    """Context events in which every third trackout names the run before the latest one."""
    ctx = context(spark, sf_dir, cuts)
    line = Timeline.of(ctx, ["device_id"], ["timestamp", "seq"], cuts)
    ins = scan(ctx, line, {"_p": last_value(F.when(F.col("event_type") == schemas.TRACKIN, F.struct("run_id")),
                                            inclusive=False)})
    with_prior = scan(
        ins.withColumn("_own", F.when(F.col("event_type") == schemas.TRACKIN, F.struct(F.col("_p.run_id").alias("r")))),
        line, {"_prior": last_value(F.col("_own"))})
    delayed = (F.col("event_type") == schemas.TRACKOUT) & (F.col("seq") % 3 == 0)
    return with_prior.withColumn("run_id", F.when(delayed, F.col("_prior.r")).otherwise(F.col("run_id"))).select(
        *ctx.columns)


def raw_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context events as JSON records."""
    rows = context_of(events(spark, sf_dir))
    body = F.to_json(F.struct(*schemas.CONTEXT.names), {"ignoreNullFields": "false"})
    return rows.select(body.cast("binary").alias("value"), F.lit(schemas.CONTEXT_TOPIC).alias("topic"),
                       F.lit(0).alias("partition"), F.col("seq").alias("offset"))


def raw_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in the general vocabulary. Some have no measurements, by event number."""
    rows = telemetry(spark, sf_dir)
    values = F.create_map(F.lit("temperature"), F.col("gas_temperature"), F.lit("humidity"), F.col("humidity"))
    names = [F.col("machine_id").alias("deviceId"), F.col("timestamp").alias("ts")]
    body = F.when(F.col("seq") % 40 == 0, F.to_json(F.struct(*names))).otherwise(
        F.to_json(F.struct(*names, values.alias("measurements"))))
    return rows.select(body.cast("binary").alias("value"), F.lit(schemas.TELEMETRY_TOPIC).alias("topic"),
                       F.lit(0).alias("partition"), F.col("seq").alias("offset"))


def raw_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule messages: every click event (re)sends the rule of its user."""
    rows = events(spark, sf_dir).where(F.col("event_type") == "click")
    enabled = F.when(F.col("event_id") % 5 == 0, F.lit(False)).when(F.col("event_id") % 5 == 1, F.lit(True))
    body = F.to_json(F.struct(
        F.concat(F.lit("rule-"), F.col("user_id").cast("string")).alias("rule_id"),
        F.concat(F.lit("1."), F.col("event_id").cast("string")).alias("version"),
        F.lit("gas_temperature").alias("measurement"), F.lit("greater_than").alias("condition"),
        F.col("value").alias("threshold"), F.lit("warning").alias("severity"), enabled.alias("enabled")))
    return rows.select(body.cast("binary").alias("value"), F.lit(schemas.RULES_TOPIC).alias("topic"),
                       F.lit(0).alias("partition"), F.col("event_id").alias("offset"))


# Rule rows: offset, rule_id, device_type, measurement, condition, threshold, lo, hi, severity, enabled,
# window type, window seconds, slide seconds, duration seconds, custom expression, aggregate.
RULES = (
    (0, "hot", None, "gas_temperature", "greater_than", 100.0, None, None, "warning", None, None, None, None, None, None, None),
    (1, "dry", None, "humidity", "less_than", 12.0, None, None, "info", True, None, None, None, None, None, None),
    (2, "squeeze", "pump", "gas_pressure", "between", None, 5.0, 8.0, "critical", True, None, None, None, None, None, None),
    (3, "damp", None, "humidity", "outside", None, 10.0, 90.0, "info", True, None, None, None, None, None, None),
    (4, "fast", "turbine", "spin_rate", "greater_than", 3000.0, None, None, "warning", True, None, None, None, None, None, None),
    (5, "off", None, "humidity", "greater_than", 0.0, None, None, "critical", False, None, None, None, None, None, None),
    (6, "torque", None, "torque", "greater_than", 50.0, None, None, "warning", True, None, None, None, None, None, None),
    (7, "torque", None, "torque", "greater_than", 40.0, None, None, "warning", True, None, None, None, None, None, None),
    (8, "jump", None, "gas_temperature", "rate_above", 0.01, None, None, "critical", True, None, None, None, None, None, None),
    (9, "drop", "conveyor", "torque", "rate_below", -0.005, None, None, "info", True, None, None, None, None, None, None),
    (10, "combo", None, "torque", "custom", None, None, None, "critical", True, None, None, None, None,
     "torque > 20 AND humidity < 50", None),
    (11, "long", None, "gas_temperature", "greater_than", 20.0, None, None, "warning", True, None, None, None, 86400.0, None, None),
    (12, "press", "generator", "gas_pressure", "less_than", 4.0, None, None, "info", True, None, None, None, 43200.0, None, None),
    (13, "daily", None, "gas_temperature", "greater_than", 60.0, None, None, "warning", True, "tumbling", 86400.0, 0.0, None, None, None),
    (14, "slide", None, "humidity", "less_than", 40.0, None, None, "info", True, "sliding", 86400.0, 43200.0, None, None, None),
    (15, "peak", "pump", "torque", "greater_than", 30.0, None, None, "critical", True, "tumbling", 172800.0, 0.0, None, None, "max"),
)
_RULE_COLUMNS = ("offset bigint, rule_id string, device_type string, measurement string, condition string, "
                 "threshold double, lo double, hi double, severity string, enabled boolean, w_type string, "
                 "w_size double, w_slide double, durationSec double, expr string, agg string")


def rules(spark: SparkSession) -> DataFrame:
    """The plant's rule table, as it stands in the rules topic."""
    flat = spark.createDataFrame(list(RULES), _RULE_COLUMNS)
    return flat.withColumns({
        "version": F.lit("1"),
        "rule_type": F.lit(None).cast("string"),
        "window": F.when(F.col("w_type").isNotNull(), F.struct(
            F.col("w_type").alias("type"), F.col("w_size").alias("sizeSeconds"), F.col("w_slide").alias("slideSeconds"))),
        "params": F.map_filter(F.create_map(F.lit("expr"), F.col("expr"), F.lit("aggregate"), F.col("agg")),
                               lambda k, v: v.isNotNull()),
    }).drop("w_type", "w_size", "w_slide", "expr", "agg")


def limit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per machine type, sent anew by every click event with another limit; every seventh switches it off."""
    rows = events(spark, sf_dir).where(F.col("event_type") == "click")
    kind = _pick("user_id", schemas.MACHINE_TYPES)
    return rows.select(
        F.concat(F.lit("limit-"), kind).alias("rule_id"), kind.alias("device_type"), F.lit("gas_temperature").alias("measurement"),
        F.lit("greater_than").alias("condition"), F.col("value").alias("threshold"), F.lit("warning").alias("severity"),
        (F.col("event_id") % 7 != 0).alias("enabled"), F.col("ms").alias("sent"), F.col("event_id").alias("offset"))


def sent_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as users send them: one per click event, most of them wrong in some way, by event number.

    Cases of event_id % 10: 0 condition, 1 measurement, 2 no threshold, 3 half a range, 4 aggregate, 5 to 7 texts that
    call what is not allowed, 8 a usable text.
    """
    case = F.col("event_id") % 10
    text = (F.when(case == 5, "`reflect`('java.lang.System', 'nanoTime') is not null")
            .when(case == 6, "abs(torque) > 1 or reflect/**/('java.lang.System', 'nanoTime') is not null")
            .when(case == 7, "status = \"it's\" or java_method('java.lang.System', 'nanoTime') = 'it''s'")
            .when(case == 8, "abs(torque) > 20 and status <> 'it''s'"))
    window = F.struct(F.lit("tumbling").alias("type"), F.lit(60.0).alias("sizeSeconds"), F.lit(None).cast("double").alias("slideSeconds"))
    return events(spark, sf_dir).where(F.col("event_type") == "click").select(
        F.col("event_id").alias("offset"),
        F.concat(F.lit("rule-"), F.col("event_id").cast("string")).alias("rule_id"),
        F.when(case == 1, "voltage").otherwise("torque").alias("measurement"),
        F.when(case == 0, "over").when(case == 3, "between").when(case >= 5, F.when(case == 9, "greater_than").otherwise("custom"))
        .otherwise("greater_than").alias("condition"),
        F.when(case != 2, F.col("value")).alias("threshold"), F.lit(1.0).alias("lo"), F.lit("info").alias("severity"),
        F.when(case == 4, window).alias("window"),
        F.when(case == 4, F.create_map(F.lit("aggregate"), F.lit("median"))).when(text.isNotNull(), F.create_map(F.lit("expr"), text)).alias("params"))


def raw_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_manifests_of(events(spark, sf_dir))


def raw_manifests_of(ev: DataFrame) -> DataFrame:
    """Manifest messages: one per trackin, for its machine's type. Some are wrong, by event number.

    Cases of event_id % 12: 0 version, 1 repeated measurement, 2 no device type, 3 unknown data
    type, 4 cut text, 5 threshold of the wrong form.
    """
    rows = ev.where(F.col("event_type") == "signup")
    case = F.col("event_id") % 12
    number = F.concat(F.lit("1."), F.expr("event_id div 1000").cast("string"), F.lit("."),
                      (F.col("event_id") % 10).cast("string"))
    machine = _pick("user_id", schemas.MACHINE_TYPES)

    def field(name, kind, unit):
        return F.struct(name.alias("name"), kind.alias("dataType"), F.lit("GORILLA").alias("encoding"),
                        F.lit("SNAPPY").alias("compression"), F.lit(unit).alias("unit"))

    def rule(id_, measurement, condition, threshold):
        return F.struct(F.lit(id_).alias("id"), F.lit(measurement).alias("measurement"),
                        F.lit(condition).alias("condition"), threshold.alias("threshold"),
                        F.lit("warning").alias("severity"))

    number_list = F.array(F.lit(5.0), F.lit(8.0))
    names = F.array(
        field(F.lit("gas_temperature"), F.lit("DOUBLE"), "degF"),
        field(F.when(case == 1, "gas_temperature").otherwise("gas_pressure"),
              F.when(case == 3, "DECIMAL").otherwise("DOUBLE"), "mbar"),
        field(F.lit("humidity"), F.lit("INT32"), "%RH"),
        field(F.lit("status"), F.lit("TEXT"), ""),
    )
    known = F.array(*[F.concat(F.lit("MC"), F.lpad((F.col("user_id") + d).cast("string"), 6, "0")) for d in (0, 5, 10)])
    edge = F.struct((F.lit(3600.0) + F.col("event_id") % 7 * 600).alias("leadSeconds"),
                    F.lit(3600.0).alias("trailSeconds"),
                    F.when(F.col("user_id") % 2 == 0, "tag").otherwise("drop").alias("action"))

    def body(threshold):
        return F.to_json(F.struct(
            F.when(case == 0, "v1").otherwise(number).alias("version"),
            F.when(case != 2, machine).alias("deviceType"),
            F.lit("root.sg.plant").alias("storageGroup"),
            F.lit("root.sg.plant.${deviceId}").alias("devicePathPattern"),
            F.concat(F.lit("tpl_"), machine).alias("templateName"),
            names.alias("measurements"), F.struct(F.lit("ms").alias("timestampUnit")).alias("defaults"),
            edge.alias("edgeTrimming"),
            F.struct(rule("hot", "gas_temperature", "greater_than", F.lit(100.0)).alias("a"),
                     rule("band", "gas_pressure", "between", threshold).alias("b")).alias("kpivRules"),
            known.alias("knownDeviceIds"), F.struct(F.col("event_id").alias("source")).alias("meta")))

    # the two rules differ in the type of their threshold, so they become an array in the text
    def listed(text):
        return F.regexp_replace(text, r'"kpivRules":\{"a":(\{.*?\}),"b":(\{.*?\})\}', r'"kpivRules":[$1,$2]')

    whole = F.when(case == 5, listed(body(F.lit(5.0)))).otherwise(listed(body(number_list)))
    value = F.when(case == 4, F.substring(whole, 1, 60)).otherwise(whole)
    return rows.select(value.alias("value"), F.col("event_id").alias("offset"),
                       F.timestamp_millis("ms").alias("arrival_time"))


def manifest_cuts(spark: SparkSession, sf_dir: str) -> Cuts:
    """Device types to cut, measured without reading any manifest text."""
    sent = events(spark, sf_dir).where(F.col("event_type") == "signup")
    return measure((sent.select(_pick("user_id", schemas.MACHINE_TYPES).alias("device_type"), "event_id"),
                    ["device_type"], "event_id"))


UNITS = (("degF", "degC", 0.5555555555555556, -17.77777777777778), ("mbar", "bar", 0.001, 0.0))


def units(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(UNITS), "unit string, canonical string, scale double, offset double")
