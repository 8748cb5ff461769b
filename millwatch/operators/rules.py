"""Threshold rules: instant, rate, sustained and windowed.

Instant rules are judged inside each row. The rules of a row's device type arrive as one array
through a broadcast equi-join, so no row is multiplied and nothing is shuffled. The same code
runs on streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import scalars
from millwatch.functions.frames import guarded_broadcast, localize, once
from millwatch.operators.expressions import condition, usable
from millwatch.operators.ordered import Cuts, Timeline, asof, last_value, scan
from millwatch.operators.windows import folded

ALL_TYPES = "*"
MAX_CUSTOM = 1_000
AGGREGATES = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count, "stddev": F.stddev_samp}


def latest_rules(rules: DataFrame, order: str = "offset") -> DataFrame:
    """The last rule sent per ``rule_id``; disabled ones are left out. Null counts as enabled."""
    names = rules.columns
    if "enabled" not in names:
        rules = rules.withColumn("enabled", F.lit(None).cast("boolean"))
    return (
        rules.groupBy("rule_id").agg(F.max_by(F.struct(*rules.columns), order).alias("_r"))
        .select("_r.*").where(F.coalesce("enabled", F.lit(True))).select(*names)
    )


def complete(rules: DataFrame) -> DataFrame:
    """Add the rule columns that a narrow rule table leaves out."""
    for field in schemas.RULE.fields:
        if field.name not in rules.columns:
            rules = rules.withColumn(field.name, F.lit(None).cast(field.dataType))
    return rules


def is_instant() -> Column:
    """Neither per window nor over time: a rule is windowed, sustained or instant, and only one of them."""
    return ~scalars.is_windowed(F.col("window")) & (F.coalesce("durationSec", F.lit(0.0)) <= 0)


def is_rate() -> Column:
    return F.col("condition").isin("rate_above", "rate_below")


CONDITIONS = frozenset(("greater_than", "less_than", "between", "outside", "rate_above", "rate_below", "custom"))


def rule_errors(rules: DataFrame, telemetry: DataFrame, *,
                measurements: Sequence[str] = schemas.MEASUREMENTS) -> DataFrame:
    """The rules with ``errors``, an array of texts that is empty for a good rule.

    Checked: condition, measurement, threshold or range, the window's aggregate, and custom expressions.
    """
    rules = complete(rules)
    kind, text = F.col("condition"), F.col("params")["expr"]
    texts = rules.where(kind == "custom").select(text.alias("e")).where("e is not null").distinct()
    empty = telemetry.sparkSession.createDataFrame([], telemetry.schema)
    bad = [r["e"] for r in texts.collect() if not usable(r["e"], empty)]  # configuration
    wrong = {
        "unknown condition": ~F.coalesce(kind.isin(*CONDITIONS), F.lit(False)),
        "unknown measurement": (kind != "custom") & ~F.coalesce(F.col("measurement").isin(*measurements), F.lit(False)),
        "missing threshold": kind.isin("greater_than", "less_than", "rate_above", "rate_below") & F.col("threshold").isNull(),
        "missing range": kind.isin("between", "outside") & (F.col("lo").isNull() | F.col("hi").isNull()),
        "unknown aggregate": scalars.is_windowed(F.col("window")) & ~F.coalesce(F.col("params")["aggregate"].isin(*AGGREGATES), F.col("params")["aggregate"].isNull(), F.lit(True)),
        "unusable expression": (kind == "custom") & (text.isNull() | (text.isin(*bad) if bad else F.lit(False))),
    }
    found = F.array(*[F.when(F.coalesce(w, F.lit(False)), F.lit(name)) for name, w in wrong.items()])
    return rules.withColumn("errors", F.array_compact(found))


def good_rules(rules: DataFrame, telemetry: DataFrame, *,
               measurements: Sequence[str] = schemas.MEASUREMENTS) -> DataFrame:
    return rule_errors(rules, telemetry, measurements=measurements).where(F.size("errors") == 0).drop("errors")


def rejected_rules(rules: DataFrame, telemetry: DataFrame, *,
                   measurements: Sequence[str] = schemas.MEASUREMENTS) -> DataFrame:
    """Dead letters of rules: ``rule_id`` and why it is not judged."""
    found = rule_errors(rules, telemetry, measurements=measurements).where(F.size("errors") > 0)
    return found.select("rule_id", scalars.join_errors(F.col("errors")).alias("error_message"))


def breach(condition: Column, value: Column, rate: Column, threshold: Column, lo: Column, hi: Column,
           custom: Column) -> Column:
    """Whether a rule fires. A null value never does."""
    return F.coalesce(
        F.when(condition == "greater_than", value > threshold)
        .when(condition == "less_than", value < threshold)
        .when(condition == "between", (value >= lo) & (value <= hi))
        .when(condition == "outside", (value < lo) | (value > hi))
        .when(condition == "rate_above", rate > threshold)
        .when(condition == "rate_below", rate < threshold)
        .when(condition == "custom", custom),
        F.lit(False),
    )


def _by_type(rules: DataFrame) -> DataFrame:
    """One row per device type with its rules; those for all types are under ``ALL_TYPES``."""
    keep = F.struct("rule_id", "rule_type", "measurement", "condition", "threshold", "lo", "hi",
                    "severity", "actions", "alertChannel", F.col("params")["expr"].alias("expr"))
    typed = rules.withColumn("device_type", F.coalesce("device_type", F.lit(ALL_TYPES)))
    return typed.groupBy("device_type").agg(F.collect_list(keep).alias("_rules"))


def _lookup(names: Sequence[str], key: Column, suffix: str = "") -> Column:
    """The column whose name equals ``key``."""
    out = F.when(F.lit(False), F.lit(None).cast("double"))
    for n in names:
        out = out.when(key == n, F.col(n + suffix).cast("double"))
    return out


def _kinds(rules: DataFrame, rows: list[Row] | None) -> tuple[set[str], list[str]]:
    """The conditions that occur, and the expressions of custom rules. Configuration; too many is an error."""
    if rows is None:
        expr = F.when(F.col("condition") == "custom", F.col("params")["expr"])
        rows = rules.select("condition", F.struct(expr.alias("expr")).alias("params")).distinct() \
            .limit(MAX_CUSTOM + 1).collect()
    kinds = {r["condition"] for r in rows}
    params = [r["params"] for r in rows if r["condition"] == "custom" and r["params"] is not None]
    custom = {p["expr"] for p in params if "expr" in p} - {None}
    if len(custom) > MAX_CUSTOM:
        raise ValueError(f"more than {MAX_CUSTOM} custom rule expressions")
    return kinds, sorted(custom)


def alert_struct(device: Column, ts: Column, r: Column, value: Column) -> Column:
    """One alert, with the routing the rule asks for."""
    return F.struct(
        scalars.stable_id(device, ts, r["rule_id"]).alias("alert_id"),
        ts.alias("alert_time"),
        r["rule_id"].alias("rule_id"),
        F.coalesce(r["rule_type"], r["condition"]).alias("alert_type"),
        r["measurement"].alias("measurement"),
        value.alias("value"),
        r["threshold"].alias("threshold"),
        r["severity"].alias("severity"),
        F.concat_ws(" ", F.lit("rule"), r["rule_id"], F.lit("on"), r["measurement"],
                    F.concat(F.lit("("), r["condition"], F.lit(")"))).alias("message"),
        r["actions"].alias("actions"),
        r["alertChannel"].alias("alert_channel"),
    )


def evaluate(telemetry: DataFrame, rules: DataFrame, *, measurements: Sequence[str] = schemas.MEASUREMENTS,
             type_column: str = "machine_type") -> DataFrame:
    """Every reading with ``passed``, its worst ``alert`` and all its ``alerts``.

    ``rules`` are current rules (``latest_rules``); those with a window or a duration are judged by
    ``windowed_rules`` and ``sustained_rules``. Rate rules use the ``<measurement>_rate`` columns
    that ``rate_of_change`` adds; a table gets those that are missing, a stream without any is refused. Custom
    rules are conditions over the reading's columns (``expressions``); unusable ones never fire (``rejected_rules``).
    """
    rules = complete(rules)
    columns = telemetry.columns
    # A stream reads its rules again per micro-batch, so there they stay a table.
    instant, rows = rules.where(is_instant()), None
    if not telemetry.isStreaming:
        instant, rows = localize(instant)
    kinds, expressions = _kinds(instant, rows)
    rated = [m for m in measurements if f"{m}_rate" in telemetry.columns]
    if not telemetry.isStreaming and rows is not None:
        telemetry = with_rates(telemetry, rows, measurements)
        rated = [m for m in measurements if f"{m}_rate" in telemetry.columns]
    if not rated and kinds & {"rate_above", "rate_below"}:
        raise ValueError("rate rules need the columns of rate_of_change")
    custom = _custom(expressions, telemetry)

    def judged(r: Column) -> Column:
        verdict = F.when(F.lit(False), F.lit(None).cast("boolean"))
        for text, result in custom.items():
            verdict = verdict.when(r["expr"] == text, result)
        rate = _lookup(rated, r["measurement"], "_rate") if rated else F.lit(None).cast("double")
        return breach(r["condition"], _lookup(measurements, r["measurement"]), rate, r["threshold"],
                      r["lo"], r["hi"], verdict)

    by_type = _by_type(instant)
    own = by_type.select(F.col("device_type").alias(type_column), F.col("_rules").alias("_own"))
    shared = by_type.where(F.col("device_type") == ALL_TYPES).select("_rules").scalar()
    if type_column not in telemetry.columns:
        telemetry = telemetry.withColumn(type_column, F.lit(None).cast("string"))
    own = own.where(F.col(type_column) != ALL_TYPES)
    none = F.array().cast(by_type.schema["_rules"].dataType)
    side = guarded_broadcast(own) if rows is None else F.broadcast(own)
    held = telemetry.join(side, type_column, "left").withColumn(
        "_rules", F.concat(F.coalesce("_own", none), F.coalesce(shared, none)))
    device, ts = F.col("machine_id"), F.col("timestamp")
    fired = F.transform(
        F.filter("_rules", judged),
        lambda r: alert_struct(device, ts, r, _lookup(measurements, r["measurement"])))
    out = once(held, "alerts", fired)
    worst = F.array_min(F.transform("alerts", lambda a: F.struct(
        (-scalars.severity_rank(a["severity"])).alias("rank"), a["rule_id"].alias("rule_id"), a.alias("alert"))))
    return out.withColumns({"passed": F.size("alerts") == 0, "alert": worst["alert"]}).select(
        *columns, *([] if type_column in columns else [type_column]), "passed", "alert", "alerts")


EVALUATION = ("device_id", "timestamp", *schemas.MEASUREMENTS, "status", "fault_code", "run_id",
              "event_type", "start_ts", "end_ts", "passed", "alert", "context_anomaly")


def evaluation(evaluated: DataFrame) -> DataFrame:
    """The evaluation message: readings, run, flag, worst alert and context anomaly. (s)"""
    rows = evaluated.withColumnRenamed("machine_id", "device_id")
    kinds = {"run_id": "string", "event_type": "string", "start_ts": "bigint", "end_ts": "bigint"}
    for name, kind in kinds.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    if "context_anomaly" not in rows.columns:
        rows = rows.withColumn("context_anomaly", F.lit(None).cast(schemas.ANOMALY))
    return rows.select(*EVALUATION)


def alerts(evaluated: DataFrame) -> DataFrame:
    """One row per alert; every rule that fired is kept. (s)"""
    return evaluated.select(F.col("machine_id").alias("device_id"), F.explode("alerts").alias("_a")) \
        .select("device_id", "_a.*")


def _custom(expressions: Sequence[str], telemetry: DataFrame) -> dict[str, Column]:
    empty = telemetry.sparkSession.createDataFrame([], telemetry.schema)
    return {e: condition(e, empty) for e in expressions if usable(e, empty)}


def with_rates(telemetry: DataFrame, rows: Sequence[Row], measurements: Sequence[str] = schemas.MEASUREMENTS,
               cuts: Cuts | None = None, key: str = "machine_id") -> DataFrame:
    """Add the rate columns that the listed rules need and the readings lack, in one pass."""
    wanted = {r["measurement"] for r in rows if r["condition"] in ("rate_above", "rate_below")}
    missing = [m for m in measurements if m in wanted and f"{m}_rate" not in telemetry.columns]
    return rate_of_change(telemetry, missing, key=key, cuts=cuts) if missing else telemetry


def judge(telemetry: DataFrame, rules: DataFrame, *, measurements: Sequence[str] = schemas.MEASUREMENTS,
          keep: Sequence[str] = ("machine_id", "machine_type", "timestamp"), small: bool = False,
          match: Sequence[str] = (), key: str = "machine_id", cuts: Cuts | None = None) -> DataFrame:
    """One row per reading and rule of its type with ``breached``, for every kind of condition.

    Readings stay wide: they meet only the rules of their own type and those for all types, by an equi-join on the
    type and on the columns of ``match``. ``small`` says the rules were counted already and may be broadcast. Rates are
    along ``key``.
    """
    full = complete(rules)
    kinds, expressions = _kinds(full, None)
    if kinds & {"rate_above", "rate_below"}:
        telemetry = with_rates(telemetry, full.select("measurement", "condition").distinct().collect(), measurements, cuts, key)
    rated = [m for m in measurements if f"{m}_rate" in telemetry.columns]
    custom = _custom(expressions, telemetry)
    side = full.select(F.coalesce("device_type", F.lit(ALL_TYPES)).alias("_type"), "rule_id", "device_type", "rule_type", "measurement",
                       "condition", "threshold", "lo", "hi", "severity", "durationSec", "actions", "alertChannel",
                       F.col("params")["expr"].alias("_expr"), *match)
    kind = F.array_compact(F.array(F.lit(ALL_TYPES), F.when(F.col("machine_type") != ALL_TYPES, F.col("machine_type"))))
    verdicts = F.array(*[c.cast("boolean") for c in custom.values()]) if custom else F.lit(None).cast("array<boolean>")
    wide = telemetry.withColumn("_verdicts", verdicts).withColumn("_type", F.explode(kind))
    held = wide.join(F.broadcast(side) if small else guarded_broadcast(side), ["_type", *match])
    own = F.when(F.lit(False), F.lit(None).cast("boolean"))
    for i, text in enumerate(custom):
        own = own.when(F.col("_expr") == text, F.col("_verdicts")[i])
    name = F.col("measurement")
    rate = _lookup(rated, name, "_rate") if rated else F.lit(None).cast("double")
    value = _lookup(measurements, name)
    return held.select(
        *keep, "rule_id", "device_type", "rule_type", "measurement", "condition", "threshold", "lo", "hi", "severity",
        "durationSec", "actions", "alertChannel", value.alias("value"),
        breach(F.col("condition"), value, rate, F.col("threshold"), F.col("lo"), F.col("hi"), own).alias("breached"))


def in_force(telemetry: DataFrame, versions: DataFrame, *, sent: str = "sent", order: str = "offset",
             measurements: Sequence[str] = schemas.MEASUREMENTS, cuts: Cuts | None = None) -> DataFrame:
    """Alerts by the version of each rule that was in force when the reading was taken.

    ``versions`` are all rules ever sent, with the time (epoch ms) and order of sending; one that is switched off is in force,
    too, and fires nothing. A reading meets the rules that have ever been for its type, then the last version of each sent
    at or before it, by as-of per rule. Conditions on a reading's own values only; rates and texts need ``evaluate``.
    """
    held = complete(versions)
    rules = held.select("rule_id", F.coalesce("device_type", F.lit(ALL_TYPES)).alias("_type")).distinct()
    kind = F.array_compact(F.array(F.lit(ALL_TYPES), F.when(F.col("machine_type") != ALL_TYPES, F.col("machine_type"))))
    names = ["machine_id", "machine_type", "timestamp", *(["seq"] if "seq" in telemetry.columns else []), *measurements]
    wide = telemetry.select(*names, F.explode(kind).alias("_type")).join(guarded_broadcast(rules), "_type")
    carry = ["device_type", "rule_type", "measurement", "condition", "threshold", "lo", "hi", "severity", "enabled", "actions", "alertChannel"]
    found = asof(wide, held, ["rule_id"], left_time="timestamp", right_time=sent, right_tie=order, carry=carry, into="_rule", cuts=cuts)
    own = found.select(*names, "rule_id", "_type", "_rule.*").where(
        F.coalesce("enabled", F.lit(True)) & (F.coalesce("device_type", F.lit(ALL_TYPES)) == F.col("_type")))
    value = _lookup(measurements, F.col("measurement"))
    fires = breach(F.col("condition"), value, F.lit(None).cast("double"), F.col("threshold"), F.col("lo"), F.col("hi"), F.lit(None).cast("boolean"))
    r = F.struct("rule_id", "rule_type", "measurement", "condition", "threshold", "severity", "actions", "alertChannel")
    return own.where(fires).select(
        F.col("machine_id").alias("device_id"), alert_struct(F.col("machine_id"), F.col("timestamp"), r, value).alias("_a"),
    ).select("device_id", "_a.*")


def rate_of_change(df: DataFrame, columns: str | Sequence[str], *, key: str = "machine_id",
                   cuts: Cuts | None = None) -> DataFrame:
    """Add ``<column>_rate`` per second against the last reading that has a value.

    Null on the first reading, without a value, or if no time has passed.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    order = ["timestamp", *(["seq"] if "seq" in df.columns else [])]
    line = Timeline.of(df, [key], order, cuts=cuts)
    seen = scan(df, line, {
        f"_p_{n}": last_value(F.when(F.col(n).isNotNull(), F.struct(F.col("timestamp").alias("t"),
                                                                     F.col(n).alias("x"))),
                              inclusive=False)
        for n in names})
    rates = {
        f"{n}_rate": F.try_divide(F.col(n) - F.col(f"_p_{n}.x"),
                                  (F.col("timestamp") - F.col(f"_p_{n}.t")) / 1000.0)
        for n in names}
    return seen.withColumns(rates).drop(*[f"_p_{n}" for n in names])


def sustained(breaches: DataFrame, duration_ms: Column | int, *,
              keys: Sequence[str] = ("machine_id", "rule_id"), breached: str = "breached",
              cuts: Cuts | None = None) -> DataFrame:
    """Add ``breach_start`` and ``sustained``: the breach has lasted ``duration_ms`` without a gap.

    A reading that does not breach ends the stretch, so does one without a value.
    """
    df = breaches.withColumn(breached, F.coalesce(breached, F.lit(False)))
    order = ["timestamp", *(["seq"] if "seq" in df.columns else [])]
    line = Timeline.of(df, keys, order, cuts=cuts)
    seen = scan(df, line, {"_prev": last_value(F.col(breached), inclusive=False)})
    seen = seen.withColumn("_start", F.when(
        F.col(breached) & ~F.coalesce("_prev", F.lit(False)), F.col("timestamp")))
    held = scan(seen, line, {"_since": last_value(F.col("_start"))})
    need = F.lit(duration_ms) if isinstance(duration_ms, int) else duration_ms
    since = F.when(F.col(breached), F.col("_since"))
    return held.withColumns({
        "breach_start": since,
        "sustained": F.coalesce(F.col("timestamp") - since >= need, F.lit(False)),
    }).select(*breaches.columns, "breach_start", "sustained")


def sustained_rules(telemetry: DataFrame, rules: DataFrame, *, cuts: Cuts | None = None) -> DataFrame:
    """Alerts of the rules that have a duration and no window."""
    lasting, listed = localize(
        complete(rules).where((F.col("durationSec") > 0) & ~scalars.is_windowed(F.col("window"))))
    keep = ["machine_id", "machine_type", "timestamp", *(["seq"] if "seq" in telemetry.columns else [])]
    rows = judge(telemetry, lasting, keep=keep, small=listed is not None, cuts=cuts)
    fired = sustained(rows, scalars.seconds_to_millis(F.col("durationSec")), cuts=cuts)
    r = F.struct("rule_id", "rule_type", "measurement", "condition", "threshold", "severity", "actions",
                 "alertChannel")
    return fired.where("sustained").select(
        F.col("machine_id").alias("device_id"),
        alert_struct(F.col("machine_id"), F.col("timestamp"), r, F.col("value")).alias("_a"),
    ).select("device_id", "_a.*")


def windowed_rule(df: DataFrame, size: str, slide: str | None = None, *, aggregate: str = "avg",
                  measurements: Sequence[str] = schemas.MEASUREMENTS) -> DataFrame:
    """Aggregate the readings per machine and window, before a threshold check. (s)

    The result has the window's end as ``timestamp``, so ``judge`` and ``evaluate`` read it as is.
    """
    fn = AGGREGATES[aggregate]
    window = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    rows = df if "event_time" in df.columns else df.withColumn("event_time", F.timestamp_millis("timestamp"))
    agg = rows.groupBy("machine_id", "machine_type", window.alias("window")).agg(
        *[fn(m).cast("double").alias(m) for m in measurements])
    return agg.select("machine_id", "machine_type", F.col("window.start").alias("window_start"),
                      F.unix_millis(F.col("window.end")).alias("timestamp"), *measurements)


def _aggregated(measurement: str, name: str) -> Column:
    """An aggregate of a folded window."""
    n, total = F.col(f"{measurement}_n"), F.col(f"{measurement}_sum")
    if name == "avg":
        return F.try_divide(total, n)
    if name == "count":
        return n.cast("double")
    if name == "stddev":
        return F.when(n > 1, F.sqrt(F.greatest(F.col(f"{measurement}_m2"), F.lit(0.0)) / (n - 1)))
    return F.col(f"{measurement}_{name}").cast("double")


_SPEC = ("_size", "_slide", "_agg")


def windows_of(telemetry: DataFrame, specs: Sequence[tuple[int, int, str]], *,
               measurements: Sequence[str] = schemas.MEASUREMENTS) -> DataFrame:
    """Readings per machine and window for all (size, slide, aggregate) at once: one scan, whatever their number.

    A row per window and aggregate, with the window's end as ``timestamp``, so ``judge`` reads it like a reading.
    """
    found = folded(telemetry, sorted({s[:2] for s in specs}), measurements, keys=["machine_id", "machine_type"],
                   spread=any(a == "stddev" for _, _, a in specs))
    wanted = F.filter(F.array(*[F.struct(F.lit(size).cast("bigint").alias("_size"), F.lit(slide).cast("bigint").alias("_slide"), F.lit(agg).alias("_agg"))
                                for size, slide, agg in sorted(specs)]),
                      lambda s: (s["_size"] == F.col("size")) & (s["_slide"] == F.col("slide")))
    names = sorted({a for _, _, a in specs})
    rows = found.select("*", F.explode(wanted).alias("_s")).select("*", "_s.*")
    values = []
    for m in measurements:
        value = F.when(F.lit(False), F.lit(None).cast("double"))
        for name in names:
            value = value.when(F.col("_agg") == name, _aggregated(m, name))
        values.append(value.alias(m))
    return rows.select("machine_id", "machine_type", (F.col("start") + F.col("size")).alias("timestamp"), *_SPEC, *values,
                       F.concat_ws("|", "machine_id", "_size", "_slide", "_agg").alias("_line"))


def windowed_rules(telemetry: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts of the windowed rules, from one scan whatever the number of rules and windows.

    A rule with a duration too fires once its windows have breached for that long without a gap. Rules with an unknown
    aggregate are not judged (``rejected_rules``).
    """
    windowed, listed = localize(complete(rules).where(scalars.is_windowed(F.col("window"))).withColumns({
        "_size": scalars.seconds_to_millis(F.col("window.sizeSeconds")),
        "_agg": F.coalesce(F.col("params")["aggregate"], F.lit("avg")),
    }).withColumn("_slide", F.coalesce(F.when(F.col("window.type") == "sliding", scalars.seconds_to_millis(F.col("window.slideSeconds"))),
                                       F.col("_size"))).where(F.col("_agg").isin(*AGGREGATES)))
    # distinct windows of the rule set: configuration, bounded like custom expressions
    rows = listed if listed is not None else windowed.select(*_SPEC).distinct().limit(MAX_CUSTOM + 1).collect()
    specs = {(s["_size"], s["_slide"], s["_agg"]) for s in rows}
    if len(specs) > MAX_CUSTOM:
        raise ValueError(f"more than {MAX_CUSTOM} distinct rule windows")
    if not specs:
        none = judge(telemetry, windowed).where(F.lit(False))
        return _window_alerts(none)
    stats, small = windows_of(telemetry, list(specs)), listed is not None
    lasts = F.col("durationSec") > 0
    parts = []
    if not small or any((r["durationSec"] or 0) <= 0 for r in listed):
        parts.append(judge(stats, windowed.where(F.coalesce(~lasts, F.lit(True))), small=small, match=_SPEC, key="_line").where("breached"))
    if not small or any((r["durationSec"] or 0) > 0 for r in listed):
        judged = judge(stats, windowed.where(lasts), small=small, match=_SPEC, key="_line")
        lasting = sustained(judged, scalars.seconds_to_millis(F.col("durationSec")))
        parts.append(lasting.where("sustained").select(*judged.columns))
    return _window_alerts(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))


def _window_alerts(fired: DataFrame) -> DataFrame:
    r = F.struct("rule_id", "rule_type", "measurement", "condition", "threshold", "severity", "actions",
                 "alertChannel")
    return fired.select(
        F.col("machine_id").alias("device_id"),
        alert_struct(F.col("machine_id"), F.col("timestamp"), r, F.col("value")).alias("_a"),
    ).select("device_id", "_a.*")


def alert_counts(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.groupBy("rule_id", "severity").agg(F.count(F.lit(1)).alias("n"))
