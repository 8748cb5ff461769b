"""Device manifests: validation, versions, normalisation and the schema they ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import scalars
from millwatch.functions.frames import guarded_broadcast, once
from millwatch.operators.ordered import Cuts, Timeline, measure, previous, running_max, scan

LOAD, UPDATE, REJECT, ROLLBACK = "LOAD", "UPDATE", "REJECT", "ROLLBACK"
ACCEPTED, REJECTED = "ACCEPTED", "REJECTED"
REQUIRED = ("version", "deviceType", "storageGroup", "measurements")


def validate_manifests(df: DataFrame) -> DataFrame:
    """Parse manifest JSON in ``value`` and add ``manifest``, ``errors`` and ``valid``. (s)

    An error is ``<JSON path>: <message>``.
    """
    text = F.col("value").cast("string")
    schema = schemas.T.StructType([*schemas.MANIFEST.fields, schemas.T.StructField("_corrupt", schemas.S)])
    m = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = once(df, "manifest", m)
    return parsed.withColumn("errors", manifest_errors(F.col("manifest"), text)).withColumns({
        "manifest": F.col("manifest").dropFields("_corrupt"),
        "valid": F.size("errors") == 0,
    })


def manifest_errors(m: Column, text: Column) -> Column:
    """All errors of one manifest, as an array in a fixed order."""
    unreadable = text.isNull() | (F.trim(text) == "") | (m["_corrupt"].isNotNull() & F.try_parse_json(text).isNull())
    found = [F.when(m[f].isNull(), f"$.{f}: required") for f in REQUIRED]
    found += [
        F.when(m["_corrupt"].isNotNull(), "$: a field has the wrong type"),
        F.when(m["version"].isNotNull() & ~scalars.is_semver(m["version"]), "$.version: not semver"),
        F.when(m["measurements"].isNotNull() & (F.size(m["measurements"]) == 0), "$.measurements: empty"),
        F.when(~m["defaults"]["timestampUnit"].isin(*schemas.TIMESTAMP_UNITS), "$.defaults.timestampUnit: unknown"),
        F.when(~m["edgeTrimming"]["action"].isin(*schemas.TRIM_ACTIONS), "$.edgeTrimming.action: unknown"),
        F.when((m["edgeTrimming"]["leadSeconds"] < 0) | (m["edgeTrimming"]["trailSeconds"] < 0),
               "$.edgeTrimming: negative"),
    ]
    simple = F.filter(F.array(*found), lambda e: e.isNotNull())
    listed = F.concat(
        simple,
        _each(m["measurements"], "measurements", _measurement_error),
        _each(m["kpivRules"], "kpivRules", _rule_error),
        _repeated(m["measurements"], "measurements", "name"),
        _repeated(m["kpivRules"], "kpivRules", "id"),
        _repeated(m["knownDeviceIds"], "knownDeviceIds", None),
    )
    return F.when(unreadable, F.array(F.lit("$: invalid JSON"))).otherwise(listed)


def _each(items: Column, name: str, check) -> Column:
    # a row without an error has a null check, which makes the whole text null
    at = F.transform(F.coalesce(items, F.array()), lambda x, i: F.concat(
        F.lit(f"$.{name}["), i.cast("string"), F.lit("]"), check(x)))
    return F.filter(at, lambda e: e.isNotNull())


def _measurement_error(x: Column) -> Column:
    return (
        F.when(x["name"].isNull(), ".name: required").when(x["dataType"].isNull(), ".dataType: required")
        .when(~x["dataType"].isin(*schemas.DATA_TYPES), ".dataType: unknown")
    )


def _rule_error(x: Column) -> Column:
    ranged = x["condition"].isin("between", "outside")
    pair, number = scalars.threshold_range(x["threshold"]), scalars.threshold_number(x["threshold"])
    return (
        F.when(x["id"].isNull(), ".id: required").when(x["measurement"].isNull(), ".measurement: required")
        .when(x["condition"].isNull(), ".condition: required")
        .when(~x["condition"].isin(*schemas.CONDITIONS), ".condition: unknown")
        .when(ranged & pair.isNull(), ".threshold: not a pair of numbers")
        .when(~ranged & (x["condition"] != "custom") & number.isNull(), ".threshold: not a number")
        .when(~x["severity"].isin(*schemas.SEVERITIES), ".severity: unknown")
        .when(~x["window"]["type"].isin(*schemas.WINDOW_TYPES), ".window.type: unknown")
    )


def _repeated(items: Column, name: str, field: str | None) -> Column:
    values = F.coalesce(items, F.array()) if field is None else F.transform(
        F.coalesce(items, F.array()), lambda x: x[field])
    values = F.filter(values.cast("array<string>"), lambda v: v.isNotNull())
    return F.transform(scalars.duplicates(values),
                       lambda v: F.concat(F.lit(f"$.{name}: duplicate "), v))


#: Manifests that are not valid have no line of versions; their rows are dealt out over so many keys.
_SPREAD = 1024
#: Manifests of one device type that one task scans: their rows are long, and types are few.
TASK_ROWS = 100_000


def manifest_history(validated: DataFrame, order: str = "offset", *, before: DataFrame | None = None,
                     cuts: Cuts | None = None) -> DataFrame:
    """The audit trail: every manifest with ``event`` and ``status`` in arrival order.

    A valid manifest is accepted if its version is not below any earlier valid one of its device
    type; a lower one never raises that maximum, so rejected ones need not be left out. ``before`` is
    the ``highest_versions`` of a trail that these manifests follow.
    """
    kind = F.col("manifest.deviceType")
    rows = validated.withColumns({
        "device_type": kind,
        "_semver": F.when(F.col("valid"), scalars.semver(F.col("manifest.version"))),
    })
    # rows that are not valid need no order; in one line they would be a hot key
    apart = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(order), F.lit(_SPREAD)).cast("string"))
    rows = rows.withColumn("_kind", F.when(F.col("valid"), kind).otherwise(apart))
    cuts = cuts or measure((rows, ["_kind"], order), max_rows=TASK_ROWS)
    line = Timeline.of(rows, ["_kind"], [order], cuts=cuts)
    seen = scan(rows, line, {"_highest": running_max(F.col("_semver"), inclusive=False)})
    if before is not None:
        known = guarded_broadcast(before.withColumnsRenamed({"device_type": "_type", "highest": "_known"}))
        seen = seen.join(known, F.col("device_type") == F.col("_type"), "left").withColumn(
            "_highest", F.greatest("_highest", "_known")).drop("_type", "_known")
    event = (
        F.when(~F.col("valid"), REJECT).when(F.col("_highest").isNull(), LOAD)
        .when(F.col("_semver") >= F.col("_highest"), UPDATE).otherwise(REJECT)
    )
    reason = F.when(~F.col("valid"), scalars.join_errors(F.col("errors"))) \
        .when(event == REJECT, "version downgrade")
    return seen.withColumns({
        "version": F.col("manifest.version"),
        "event": event,
        "status": F.when(event == REJECT, REJECTED).otherwise(ACCEPTED),
        "reason": reason,
    }).drop("_semver", "_highest", "_kind")


def highest_versions(history: DataFrame) -> DataFrame:
    """The highest accepted version of each device type, which later manifests must not fall below."""
    return history.where((F.col("status") == ACCEPTED) & (F.col("event") != ROLLBACK)).groupBy("device_type").agg(
        F.max(scalars.semver(F.col("version"))).alias("highest"))


def rollback(history: DataFrame, device_type: str, version: str, at: int, order: str = "offset") -> DataFrame:
    """A row for the trail that puts an accepted version in force again from ``at`` on; no rows if there is no such version."""
    same = (F.col("status") == ACCEPTED) & (F.col("device_type") == device_type) & (F.col("version") == version)
    row = history.where(same).orderBy(F.desc(order)).limit(1)
    return row.withColumns({order: F.lit(at).cast("bigint"), "event": F.lit(ROLLBACK), "reason": F.lit(None).cast("string")})


def manifest_intervals(history: DataFrame, order: str = "offset", *, cuts: Cuts | None = None) -> DataFrame:
    """Every accepted manifest with the time it came into force and the time the next one did (null: it still is)."""
    rows = history.where(F.col("status") == ACCEPTED)
    line = Timeline.of(rows, ["device_type"], [order], cuts=cuts)
    seen = scan(rows, line.reversed(), {"_next": previous([order])})
    return seen.select("device_type", "version", "manifest", F.col(order).alias("valid_from"), F.col(f"_next.{order}").alias("valid_to"))


def current_manifests(history: DataFrame, order: str = "offset") -> DataFrame:
    """The manifest in force per device type: the last accepted one."""
    return (
        history.where(F.col("status") == ACCEPTED).groupBy("device_type")
        .agg(F.max_by(F.struct("version", "manifest"), order).alias("_m"))
        .select("device_type", "_m.version", "_m.manifest")
    )


def manifest_versions(history: DataFrame, order: str = "offset") -> DataFrame:
    """All accepted versions per device type, for rollback: one row each, with its last arrival."""
    return (
        history.where(F.col("status") == ACCEPTED).groupBy("device_type", "version")
        .agg(F.max(order).alias("last_offset"), F.count(F.lit(1)).alias("loads"))
    )


def attach_manifest(df: DataFrame, current: DataFrame, type_column: str = "machine_type") -> DataFrame:
    """Every row with its type's current manifest in ``_manifest``; null if there is none."""
    side = current.select(F.col("device_type").alias(type_column), F.col("manifest").alias("_manifest"))
    return df.join(guarded_broadcast(side, 10_000), type_column, "left").select(*df.columns, "_manifest")


def manifest_measurements(current: DataFrame) -> DataFrame:
    """One row per device type and measurement name; the first of a repeated name counts."""
    m = F.col("manifest.measurements")
    return (
        current.select("device_type", "manifest.storageGroup", "manifest.devicePathPattern",
                       "manifest.templateName", F.posexplode(m).alias("_i", "_m"))
        .groupBy("device_type", F.col("_m.name").alias("measurement"))
        .agg(F.min_by(F.struct("storageGroup", "devicePathPattern", "templateName", "_m.dataType",
                               "_m.encoding", "_m.compression", "_m.unit"), "_i").alias("_f"))
        .select("device_type", "measurement", "_f.*")
    )


def manifest_rules(current: DataFrame) -> DataFrame:
    """The manifests' own rules in the shape of the rules topic."""
    r = F.col("_r")
    pair = scalars.threshold_range(r["threshold"])
    return current.select("device_type", "version", F.explode("manifest.kpivRules").alias("_r")).select(
        r["id"].alias("rule_id"), "version", "device_type", F.lit(None).cast("string").alias("rule_type"),
        r["measurement"].alias("measurement"), r["condition"].alias("condition"),
        scalars.threshold_number(r["threshold"]).alias("threshold"), r["severity"].alias("severity"),
        F.lit(True).alias("enabled"), pair["lo"].alias("lo"), pair["hi"].alias("hi"),
        r["window"].alias("window"), r["durationSec"].alias("durationSec"), r["actions"].alias("actions"),
        r["alertChannel"].alias("alertChannel"), r["params"].alias("params"),
    )


def normalize(readings: DataFrame, current: DataFrame, units: DataFrame) -> DataFrame:
    """Readings with manifest types, canonical units and epoch ms.

    ``readings`` has device_id, device_type, ts, measurement and the raw text ``raw``; ``units``
    has unit, canonical, scale and offset. A text that is not of the declared type gives
    ``error_type``; other rows have it null.
    """
    clocks = current.select("device_type", F.coalesce("manifest.defaults.timestampUnit", F.lit("ms")).alias("ts_unit"))
    declared = manifest_measurements(current)
    rows = (
        readings.join(guarded_broadcast(clocks), "device_type", "left")
        .join(guarded_broadcast(declared), ["device_type", "measurement"], "left")
        .join(guarded_broadcast(units.withColumnRenamed("offset", "shift")), "unit", "left")
    )
    raw, kind = F.col("raw"), F.col("dataType")
    number = (
        F.when(kind == "INT32", raw.try_cast("int").cast("double"))
        .when(kind == "INT64", raw.try_cast("bigint").cast("double"))
        .when(kind == "FLOAT", raw.try_cast("float").cast("double"))
        .when(kind == "DOUBLE", raw.try_cast("double"))
    )
    flag = F.when(kind == "BOOLEAN", raw.try_cast("boolean"))
    text = F.when(kind == "TEXT", raw)
    scaled = F.col("_number") * F.coalesce("scale", F.lit(1.0)) + F.coalesce("shift", F.lit(0.0))
    failed = raw.isNotNull() & kind.isNotNull() & F.coalesce(
        F.col("_number").cast("string"), flag.cast("string"), text).isNull()
    return rows.withColumn("_number", number).select(
        "device_id", "device_type",
        scalars.to_millis(F.col("ts"), F.coalesce("ts_unit", F.lit("ms"))).alias("timestamp"),
        "measurement",
        scaled.alias("value"), flag.alias("flag"), text.alias("text"),
        F.coalesce("canonical", "unit").alias("unit"),
        F.when(failed, schemas.TYPE_CONVERSION_ERROR)
        .when(kind.isNull(), schemas.SCHEMA_VALIDATION_ERROR).alias("error_type"),
    )


def schema_requests(current: DataFrame, devices: DataFrame) -> DataFrame:
    """The schema the manifests ask for, as request rows. ``devices``: device_id, device_type.

    Nothing is run against a store; ``new_series`` tells which requests are still open.
    """
    fields = manifest_measurements(current)
    none = F.lit(None).cast("string")

    def request(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
        names = ("storage_group", "template", "device_path", "measurement", "data_type", "encoding", "compression")
        return df.select(F.lit(kind).alias("kind"), *[columns.get(n, none).alias(n) for n in names])

    group, template = F.col("storageGroup"), F.col("templateName")
    path = F.coalesce(scalars.path_from_pattern(F.col("devicePathPattern"), F.col("device_id")),
                      scalars.device_path(group, F.col("device_id")))
    typed = current.select("device_type", "manifest.storageGroup", "manifest.devicePathPattern",
                           "manifest.templateName")
    named = devices.join(guarded_broadcast(typed), "device_type")
    series = devices.join(guarded_broadcast(fields), "device_type")
    create_group, create_template, create_series, apply_template = schemas.REQUEST_KINDS
    detail = dict(measurement=F.col("measurement"), data_type=F.col("dataType"),
                  encoding=F.col("encoding"), compression=F.col("compression"))
    return (
        request(typed.select("storageGroup").distinct(), create_group, storage_group=group)
        .unionByName(request(fields.where(template.isNotNull()), create_template, template=template,
                             **detail).distinct())
        .unionByName(request(named.where(template.isNotNull()), apply_template, storage_group=group,
                             template=template, device_path=path))
        .unionByName(request(series, create_series, storage_group=group, device_path=path, **detail))
    )


def new_series(series: DataFrame, known: DataFrame) -> DataFrame:
    """Series (device, measurement) seen in the data and not yet registered."""
    keys = ["device_id", "measurement"]
    return series.select(*keys).distinct().join(known.select(*keys).distinct(), keys, "left_anti")


def unknown_devices(devices: DataFrame, current: DataFrame) -> DataFrame:
    """Devices (device_id, device_type) a manifest with known devices does not list."""
    keys = ["device_type", "device_id"]
    listing = current.where(F.size("manifest.knownDeviceIds") > 0)
    known = listing.select("device_type", F.explode("manifest.knownDeviceIds").alias("device_id")).distinct()
    restricted = guarded_broadcast(listing.select("device_type").distinct())
    return (
        devices.select(*keys).distinct().join(restricted, "device_type", "left_semi")
        .join(known, keys, "left_anti")
    )
