import json

import pytest

from millwatch.operators import manifests, rules, trimming, context
from tests import data

BASE = {
    "version": "1.0.0", "deviceType": "pump", "storageGroup": "root.sg.x", "devicePathPattern": "root.sg.x.${deviceId}",
    "templateName": "tpl", "measurements": [{"name": "gas_temperature", "dataType": "DOUBLE", "unit": "degF"},
                                            {"name": "n", "dataType": "INT32"}],
    "kpivRules": [{"id": "k", "measurement": "gas_temperature", "condition": "between", "threshold": [1, 2], "severity": "info"}],
    "knownDeviceIds": ["d1"], "meta": {"a": [1]},
}


def table(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return spark.createDataFrame(list(enumerate(texts)), "offset bigint, value string")


def errors(spark, **change):
    body = {**BASE, **change}
    return manifests.validate_manifests(table(spark, {k: v for k, v in body.items() if v is not ...})).first()["errors"]


def test_valid(spark):
    row = manifests.validate_manifests(table(spark, BASE)).first()
    assert row["valid"] and row["manifest"]["kpivRules"][0]["threshold"] == "[1,2]"


@pytest.mark.parametrize("change, want", [
    (dict(version="1.0"), ["$.version: not semver"]),
    (dict(deviceType=...), ["$.deviceType: required"]),
    (dict(measurements=[]), ["$.measurements: empty"]),
    (dict(measurements=BASE["measurements"] + BASE["measurements"][:1]), ["$.measurements: duplicate gas_temperature"]),
    (dict(measurements=[{"name": "x", "dataType": "REAL"}]), ["$.measurements[0].dataType: unknown"]),
    (dict(knownDeviceIds=["a", "b", "a"]), ["$.knownDeviceIds: duplicate a"]),
    (dict(kpivRules=BASE["kpivRules"] * 2), ["$.kpivRules: duplicate k"]),
    (dict(kpivRules=[{"id": "k", "measurement": "x", "condition": "between", "threshold": 3}]),
     ["$.kpivRules[0].threshold: not a pair of numbers"]),
    (dict(kpivRules=[{"id": "k", "measurement": "x", "condition": "less_than", "threshold": [1, 2]}]),
     ["$.kpivRules[0].threshold: not a number"]),
    (dict(edgeTrimming={"action": "melt"}), ["$.edgeTrimming.action: unknown"]),
    (dict(defaults={"timestampUnit": "h"}), ["$.defaults.timestampUnit: unknown"]),
])
def test_one_error(spark, change, want):
    assert errors(spark, **change) == want


def test_unreadable_and_wrong_type(spark):
    rows = manifests.validate_manifests(table(spark, '{"version":', json.dumps({**BASE, "measurements": "x"}))).orderBy("offset").collect()
    assert rows[0]["errors"] == ["$: invalid JSON"]
    assert "$: a field has the wrong type" in rows[1]["errors"]


def history(spark, *versions):
    bodies = [v if isinstance(v, dict) else {**BASE, "version": v} for v in versions]
    return manifests.manifest_history(manifests.validate_manifests(table(spark, *bodies)))


def test_versions_compare_by_number(spark):
    rows = history(spark, "1.2.0", "1.10.0", "1.9.0", "1.10.0").orderBy("offset").collect()
    assert [r["event"] for r in rows] == ["LOAD", "UPDATE", "REJECT", "UPDATE"]
    assert rows[2]["reason"] == "version downgrade"


def test_invalid_ones_do_not_count(spark):
    bad = {**BASE, "version": "9.0.0", "measurements": []}
    h = history(spark, "1.0.0", bad, "1.1.0")
    assert [r["status"] for r in h.orderBy("offset").collect()] == ["ACCEPTED", "REJECTED", "ACCEPTED"]
    assert manifests.current_manifests(h).first()["version"] == "1.1.0"
    assert sorted(r["version"] for r in manifests.manifest_versions(h).collect()) == ["1.0.0", "1.1.0"]


def test_rules_from_manifests(spark):
    brought = manifests.manifest_rules(manifests.current_manifests(history(spark, "1.0.0")))
    t = data.readings(spark, [("a", 0, 1.5), ("a", 1, 3.0)])
    assert [r["alert_time"] for r in rules.alerts(rules.evaluate(t, brought)).collect()] == [0]


def test_trimming_from_manifests(spark):
    current = manifests.current_manifests(history(spark, {**BASE, "edgeTrimming": {"leadSeconds": 0.002, "action": "tag"}}))
    t = data.readings(spark, [("a", 1), ("a", 3)])
    runs = context.runs(data.context(spark, [("a", "r", "trackin", 0)]))
    got = {r["timestamp"]: r["disposition"] for r in trimming.edge_trim_by_manifest(t, runs, current).collect()}
    assert got == {1: "TRIMMED_LEAD", 3: "KEEP"}


def test_normalize(spark):
    current = manifests.current_manifests(history(spark, {**BASE, "defaults": {"timestampUnit": "s"}}))
    rows = spark.createDataFrame(
        [("d", "pump", 7, "gas_temperature", "50"), ("d", "pump", 7, "n", "3"), ("d", "pump", 7, "n", "3.5x"),
         ("d", "pump", 7, "other", "1"), ("d", "pump", 7, "n", None)],
        "device_id string, device_type string, ts bigint, measurement string, raw string")
    units = spark.createDataFrame([("degF", "degC", 0.5, -16.0)], "unit string, canonical string, scale double, offset double")
    got = sorted((r["measurement"], r["value"], r["unit"], r["error_type"], r["timestamp"])
                 for r in manifests.normalize(rows, current, units).fillna(-1.0, "value").fillna("-", "unit").fillna("-", "error_type").collect())
    assert got == [("gas_temperature", 9.0, "degC", "-", 7000), ("n", -1.0, "-", "-", 7000),
                   ("n", -1.0, "-", "TYPE_CONVERSION_ERROR", 7000), ("n", 3.0, "-", "-", 7000),
                   ("other", -1.0, "-", "SCHEMA_VALIDATION_ERROR", 7000)]


def test_requests_and_new_series(spark):
    current = manifests.current_manifests(history(spark, "1.0.0"))
    devices = spark.createDataFrame([("d1", "pump"), ("d2", "pump"), ("d3", "fan")], "device_id string, device_type string")
    kinds = {r["kind"]: r["count"] for r in manifests.schema_requests(current, devices).groupBy("kind").count().collect()}
    assert kinds == {"CREATE_STORAGE_GROUP": 1, "CREATE_TEMPLATE": 2, "APPLY_TEMPLATE": 2, "CREATE_TIMESERIES": 4}
    assert [r["device_id"] for r in manifests.unknown_devices(devices, current).collect()] == ["d2"]
    seen = spark.createDataFrame([("d1", "a"), ("d1", "a"), ("d1", "b")], "device_id string, measurement string")
    known = spark.createDataFrame([("d1", "a")], "device_id string, measurement string")
    assert [r["measurement"] for r in manifests.new_series(seen, known).collect()] == ["b"]


def test_a_trail_goes_on_from_what_it_holds(spark):
    """Two batches judged one after the other give the trail of both together; a rollback puts an old version in force."""
    def sent(rows):
        body = [(json.dumps({k: x for k, x in (BASE | {"version": v, "deviceType": t}).items() if x}), i) for i, (t, v) in rows]
        return manifests.validate_manifests(spark.createDataFrame(body, "value string, offset long"))

    rows = list(enumerate([("pump", "1.2.0"), ("pump", "1.10.0"), (None, "1.0.0"), ("pump", "1.9.0"), ("fan", "0.1.0"), ("pump", "2.0.0"), ("fan", "0.0.9")]))
    names = ["offset", "device_type", "version", "event", "status", "reason"]
    whole = manifests.manifest_history(sent(rows))
    first = manifests.manifest_history(sent(rows[:3]))
    second = manifests.manifest_history(sent(rows[3:]), before=manifests.highest_versions(first))
    both = first.unionByName(second)
    assert sorted(map(repr, both.select(*names).collect())) == sorted(map(repr, whole.select(*names).collect()))
    assert {r["device_type"]: r["version"] for r in manifests.current_manifests(both).collect()} == {"pump": "2.0.0", "fan": "0.1.0"}
    back = both.unionByName(manifests.rollback(both, "pump", "1.10.0", 50))
    assert {r["device_type"]: r["version"] for r in manifests.current_manifests(back).collect()} == {"pump": "1.10.0", "fan": "0.1.0"}
    assert manifests.rollback(both, "pump", "9.9.9", 50).count() == 0
    # what comes after a rollback is still measured by the highest version
    assert manifests.manifest_history(sent([(60, ("pump", "1.11.0"))]), before=manifests.highest_versions(back)).first()["event"] == "REJECT"
    spans = {(r["device_type"], r["version"], r["valid_from"]): r["valid_to"] for r in manifests.manifest_intervals(back).collect()}
    assert spans == {("pump", "1.2.0", 0): 1, ("pump", "1.10.0", 1): 5, ("pump", "2.0.0", 5): 50, ("pump", "1.10.0", 50): None, ("fan", "0.1.0", 4): None}


def test_a_batch_of_the_trail_is_parsed_once_and_its_types_are_cut(spark, sf, tmp_path, monkeypatch):
    from millwatch.plans import views
    from millwatch.streaming import sinks

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    sent = views.raw_manifests(spark, sf).where("offset is not null").select("value", "offset").localCheckpoint()

    def trail(name):
        rows = manifests.validate_manifests(sent.mapInPandas(counted, sent.schema))
        sinks.write_manifests(rows, 0, f"{tmp_path}/{name}")
        got = sinks.read_batches(spark, f"{tmp_path}/{name}").select("offset", "device_type", "version", "event", "reason")
        return sorted(map(str, got.collect()))

    whole = trail("whole")
    assert read.value == sent.count() == len(whole)
    monkeypatch.setattr(manifests, "TASK_ROWS", 5)
    assert trail("cut") == whole
