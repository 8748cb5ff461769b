"""The bronze table: versions, bounds, replays, replacement and compaction."""

import pytest

from millwatch.operators.series import bronze_rows
from millwatch.sources.bronze import VERSIONS, Bronze, open_table
from tests import data

DAY = 86_400_000


@pytest.fixture
def table(spark, tmp_path):
    return Bronze(spark, f"{tmp_path}/bronze", rows(spark, []).schema)


def rows(spark, readings):
    return bronze_rows(data.readings(spark, readings))


def values(df):
    return sorted((r["machine_id"], r["timestamp"], r["gas_temperature"]) for r in df.collect())


def test_a_replayed_batch_is_written_once(spark, table):
    assert table.read().count() == 0 and table.versions() == []
    assert table.append(rows(spark, [("a", 1, 1.0)]), 0)
    assert not table.append(rows(spark, [("a", 1, 1.0)]), 0)
    assert table.append(rows(spark, [("b", 2, 2.0)]), 1) and not table.append(rows(spark, [("a", 1, 1.0)]), 0)
    assert values(table.read()) == [("a", 1, 1.0), ("b", 2, 2.0)]
    assert table.append(rows(spark, []), 2) and table.read().count() == 2
    assert values(open_table(spark, table.path).read()) == values(table.read())


def test_files_are_chosen_by_their_bounds(spark, table):
    for i in range(5):
        table.append(rows(spark, [(m, i * DAY + k, float(k)) for m in ("a", "m", "z") for k in range(20)]).coalesce(1), i)
    assert len(table.read().inputFiles()) >= 5
    got = table.read(since=2 * DAY + 5, until=2 * DAY + 7)
    assert len(got.inputFiles()) <= table.zones().where(f"first_ts >= {2 * DAY} and last_ts < {3 * DAY}").count()
    assert values(got) == [(m, 2 * DAY + k, float(k)) for m in ("a", "m", "z") for k in (5, 6, 7)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan
    assert table.read(machines=["b"]).count() == 0 and table.read(machines=["m"]).count() == 100
    assert "In(machine_id" in table.read(machines=["m"])._jdf.queryExecution().executedPlan().toString() or "EqualTo(machine_id" in table.read(machines=["m"])._jdf.queryExecution().executedPlan().toString()
    assert table.read(since=9 * DAY).count() == 0


def test_the_last_one_wins_and_only_its_file_is_rewritten(spark, table):
    first = [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)]
    table.append(rows(spark, first[:2]).coalesce(1), 0)
    table.append(rows(spark, first[2:]).coalesce(1), 1)
    untouched = {r["file"] for r in table.zones().where("first_machine = 'b'").collect()}
    late = rows(spark, [("x", 0, 0.0)] * 5 + [("a", 2, 9.0), ("a", 3, 4.0)]).where("machine_id = 'a'")
    assert table.replace_last(late, 2)
    assert values(table.read()) == [("a", 1, 1.0), ("a", 2, 9.0), ("a", 3, 4.0), ("b", 1, 3.0)]
    assert untouched <= {r["file"] for r in table.zones().collect()}
    # one that was sent before, but arrives after
    assert table.replace_last(rows(spark, [("a", 2, 5.0)]), 3)
    assert ("a", 2, 9.0) in values(table.read()) and table.read().count() == 4
    # several of one time within a batch
    assert table.replace_last(rows(spark, [("c", 1, 1.0), ("c", 1, 2.0)]), 4)
    assert ("c", 1, 2.0) in values(table.read()) and table.read().count() == 5


def test_compaction_keeps_rows_and_earlier_readers(spark, table):
    for i in range(2 * VERSIONS):
        table.append(rows(spark, [("a", i, float(i))]), i)
    before, reader = values(table.read()), table.read()
    files = table.zones().count()
    assert table.compact() == files > table.zones().count()
    assert values(table.read()) == before and values(reader) == before
    assert len(table.versions()) == VERSIONS
    assert not table.append(rows(spark, [("a", 0, 0.0)]), 5)  # still known
    for i in range(VERSIONS):
        table.append(rows(spark, [("a", 100 + i, 0.0)]), 100 + i)
    assert table.vacuum() >= files and values(table.read())[: len(before)] == before
    assert table.compact(file_bytes=2) == 0


def test_two_writers_do_not_lose_rows(spark, table):
    table.append(rows(spark, [("a", 1, 1.0)]))
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(table.zones(), 0)
