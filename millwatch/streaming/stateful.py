"""Stream operators that need to remember rows.

All of them hold rows back until the watermark has passed and then work in event-time order, so
out-of-order arrival within the watermark's delay gives what the table operators give. Rows later than
that are not lost: the watermark's own column ends before the state, so Spark drops nothing. They are
settled at the next step of the watermark; readings are marked ``late`` and get the context that is
still held (``keep_ms`` back), EWMA and the sequence guard take late rows in as they arrive.

The last rows wait for the watermark to pass them. ``ticks`` (a stream of ``timestamp``) moves it on when
nothing else does: a tick by the clock in a silent plant, or one at the end of a finite input. Ticks are
not rows and give no output.

Machines are hashed into ``buckets``; a bucket's rows are held together as Arrow tables, so the cost per
micro-batch goes with its rows and not with the number of machines, and settled as pandas tables of some
``PIECE`` rows, whole machines each, so that a worker's memory does not go with a bucket's objects. A reading needs
only its machine's run context, which is rare next to readings: readings of a machine are
further spread over ``salts`` groups and each context event is sent to all of them, so that no
machine is bound to one task. EWMA and the sequence guard depend on every earlier row of the
machine, so a machine stays in one bucket there; what is held is bounded by the watermark's delay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from millwatch import schemas
from millwatch.operators.context import anomaly
from millwatch.operators.manifests import attach_manifest
from millwatch.operators.trimming import disposition, trim_config
from millwatch.operators.windows import LATENESS, with_event_time
from millwatch.session import use_rocksdb_state

BUCKETS = 64
#: Context this far behind the watermark is kept for late readings.
KEEP_MS = 3_600_000
#: About so many rows of a bucket are settled together; a machine's rows always are.
PIECE = 20_000
#: A reading in state keeps the microseconds of its time stamps.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_ORDER = ["timestamp", "seq"]


def _schema(**fields: str) -> pa.Schema:
    kinds = {"text": pa.string(), "long": pa.int64(), "double": pa.float64(), "flag": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in fields.items()])


def _arrow(df: pd.DataFrame, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pandas(df[schema.names], schema=schema, preserve_index=False)


def _together(schema: pa.Schema, *parts: pd.DataFrame) -> pd.DataFrame:
    return pa.concat_tables([schema.empty_table(), *[_arrow(p, schema) for p in parts]]).to_pandas()


def _pack(table: pa.Table) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpack(state, schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *[pa.ipc.open_stream(row[0]).read_all() for row in state.get()]])


def _store(state, parts: list[pa.Table]) -> None:
    whole = [_pack(p) for p in parts if len(p)]
    state.put(whole) if whole else state.clear()


def _pieces(*tables: pa.Table) -> Iterator[tuple[pa.Table, ...]]:
    """Tables of one bucket, some machines at a time, about PIECE rows together."""
    if sum(len(t) for t in tables) <= PIECE:
        yield tables
        return
    machines = pa.chunked_array([c for t in tables for c in t["machine_id"].chunks], pa.string())
    codes = machines.combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    rows = np.bincount(codes)
    piece = ((np.cumsum(rows) - rows) // PIECE)[codes]
    bounds = np.cumsum([0, *[len(t) for t in tables]])
    own = [piece[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    # rows in the order of their pieces; those of a piece keep their order
    order = [np.argsort(p, kind="stable") for p in own]
    sorted_, at = [t.take(pa.array(o)) for t, o in zip(tables, order, strict=True)], [p[o] for p, o in zip(own, order, strict=True)]
    for n in np.unique(piece):
        yield tuple(t.slice(a := int(np.searchsorted(p, n)), int(np.searchsorted(p, n, "right")) - a)
                    for t, p in zip(sorted_, at, strict=True))


class Held(StatefulProcessor):
    """Rows wait here, in Arrow blobs, until the watermark is ``wait_ms`` past them."""

    columns: pa.Schema        # what a row carries
    kept: pa.Schema           # what a machine's settled rows leave
    out: str                  # what ``settle`` gives

    def __init__(self, wait_ms: int = 0):
        self.wait_ms = wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "blob binary")
        self.memory = handle.getListState("memory", "blob binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        first = []
        for r in rows:
            own = r[~r["tick"]]
            if len(own):
                batch = _arrow(own.assign(seq=own["seq"].fillna(0), late=own["timestamp"] <= passed), self.columns)
                self.rows.appendList([_pack(batch)])
                first.append(pc.min(batch["timestamp"]).as_py())
        if known := [t for t in first if t is not None]:
            self._wake(min(known), passed)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = _unpack(self.rows, self.columns)
        if not len(held):
            return
        kept, names = _unpack(self.memory, self.kept), [c.split()[0] for c in self.out.split(", ")]
        self.begin(held, passed)
        waiting, left = [], []
        for rows, before in _pieces(held, kept):
            ordered = rows.to_pandas().sort_values(_ORDER, kind="stable", ignore_index=True)
            result, later, after = self.settle(ordered, before.to_pandas(), passed)
            waiting.append(_arrow(later, self.columns))
            left.append(_arrow(after, self.kept))
            if len(result):
                yield result[names]
        _store(self.rows, waiting)
        _store(self.memory, left)
        first = [pc.min(w["timestamp"]).as_py() for w in waiting]
        if known := [t for t in first if t is not None]:
            self._wake(min(known), passed)

    def _wake(self, earliest: int, passed: int) -> None:
        self.handle.registerTimer(max(earliest + self.wait_ms, passed + 1))

    def begin(self, held: pa.Table, passed: int) -> None:
        """Look at all rows of a bucket before they are settled piece by piece."""

    def settle(self, held: pd.DataFrame, kept: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
        """The result for the rows that are due, the rows still to wait, and what is kept. Of some machines, all rows."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class RunContext(Held):
    """Gives each reading the latest context event and the run it lies in."""

    columns = _schema(machine_id="text", is_context="flag", timestamp="long", seq="long", body="text", run_id="text",
                      event_type="text", start_ts="long", end_ts="long", late="flag")
    # closes: this trackin closes the run `closed_run`; met: a reading has followed
    kept = _schema(machine_id="text", timestamp="long", seq="long", run_id="text", event_type="text",
                   start_ts="long", end_ts="long", closes="flag", closed_run="text", met="flag")
    out = ("machine_id string, body string, run_id string, event_type string, start_ts bigint, end_ts bigint, "
           "context_ts bigint, run_start bigint, run_end bigint, run_name string, late boolean, "
           "closes boolean, closed_run string, unplaced boolean")

    def __init__(self, wait_ms: int = 0, keep_ms: int = KEEP_MS):
        super().__init__(wait_ms)
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.floor = handle.getValueState("floor", "ts bigint")

    def begin(self, held: pa.Table, passed: int) -> None:
        # context before the floor has been dropped
        self.before = self.floor.get()[0] if self.floor.exists() else None
        reads = pc.and_(pc.invert(held["is_context"]), pc.greater(pc.add(held["timestamp"], self.wait_ms), passed))
        waiting = pc.min(held["timestamp"].filter(reads)).as_py()
        oldest = (waiting if waiting is not None else passed - self.wait_ms) - self.keep_ms
        self.now = oldest if self.before is None else max(oldest, self.before)
        self.floor.update((self.now,))

    def settle(self, held: pd.DataFrame, kept: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
        fresh = held[held["is_context"]].assign(closes=False, closed_run=None, met=False)
        events = _together(self.kept, kept, fresh)
        events = self._closing(events.sort_values(_ORDER, kind="stable", ignore_index=True))
        readings = held[~held["is_context"]]
        ready = readings["timestamp"] + self.wait_ms <= passed
        due, waiting = readings.loc[ready, ["machine_id", "timestamp", "body", "late"]], readings[~ready]
        placed = self._place(due, events)
        placed["unplaced"] = placed["timestamp"] < self.before if self.before is not None else False
        return placed, waiting, self._needed(events, self.now)

    @staticmethod
    def _closing(events: pd.DataFrame) -> pd.DataFrame:
        """Mark the trackins that follow a trackin. An event whose forerunner was dropped keeps what it had."""
        earlier = events.groupby("machine_id")[["event_type", "run_id"]].shift(1)
        known = events.groupby("machine_id").cumcount() > 0
        implicit = (events["event_type"] == schemas.TRACKIN) & (earlier["event_type"] == schemas.TRACKIN)
        events["closes"] = events["closes"].where(~known, implicit).astype(bool)
        events["closed_run"] = events["closed_run"].where(~known, earlier["run_id"].where(implicit))
        return events

    @staticmethod
    def _place(due: pd.DataFrame, events: pd.DataFrame) -> pd.DataFrame:
        """Readings in their context. ``closes`` is on the first reading after an implicit close; `events` learns of it."""
        latest = events.assign(context_ts=events["timestamp"], at=range(len(events))).drop(columns="seq")
        placed = pd.merge_asof(due, latest, on="timestamp", by="machine_id")
        first = placed["at"].notna() & ~placed.duplicated("at") & ~(placed["met"].fillna(False).astype(bool))
        events.loc[placed.loc[first, "at"].astype(int), "met"] = True
        placed["closes"] = placed["closes"].fillna(False).astype(bool) & first
        placed["closed_run"] = placed["closed_run"].where(placed["closes"])
        ends = events.assign(run_start=events["timestamp"], run_name=events["run_id"],
                             run_end=events.groupby("machine_id")["timestamp"].shift(-1))
        starts = ends.loc[ends["event_type"] == schemas.TRACKIN,
                          ["machine_id", "timestamp", "run_start", "run_end", "run_name"]]
        placed = pd.merge_asof(placed, starts, on="timestamp", by="machine_id")
        after = placed["run_end"].notna() & (placed["timestamp"] > placed["run_end"])
        placed.loc[after, ["run_start", "run_end", "run_name"]] = None
        for c in ("start_ts", "end_ts", "context_ts", "run_start", "run_end"):
            placed[c] = placed[c].astype("Int64")
        return placed

    @staticmethod
    def _needed(events: pd.DataFrame, oldest: int) -> pd.DataFrame:
        """The context that a reading at or after ``oldest`` can still need: from its last trackin on."""
        past = events[events["timestamp"] <= oldest]
        last = past.groupby("machine_id")["timestamp"].max()
        start = past[past["event_type"] == schemas.TRACKIN].groupby("machine_id")["timestamp"].max()
        since = events["machine_id"].map(start.reindex(last.index).fillna(last))
        return events[since.isna() | (events["timestamp"] >= since)]


class Ewma(Held):
    columns = _schema(machine_id="text", timestamp="long", seq="long", x="double")
    kept = _schema(machine_id="text", x="double")
    out = "machine_id string, timestamp bigint, seq bigint, x double, ewma double"

    def __init__(self, alpha: float):
        super().__init__()
        self.alpha = alpha

    def settle(self, held: pd.DataFrame, kept: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
        ready = held["timestamp"] <= passed
        due, waiting = held[ready].reset_index(drop=True).assign(ewma=float("nan")), held[~ready]
        # each machine's last value goes in front of its new ones, as the value to go on from
        has = due["x"].notna()
        values = _together(self.kept, kept, due[has])
        smooth = values.groupby("machine_id")["x"].ewm(alpha=self.alpha, adjust=False).mean()
        values["ewma"] = smooth.droplevel(0)
        due.loc[has, "ewma"] = values["ewma"].iloc[len(kept):].to_numpy()
        return due, waiting, values.groupby("machine_id", as_index=False)["ewma"].last().rename(columns={"ewma": "x"})


class SequenceGuard(Held):
    columns = _schema(machine_id="text", timestamp="long", seq="long", kind="text", run_id="text")
    kept = columns
    out = "machine_id string, previous_run_id string, current_run_id string, timestamp bigint"

    def settle(self, held: pd.DataFrame, kept: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
        ready = held["timestamp"] <= passed
        due, waiting = held[ready], held[~ready]
        rows = _together(self.columns, kept, due)
        earlier = rows.groupby("machine_id")[["kind", "run_id"]].shift(1)
        rows["previous_run_id"], rows["current_run_id"] = earlier["run_id"], rows["run_id"]
        implicit = (rows["kind"] == schemas.TRACKIN) & (earlier["kind"] == schemas.TRACKIN)
        return rows[implicit], waiting, rows.groupby("machine_id").tail(1)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _seq(df: DataFrame) -> Column:
    return (F.col("seq") if "seq" in df.columns else F.lit(None).cast("bigint")).alias("seq")


def _watched(rows: DataFrame, ticks: DataFrame | None, lateness: str) -> DataFrame:
    """Rows and ticks behind one watermark, whose column goes no further, so no row is dropped for being late."""
    rows = rows.withColumn("tick", F.lit(False))
    if ticks is not None:
        # a null key beside numbers would make all keys of an Arrow batch floating-point, which the state takes for other keys
        keys = [F.lit(-1).alias(c) for c in ("bucket", "salt") if c in rows.columns]
        rows = rows.unionByName(ticks.select("timestamp", F.lit(True).alias("tick"), *keys), allowMissingColumns=True)
    return with_event_time(rows.drop("event_time"), lateness).drop("event_time")


def _placed(telemetry: DataFrame, context: DataFrame, wait_ms: int, salts: int, buckets: int,
            lateness: str, ticks: DataFrame | None, keep_ms: int) -> DataFrame:
    use_rocksdb_state(telemetry.sparkSession)
    spread = F.pmod(F.xxhash64("timestamp"), F.lit(salts)).cast("int")
    absent = {"run_id": "string", "event_type": "string", "start_ts": "bigint", "end_ts": "bigint"}
    readings = telemetry.select(
        "machine_id", _bucket(F.col("machine_id"), buckets), spread.alias("salt"), F.lit(False).alias("is_context"),
        "timestamp", _seq(telemetry), F.to_json(F.struct(*telemetry.columns), _JSON).alias("body"),
        *[F.lit(None).cast(t).alias(n) for n, t in absent.items()])
    events = context.select(
        F.col("device_id").alias("machine_id"), _bucket(F.col("device_id"), buckets),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(True).alias("is_context"),
        "timestamp", _seq(context), F.lit(None).cast("string").alias("body"), *absent)
    both = _watched(readings.unionByName(events), ticks, lateness)
    out = both.groupBy("bucket", "salt").transformWithStateInPandas(
        RunContext(wait_ms, keep_ms), RunContext.out, "append", "eventTime")
    return out.withColumn("_r", F.from_json("body", telemetry.schema, _JSON))


def attach_context_stream(telemetry: DataFrame, context: DataFrame, *, salts: int = 4, buckets: int = BUCKETS,
                          lateness: str = LATENESS, ticks: DataFrame | None = None,
                          keep_ms: int = KEEP_MS, anomalies: bool = False) -> DataFrame:
    """``attach_context`` for streams, with ``late``: the reading came after the watermark had passed it.

    ``unplaced`` is true where context that the reading may need had been dropped, more than ``keep_ms`` behind:
    ``placed_again`` takes it from a table. ``anomalies`` adds ``context_anomaly``, on the first reading after an implicit
    close; all readings of a machine then stay together, without ``salts``.
    """
    placed = _placed(telemetry, context, 0, 1 if anomalies else salts, buckets, lateness, ticks, keep_ms)
    found = [F.when(F.col("closes"), anomaly(F.col("closed_run"), F.col("run_id"), F.col("context_ts"))).alias("context_anomaly")]
    return placed.select("_r.*", "run_id", "event_type", "start_ts", "end_ts", "context_ts", "late", "unplaced",
                         *(found if anomalies else []))


def edge_trim_stream(telemetry: DataFrame, context: DataFrame, lead_ms: int = 5000, trail_ms: int = 5000,
                     action: str = "drop", *, manifests: DataFrame | None = None, salts: int = 4, buckets: int = BUCKETS,
                     lateness: str = LATENESS, ticks: DataFrame | None = None,
                     keep_ms: int = KEEP_MS) -> DataFrame:
    """``edge_trim`` for streams, from the context events themselves.

    A reading is decided once ``trail_ms`` after it has passed: a trackout within its trail has
    then arrived. The watermark's delay is the grace for a late trackin or trackout. With current ``manifests`` lead, trail
    and action are those of the machine's type, and a reading waits for the longest trail of all; readings of other types
    are left out. ``sinks.write_trimmed`` keeps what is kept, trimmed and pending apart.
    """
    lead, trail, tagged = F.lit(lead_ms), F.lit(trail_ms), F.lit(action == "tag")
    if manifests is not None:
        # one row per device type
        trail_ms = manifests.agg(F.max(trim_config(F.col("manifest.edgeTrimming"))[1])).first()[0] or 0
    placed = _placed(telemetry, context, trail_ms, salts, buckets, lateness, ticks, keep_ms)
    rows = placed.select("_r.*", F.col("run_name").alias("run_id"), F.col("run_start").alias("start_ts"),
                         F.col("run_end").alias("end_ts"))
    if manifests is not None:
        rows = attach_manifest(rows, manifests).where("_manifest is not null")
        lead, trail, kind = trim_config(F.col("_manifest.edgeTrimming"))
        tagged = kind == "tag"
    # An end later than the trail may be known or not when a reading is decided; it changes nothing.
    near = F.when(F.col("end_ts") - F.col("timestamp") <= trail, F.col("end_ts"))
    rows = rows.withColumn("end_ts", near).withColumn(
        "disposition", disposition(F.col("timestamp"), F.col("start_ts"), F.col("end_ts"), lead, trail))
    return rows.where(tagged | ~F.col("disposition").startswith("TRIMMED")).drop("_manifest")


def _in_order(rows: DataFrame, processor: Held, buckets: int, lateness: str, ticks: DataFrame | None) -> DataFrame:
    use_rocksdb_state(rows.sparkSession)
    keyed = rows.select("*", _bucket(F.col("machine_id"), buckets))
    return _watched(keyed, ticks, lateness).groupBy("bucket").transformWithStateInPandas(
        processor, processor.out, "append", "eventTime")


def ewma_stream(df: DataFrame, column: str, alpha: float, *, key: str = "machine_id", buckets: int = BUCKETS,
                lateness: str = LATENESS, ticks: DataFrame | None = None) -> DataFrame:
    """``ewma`` for streams: machine, timestamp, seq, the value and ``<column>_ewma``."""
    rows = df.select(F.col(key).alias("machine_id"), "timestamp", _seq(df), F.col(column).cast("double").alias("x"))
    out = _in_order(rows, Ewma(alpha), buckets, lateness, ticks)
    return out.withColumnsRenamed({"x": column, "ewma": f"{column}_ewma", "machine_id": key})


def implicit_closes_stream(context: DataFrame, *, buckets: int = BUCKETS, lateness: str = LATENESS,
                           ticks: DataFrame | None = None) -> DataFrame:
    """``implicit_closes`` for streams."""
    rows = context.select(F.col("device_id").alias("machine_id"), "timestamp", _seq(context),
                          F.col("event_type").alias("kind"), "run_id")
    out = _in_order(rows, SequenceGuard(), buckets, lateness, ticks)
    return out.select(F.col("machine_id").alias("device_id"), anomaly(
        F.col("previous_run_id"), F.col("current_run_id"), F.col("timestamp")).alias("context_anomaly"))


def dedupe_stream(df: DataFrame, *, lateness: str = LATENESS) -> DataFrame:
    """One row per machine and timestamp: the first that arrives, where ``series.dedupe`` keeps the last."""
    return with_event_time(df, lateness).dropDuplicatesWithinWatermark(["machine_id", "timestamp"])


def new_series_stream(series: DataFrame) -> DataFrame:
    """Each (device, measurement) once, when first seen. Its state grows with the number of series."""
    return series.dropDuplicates(["device_id", "measurement"])
