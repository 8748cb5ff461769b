"""Rules over several readings, on streams: rates, durations and windows.

A result is given at once, in the micro-batch that brings the reading, and is corrected if a later arrival changes it:
the output is a log of changes, ``raised`` (+1) and ``withdrawn`` (-1), whose sum is at any time what the table operators
give for the readings that have arrived. ``standing`` adds a log up.

Machines are hashed into ``buckets``. A bucket's readings of a micro-batch are judged in one call, all machines together as
arrays, and its state is held as Arrow tables, so the cost of a micro-batch goes with its rows and not with calls a machine:

* ``tail``: the readings of the last ``keep_ms`` before the watermark, one table per micro-batch;
* ``base``: what the readings before the tail leave behind, a row per machine: the last value and time of each measurement,
  and since when each rule has been breached;
* ``ends``: the same at the end of the tail. A machine whose readings come in order is judged from there on, and the tail is
  only appended to. The tail is read for machines whose readings do not: theirs are merged and judged again; what differs is
  sent;
* ``panes``: counts, means, squares, least and greatest of each measurement, per machine and pane of the greatest common
  divisor of all window sizes and slides, one table per micro-batch; parts of a pane are folded in the order of their arrival.
  A window is folded from its panes when the watermark passes its end, and again when a later reading falls into one that is
  over.

Event-time timers fold what is older than ``keep_ms`` into ``base`` (eight times per ``keep_ms``), drop panes that no window
within ``keep_ms`` can need, and close windows. Readings older than ``base`` are not judged here but given out with a null
rule, so that nothing is lost without a word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from millwatch import schemas
from millwatch.functions import scalars
from millwatch.operators import rules as rule_ops
from millwatch.operators.expressions import condition
from millwatch.operators.windows import LATENESS
from millwatch.session import use_rocksdb_state
from millwatch.streaming.stateful import _bucket, _seq, _watched

#: Readings are kept, and results corrected, this far behind the watermark.
KEEP_MS = 3_600_000
BUCKETS = 256
#: Stands for no time.
NEVER = -(1 << 62)
OUT = "machine_id string, rule_id string, timestamp bigint, seq bigint, value double, change int"


@dataclass(frozen=True)
class Rule:
    """One rule as plain values. ``text`` is the place of its custom condition among the verdicts of a reading."""

    rule_id: str
    device_type: str | None
    condition: str
    measurement: int | None
    threshold: float | None
    lo: float | None
    hi: float | None
    duration_ms: int
    text: int | None
    size_ms: int | None
    slide_ms: int | None
    aggregate: str

    def breached(self, value: np.ndarray, rate: np.ndarray, verdict: np.ndarray | None) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            if self.condition == "greater_than":
                return value > self.threshold
            if self.condition == "less_than":
                return value < self.threshold
            if self.condition == "between":
                return (value >= self.lo) & (value <= self.hi)
            if self.condition == "outside":
                return (value < self.lo) | (value > self.hi)
            if self.condition == "rate_above":
                return rate > self.threshold
            if self.condition == "rate_below":
                return rate < self.threshold
        return verdict


@dataclass
class Readings:
    """Readings as arrays, by machine, time and then ``seq``."""

    of: np.ndarray         # the machine's place in the bucket
    ts: np.ndarray
    seq: np.ndarray
    kind: np.ndarray
    x: np.ndarray          # a column per measurement, NaN where null
    verdicts: np.ndarray   # a column per custom condition

    def __len__(self) -> int:
        return len(self.ts)

    def take(self, which) -> Readings:
        return Readings(self.of[which], self.ts[which], self.seq[which], self.kind[which], self.x[which], self.verdicts[which])

    def ordered(self) -> Readings:
        return self.take(np.lexsort((self.seq, self.ts, self.of)))

    def merged(self, other: Readings) -> Readings:
        names = ("of", "ts", "seq", "kind", "x", "verdicts")
        return Readings(*(np.concatenate([getattr(self, c), getattr(other, c)]) for c in names)).ordered()


@dataclass
class Left:
    """What a stretch of readings leaves for the next one, a row per machine."""

    ts: np.ndarray             # time and seq of the last reading
    seq: np.ndarray
    last_ts: np.ndarray        # per measurement, NEVER if there was no value
    last_x: np.ndarray
    since: np.ndarray          # per rule: since when it has been breached, NEVER if it is not

    @staticmethod
    def nothing(machines: int, measurements: int, rules: int) -> Left:
        return Left(np.full(machines, NEVER), np.full(machines, NEVER), np.full((machines, measurements), NEVER),
                    np.full((machines, measurements), np.nan), np.full((machines, rules), NEVER))

    def copy(self) -> Left:
        return Left(self.ts.copy(), self.seq.copy(), self.last_ts.copy(), self.last_x.copy(), self.since.copy())


def _heads(of: np.ndarray) -> np.ndarray:
    """For each row the place of its machine's first row."""
    at = np.arange(len(of))
    return np.maximum.accumulate(np.where(np.concatenate(([True], of[1:] != of[:-1])), at, 0)) if len(of) else at


def _tails(of: np.ndarray) -> np.ndarray:
    """The places of the machines' last rows."""
    return np.flatnonzero(np.concatenate((of[1:] != of[:-1], [True]))) if len(of) else np.arange(0)


def _before(found: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """For each row its machine's last one before it where `found` holds; -1 if none."""
    if not len(found):
        return heads
    at = np.maximum.accumulate(np.where(found, np.arange(len(found)), -1))
    at = np.concatenate(([-1], at[:-1]))
    return np.where(at >= heads, at, -1)


def rates(rows: Readings, left: Left) -> np.ndarray:
    """Change per second against the last reading with a value, per measurement; NaN where there is none."""
    out = np.full(rows.x.shape, np.nan)
    heads = _heads(rows.of)
    for m in range(rows.x.shape[1]):
        x = rows.x[:, m]
        prior = _before(~np.isnan(x), heads)
        first_ts = np.where(left.last_ts[:, m] == NEVER, np.nan, left.last_ts[:, m].astype(float))[rows.of]
        ts = np.where(prior >= 0, rows.ts[prior].astype(float), first_ts)
        px = np.where(prior >= 0, x[prior], left.last_x[rows.of, m])
        gone = (rows.ts - ts) / 1000.0
        with np.errstate(divide="ignore", invalid="ignore"):
            out[:, m] = np.where(gone != 0, (x - px) / gone, np.nan)
    return out


def judge(rows: Readings, left: Left, rules: Sequence[Rule]) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], Left]:
    """((rule, places where it fires, values) for each rule, what the rows leave), going on from ``left``."""
    if not len(rows):
        return [], left
    rate = rates(rows, left)
    fired, after = [], left.copy()
    for n, rule in enumerate(rules):
        own = np.flatnonzero(rows.kind == rule.device_type) if rule.device_type is not None else np.arange(len(rows))
        if not len(own):
            continue
        value = rows.x[own, rule.measurement] if rule.measurement is not None else np.full(len(own), np.nan)
        change = rate[own, rule.measurement] if rule.measurement is not None else value
        hit = rule.breached(value, change, rows.verdicts[own, rule.text] if rule.text is not None else None)
        ts, of = rows.ts[own], rows.of[own]
        if rule.duration_ms:
            heads = _heads(of)
            quiet = _before(~hit, heads)  # a stretch starts after the last reading that did not breach
            since = left.since[of, n]
            start = np.where(quiet >= 0, ts[np.minimum(quiet + 1, len(ts) - 1)], np.where(since == NEVER, ts[heads], since))
            last = _tails(of)
            after.since[of[last], n] = np.where(hit[last], start[last], NEVER)
            hit = hit & (ts - start >= rule.duration_ms)
        fired.append((n, own[hit], value[hit]))
    heads, last = _heads(rows.of), _tails(rows.of)
    ending = rows.of[last]
    for m in range(rows.x.shape[1]):
        at = np.maximum.accumulate(np.where(np.isnan(rows.x[:, m]), -1, np.arange(len(rows))))[last]
        has = at >= heads[last]
        after.last_ts[ending[has], m] = rows.ts[at[has]]
        after.last_x[ending[has], m] = rows.x[at[has], m]
    after.ts[ending], after.seq[ending] = rows.ts[last], rows.seq[last]
    return fired, after


# Panes: n, mean, M2, least, greatest per measurement, as one list of numbers.


def moments(x: np.ndarray, heads: np.ndarray | None = None) -> np.ndarray:
    """The moments of each stretch of rows that starts at one of ``heads`` (without them, of all rows)."""
    if heads is None:
        return moments(x, np.zeros(1, np.int64))[0]
    size = np.diff(np.append(heads, len(x)))
    has = ~np.isnan(x)
    n = np.add.reduceat(has.astype(float), heads, axis=0)
    mean = np.divide(np.add.reduceat(np.where(has, x, 0.0), heads, axis=0), n, out=np.zeros_like(n), where=n > 0)
    square = np.where(has, (x - np.repeat(mean, size, axis=0)) ** 2, 0.0)
    parts = [n, mean, np.add.reduceat(square, heads, axis=0), np.minimum.reduceat(np.where(has, x, math.inf), heads, axis=0),
             np.maximum.reduceat(np.where(has, x, -math.inf), heads, axis=0)]
    return np.stack(parts, axis=2).reshape(len(heads), -1)


def folded(panes: np.ndarray | Sequence[Sequence[float]], heads: np.ndarray | None = None) -> np.ndarray:
    """The moments of each stretch of panes that starts at one of ``heads`` (without them, of all panes)."""
    if heads is None:
        return folded(panes, np.zeros(1, np.int64))[0]
    p = np.asarray(panes, float).reshape(len(panes), -1, 5)
    size = np.diff(np.append(heads, len(p)))
    n, mean, m2 = p[:, :, 0], p[:, :, 1], p[:, :, 2]
    total = np.add.reduceat(n, heads, axis=0)
    centre = np.divide(np.add.reduceat(n * mean, heads, axis=0), total, out=np.zeros_like(total), where=total > 0)
    spread = np.add.reduceat(m2 + n * (mean - np.repeat(centre, size, axis=0)) ** 2, heads, axis=0)
    parts = [total, centre, spread, np.minimum.reduceat(p[:, :, 3], heads, axis=0), np.maximum.reduceat(p[:, :, 4], heads, axis=0)]
    return np.stack(parts, axis=2).reshape(len(heads), -1)


def aggregate(pane: np.ndarray, measurement: int, name: str) -> np.ndarray:
    n, mean, m2, low, high = np.moveaxis(np.asarray(pane)[..., 5 * measurement : 5 * measurement + 5], -1, 0)
    if name == "count":
        return n
    with np.errstate(divide="ignore", invalid="ignore"):
        value = {"avg": mean, "sum": n * mean, "min": low, "max": high, "stddev": np.sqrt(m2 / (n - 1))}[name]
    return np.where(n >= (2 if name == "stddev" else 1), value, math.nan)


@dataclass
class Panes:
    """Panes of a bucket as arrays, by machine and pane."""

    of: np.ndarray
    pane: np.ndarray
    kind: np.ndarray
    moments: np.ndarray

    def __len__(self) -> int:
        return len(self.pane)

    def take(self, which) -> Panes:
        return Panes(self.of[which], self.pane[which], self.kind[which], self.moments[which])

    @staticmethod
    def summed(parts: Sequence[Panes]) -> Panes:
        """Parts in the order of their arrival, those of one pane folded one after the other: however often that is done, and
        whatever was folded before, the numbers are the same to the last bit, so that a withdrawal is of what was raised."""
        both = Panes(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("of", "pane", "kind", "moments")))
        both = both.take(np.lexsort((both.pane, both.of)))  # stable
        new = np.ones(len(both), bool)
        new[1:] = (both.of[1:] != both.of[:-1]) | (both.pane[1:] != both.pane[:-1])
        heads, number = np.flatnonzero(new), np.cumsum(new) - 1
        out = both.take(heads)
        out.kind = both.kind[np.append(heads[1:], len(both)) - 1] if len(both) else out.kind
        rank = np.arange(len(both)) - heads[number]
        by_rank = np.argsort(rank, kind="stable")
        bounds = np.searchsorted(rank[by_rank], np.arange(1, rank.max(initial=0) + 2))
        for a, b in zip(bounds, bounds[1:], strict=False):
            at = by_rank[a:b]
            pairs = np.stack([out.moments[number[at]], both.moments[at]], axis=1).reshape(2 * len(at), -1)
            out.moments[number[at]] = folded(pairs, np.arange(0, 2 * len(at), 2))
        return out


class RuleState(StatefulProcessor):
    """The readings of a bucket of machines against all rules of the set that look further than one reading."""

    def __init__(self, rules: Sequence[Rule], measurements: int, texts: int, keep_ms: int):
        self.rules, self.measurements, self.texts, self.keep_ms = list(rules), measurements, texts, keep_ms
        self.along = [r for r in self.rules if r.size_ms is None]
        self.windowed = [r for r in self.rules if r.size_ms is not None]
        sizes = [s for r in self.windowed for s in (r.size_ms, r.slide_ms)]
        self.pane = math.gcd(*sizes) if sizes else 0
        self.longest = max((r.size_ms for r in self.windowed), default=0)
        self.grain = max(1, keep_ms // 8)

    def init(self, handle) -> None:
        self.handle = handle
        self.tail = handle.getListState("tail", "blob binary")
        self.base = handle.getValueState("base", "blob binary")
        self.ends = handle.getValueState("ends", "blob binary")
        self.panes = handle.getListState("panes", "blob binary")
        self.closed = handle.getValueState("closed", "until bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        frames = [r[~r["tick"].astype(bool)] for r in rows]
        frames = [f for f in frames if len(f)]
        if not frames:
            return
        names = Names()
        base, ends = self._left(self.base, names), self._left(self.ends, names)
        new = self._arrays(frames, names)
        base, ends = self._wider(base, names), self._wider(ends, names)
        old_enough = _earlier(new, base)
        beyond, new = new.take(old_enough), new.take(~old_enough)
        out = [Changes.at(beyond, None)]
        if len(new):
            heads = np.flatnonzero(_heads(new.of) == np.arange(len(new)))
            behind = np.zeros(len(names), bool)
            behind[new.of[heads]] = _earlier(new.take(heads), ends)
            straight, mixed = new.take(~behind[new.of]), new.take(behind[new.of])
            fired, after = judge(straight, ends, self.along)
            out.append(self._raised(straight, fired, 1))
            if len(mixed):
                before = self._tail(names)
                before = before.take(behind[before.of])
                whole = before.merged(mixed)
                was = self._raised(before, judge(before, base, self.along)[0], -1)
                fired, left = judge(whole, base, self.along)
                out.append(_difference(was, self._raised(whole, fired, 1)))
                for part in ("ts", "seq", "last_ts", "last_x", "since"):
                    getattr(after, part)[behind] = getattr(left, part)[behind]
            self._put(self.ends, after, names)
            self.tail.appendList([self._rows(new, names)])
            out += self._into_panes(new, passed, names)
            self._wake(passed, int(new.ts.min()), None)
        changes = Changes.together(out)
        if len(changes):
            yield changes.frame(names, self.rules)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, names = timerValues.getCurrentWatermarkInMs(), Names()
        earliest, coarse = None, expiredTimerInfo.getExpiryTimeInMs() % self.grain == 0
        if coarse:
            earliest = self._shorten(passed, names)
        changes = Changes.together([])
        if self.windowed:
            held = self._held(names)
            changes = self._close(held, passed)
            gone = held.pane + self.pane + self.longest + self.keep_ms <= passed
            if coarse and len(held):
                held = held.take(~gone)
                self.panes.put([self._packed_panes(held, names)]) if len(held) else self.panes.clear()
            self._wake(passed, earliest, held.pane)
        else:
            self._wake(passed, earliest, None)
        if len(changes):
            yield changes.frame(names, self.rules)

    def _shorten(self, passed: int, names: Names) -> int | None:
        """Fold the readings older than ``keep_ms`` into ``base``; gives the time of the first one that is left."""
        tail = self._tail(names)
        old = tail.ts < passed - self.keep_ms
        if old.any():
            base = self._wider(self._left(self.base, names), names)
            self._put(self.base, judge(tail.take(old), base, self.along)[1], names)
            tail = tail.take(~old)
            self.tail.put([self._rows(tail, names)]) if len(tail) else self.tail.clear()
        return int(tail.ts.min()) if len(tail) else None

    def close(self) -> None:
        pass

    # windows

    def _close(self, held: Panes, passed: int) -> Changes:
        """Fold the windows that the watermark has passed since the last time."""
        until = self.closed.get()[0] if self.closed.exists() else passed
        if until < passed or not self.closed.exists():
            self.closed.update((passed,))
        if until >= passed:
            return Changes.together([])
        which = []
        for rule in self.windowed:
            of, start = _windows(held.of, held.pane, rule)
            ended = (start + rule.size_ms > until) & (start + rule.size_ms <= passed)
            which.append((of[ended], start[ended]))
        return self._fold(held, which, 1)

    def _into_panes(self, new: Readings, passed: int, names: Names) -> list[Changes]:
        """Add readings to their panes. Windows that are over are folded before and after."""
        if not self.windowed:
            return []
        starts = new.ts // self.pane * self.pane
        heads = np.flatnonzero(np.concatenate(([True], (starts[1:] != starts[:-1]) | (new.of[1:] != new.of[:-1]))))
        kinds = new.kind[np.append(heads[1:], len(new)) - 1]
        touched = Panes(new.of[heads], starts[heads], kinds, moments(new.x, heads))
        due = not self.closed.exists() or self.closed.get()[0] < passed
        late = int(touched.pane.min()) + self.pane <= passed
        out = []
        if due or late:
            held = self._held(names)
            out.append(self._close(held, passed))
            hit = []
            for rule in self.windowed:
                of, start = _windows(touched.of, touched.pane, rule)
                over = start + rule.size_ms <= passed
                hit.append((of[over], start[over]))
            was = self._fold(held, hit, -1)
            out.append(_difference(was, self._fold(Panes.summed([held, touched]), hit, 1)))
        self.panes.appendList([self._packed_panes(touched, names)])
        self._wake(passed, None, touched.pane)
        return out

    def _fold(self, held: Panes, which: list[tuple[np.ndarray, np.ndarray]], sign: int) -> Changes:
        """The alerts of the windows (machines, starts) of each windowed rule. ``held`` is by machine and pane."""
        out = []
        for rule, (of, start) in zip(self.windowed, which, strict=True):
            if not len(of) or not len(held):
                continue
            # machine and pane as one number, so that a window is a stretch of panes
            low, span = int(min(held.pane.min(), start.min())), int(max(held.pane.max(), start.max())) + rule.size_ms + 1
            line = (held.pane - low) // self.pane + held.of * ((span - low) // self.pane + 1)
            first = (start - low) // self.pane + of * ((span - low) // self.pane + 1)
            a, b = np.searchsorted(line, first), np.searchsorted(line, first + rule.size_ms // self.pane)
            of, start, a, b = of[b > a], start[b > a], a[b > a], b[b > a]
            if rule.device_type is not None and len(of):
                fits = held.kind[b - 1] == rule.device_type
                of, start, a, b = of[fits], start[fits], a[fits], b[fits]
            if not len(of):
                continue
            sizes = b - a
            heads = np.cumsum(sizes) - sizes
            at = np.repeat(a - heads, sizes) + np.arange(int(sizes.sum()))
            value = aggregate(folded(held.moments[at], heads), rule.measurement, rule.aggregate)
            hit = rule.breached(value, np.full(len(value), np.nan), None)
            number = self.rules.index(rule)
            out.append(Changes(of[hit], np.full(int(hit.sum()), number), start[hit] + rule.size_ms, np.zeros(int(hit.sum()), np.int64),
                               value[hit], np.full(int(hit.sum()), sign)))
        return Changes.together(out)

    def _wake(self, passed: int, earliest: int | None, panes: np.ndarray | None) -> None:
        """Timers: one for the next window's end, one for a reading or a pane that grows too old.

        The latter fall on multiples of ``grain`` only, so that the tail is read a few times per ``keep_ms``.
        """
        old = [] if earliest is None else [earliest + self.keep_ms + 1]
        if panes is not None and len(panes):
            old.append(int(panes.min()) + self.pane + self.longest + self.keep_ms)
            places = np.unique(panes)
            ends = [int(e.min()) for r in self.windowed if len(e := (w := _windows(places, places, r)[1] + r.size_ms)[w > passed])]
            if ends:
                self.handle.registerTimer(min(ends))
        if old:
            self.handle.registerTimer(-(-max(min(old), passed + 1) // self.grain) * self.grain)

    # state

    def _raised(self, rows: Readings, fired, sign: int) -> Changes:
        return Changes.together([Changes.at(rows.take(at), self.rules.index(self.along[n]), values, sign) for n, at, values in fired])

    def _left(self, state, names: Names) -> Left:
        held = state.get() if state.exists() else None
        if held is None:
            return Left.nothing(0, self.measurements, len(self.along))
        t = _unpack([held[0]])
        places = names.places(t["machine"].to_pylist())
        out = Left.nothing(len(names), self.measurements, len(self.along))
        out.ts[places], out.seq[places] = _numbers(t, "ts"), _numbers(t, "seq")
        for name, kept in (("last_ts", out.last_ts), ("last_x", out.last_x), ("since", out.since)):
            for i in range(kept.shape[1]):
                kept[places, i] = _numbers(t, f"{name}{i}")
        return out

    def _wider(self, left: Left, names: Names) -> Left:
        """With rows for machines that have been met since."""
        more = Left.nothing(len(names) - len(left.ts), self.measurements, len(self.along))
        return Left(*(np.concatenate([getattr(left, c), getattr(more, c)]) for c in ("ts", "seq", "last_ts", "last_x", "since")))

    def _put(self, state, left: Left, names: Names) -> None:
        columns = {"ts": left.ts, "seq": left.seq}
        for name, kept in (("last_ts", left.last_ts), ("last_x", left.last_x), ("since", left.since)):
            columns |= {f"{name}{i}": kept[:, i] for i in range(kept.shape[1])}
        met = left.ts > NEVER
        state.update((_packed(names, np.flatnonzero(met), {n: c[met] for n, c in columns.items()}),))

    def _arrays(self, frames: list[pd.DataFrame], names: Names) -> Readings:
        df = pd.concat(frames)
        n = len(df)
        x = np.column_stack([df[f"x{m}"].to_numpy(float, na_value=np.nan) for m in range(self.measurements)]) if self.measurements else np.zeros((n, 0))
        verdicts = np.column_stack([df[f"v{t}"].fillna(False).to_numpy(bool) for t in range(self.texts)]) if self.texts else np.zeros((n, 0), bool)
        of, machines = pd.factorize(df["machine_id"].to_numpy(object), use_na_sentinel=False)
        places = names.places([None if pd.isna(m) else m for m in machines])
        return Readings(places[of], df["timestamp"].to_numpy(np.int64), df["seq"].fillna(0).to_numpy(np.int64),
                        df["machine_type"].to_numpy(object), x, verdicts).ordered()

    def _rows(self, rows: Readings, names: Names) -> tuple[bytes]:
        columns = {"ts": rows.ts, "seq": rows.seq, "kind": rows.kind}
        columns |= {f"x{m}": rows.x[:, m] for m in range(self.measurements)}
        return (_packed(names, rows.of, columns | {f"v{t}": rows.verdicts[:, t] for t in range(self.texts)}),)

    def _tail(self, names: Names) -> Readings:
        t = _unpack([r[0] for r in self.tail.get()])
        if t is None:
            return Readings(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, object), np.zeros((0, self.measurements)), np.zeros((0, self.texts), bool))
        x = [_numbers(t, f"x{m}") for m in range(self.measurements)]
        verdicts = [_numbers(t, f"v{i}") for i in range(self.texts)]
        return Readings(names.coded(t["machine"]), _numbers(t, "ts"), _numbers(t, "seq"), _texts(t, "kind"),
                        np.column_stack(x) if x else np.zeros((len(t), 0)),
                        np.column_stack(verdicts) if verdicts else np.zeros((len(t), 0), bool)).ordered()

    def _packed_panes(self, panes: Panes, names: Names) -> tuple[bytes]:
        columns = {"pane": panes.pane, "kind": panes.kind} | {f"m{i}": panes.moments[:, i] for i in range(panes.moments.shape[1])}
        return (_packed(names, panes.of, columns),)

    def _held(self, names: Names) -> Panes:
        """The panes in state, each as its parts add up in the order of their arrival."""
        parts = [Panes(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object), np.zeros((0, 5 * self.measurements)))]
        for r in self.panes.get():
            t = _unpack([r[0]])
            numbers = np.column_stack([_numbers(t, f"m{i}") for i in range(5 * self.measurements)])
            parts.append(Panes(names.coded(t["machine"]), _numbers(t, "pane"), _texts(t, "kind"), numbers))
        return Panes.summed(parts)


class Names:
    """Machines by place."""

    def __init__(self) -> None:
        self.listed: list[str | None] = []
        self.at: dict[str | None, int] = {}

    def __len__(self) -> int:
        return len(self.listed)

    def places(self, machines: Sequence[str | None]) -> np.ndarray:
        for m in machines:
            if m not in self.at:
                self.at[m] = len(self.listed)
                self.listed.append(m)
        return np.array([self.at[m] for m in machines], np.int64)

    def coded(self, column: pa.ChunkedArray) -> np.ndarray:
        code = column.combine_chunks().dictionary_encode("encode")
        return self.places(code.dictionary.to_pylist())[code.indices.to_numpy(zero_copy_only=False)]


def _packed(names: Names, of: np.ndarray, columns: dict[str, np.ndarray]) -> bytes:
    machines = pa.DictionaryArray.from_arrays(pa.array(of, pa.int64()), pa.array(names.listed, pa.string())).cast(pa.string())
    t = pa.table({"machine": machines} | {n: pa.array(c, pa.string(), from_pandas=True) if c.dtype == object else pa.array(c) for n, c in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as writer:
        writer.write_table(t)
    return sink.getvalue().to_pybytes()


def _unpack(blobs: Sequence[bytes]) -> pa.Table | None:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs]) if blobs else None


def _numbers(t: pa.Table, name: str) -> np.ndarray:
    return t[name].to_numpy()


def _texts(t: pa.Table, name: str) -> np.ndarray:
    return np.array(t[name].to_pylist(), object)


def _earlier(rows: Readings, left: Left) -> np.ndarray:
    """Which rows come before what ``left`` ends with."""
    ts, seq = left.ts[rows.of], left.seq[rows.of]
    return (rows.ts < ts) | ((rows.ts == ts) & (rows.seq < seq))


def _windows(of: np.ndarray, panes: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Machines and starts of the windows of a rule that hold one of the panes, each once."""
    last = panes // rule.slide_ms * rule.slide_ms
    found = []
    for back in range(-(-rule.size_ms // rule.slide_ms)):
        start = last - back * rule.slide_ms
        inside = start + rule.size_ms > panes
        found.append(np.column_stack([of[inside], start[inside]]))
    both = np.unique(np.concatenate(found), axis=0)
    return both[:, 0], both[:, 1]


@dataclass
class Changes:
    """Rows of the log as arrays; a rule of -1 is none."""

    of: np.ndarray
    rule: np.ndarray
    ts: np.ndarray
    seq: np.ndarray
    value: np.ndarray
    change: np.ndarray

    def __len__(self) -> int:
        return len(self.ts)

    @staticmethod
    def at(rows: Readings, rule: int | None, value: np.ndarray | None = None, change: int = 0) -> Changes:
        n = len(rows)
        return Changes(rows.of, np.full(n, -1 if rule is None else rule), rows.ts, rows.seq,
                       np.full(n, np.nan) if value is None else value, np.full(n, change))

    @staticmethod
    def together(parts: Sequence[Changes]) -> Changes:
        whole = [p for p in parts if len(p)]
        if not whole:
            return Changes(*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0), np.zeros(0, np.int64))
        return Changes(*(np.concatenate([getattr(p, c) for p in whole]) for c in ("of", "rule", "ts", "seq", "value", "change")))

    def frame(self, names: Names, rules: Sequence[Rule]) -> pd.DataFrame:
        ids = np.array([r.rule_id for r in rules] + [None], object)
        return pd.DataFrame({"machine_id": np.array(names.listed, object)[self.of], "rule_id": ids[self.rule], "timestamp": self.ts,
                             "seq": self.seq, "value": self.value, "change": self.change.astype(np.int32)})


def _difference(was: Changes, now: Changes) -> Changes:
    """What must be withdrawn and raised for `was` to become `now`; both may repeat rows."""
    both = Changes.together([was, now])
    if not len(both):
        return both
    keys = ["of", "rule", "ts", "seq", "value"]
    total = pd.DataFrame({c: getattr(both, c) for c in [*keys, "change"]}).groupby(keys, dropna=False, sort=False, as_index=False)["change"].sum()
    total = total[total["change"] != 0]
    times = total["change"].abs().to_numpy()
    return Changes(*(np.repeat(total[c].to_numpy(), times) for c in keys), np.repeat(np.sign(total["change"].to_numpy()), times))


def several(rules: DataFrame, telemetry: DataFrame, *,
            measurements: Sequence[str] = schemas.MEASUREMENTS) -> tuple[list[Rule], list[str], DataFrame]:
    """(rules that need more than one reading, texts of their custom conditions, rules that no stream judges and why).

    Rules are configuration and are listed on the driver. A stream does not judge windows that must last, or rates or
    custom conditions of windows; the table operators do.
    """
    full = rule_ops.good_rules(rule_ops.complete(rules), telemetry, measurements=measurements)
    wide = scalars.is_windowed(F.col("window"))
    own = full.where(wide | (F.col("durationSec") > 0) | rule_ops.is_rate())
    hard = wide & ((F.coalesce("durationSec", F.lit(0.0)) > 0) | rule_ops.is_rate() | (F.col("condition") == "custom"))
    refused = own.where(hard).select("rule_id", F.lit("a window that must last, or of rates or a text, is judged over tables only").alias("error_message"))
    rows = own.where(~hard).withColumns({
        "_wide": wide, "_size": scalars.seconds_to_millis(F.col("window.sizeSeconds")),
        "_slide": F.when(F.col("window.type") == "sliding", scalars.seconds_to_millis(F.col("window.slideSeconds"))),
        "_duration": F.coalesce(scalars.seconds_to_millis(F.col("durationSec")), F.lit(0)),
        "_aggregate": F.coalesce(F.col("params")["aggregate"], F.lit("avg")), "_text": F.col("params")["expr"],
    }).orderBy("rule_id").collect()
    texts = sorted({r["_text"] for r in rows if r["condition"] == "custom"})
    place = {m: i for i, m in enumerate(measurements)}
    listed = [Rule(r["rule_id"], r["device_type"], r["condition"], place.get(r["measurement"]), r["threshold"], r["lo"], r["hi"],
                   0 if r["_wide"] else r["_duration"], texts.index(r["_text"]) if r["condition"] == "custom" else None,
                   r["_size"] if r["_wide"] else None, (r["_slide"] or r["_size"]) if r["_wide"] else None, r["_aggregate"])
              for r in rows]
    return listed, texts, refused


def rule_changes_stream(telemetry: DataFrame, rules: DataFrame, *, lateness: str = LATENESS, ticks: DataFrame | None = None,
                        keep_ms: int = KEEP_MS, measurements: Sequence[str] = schemas.MEASUREMENTS,
                        buckets: int = BUCKETS) -> DataFrame:
    """The log of raised and withdrawn alerts of all rules over several readings.

    ``rules`` are current rules, taken when the query starts. Rows: machine, rule, time (a window's end), seq, value and
    change; a reading older than ``keep_ms`` behind the watermark gives one row with a null rule and no change.
    """
    use_rocksdb_state(telemetry.sparkSession)
    empty = telemetry.sparkSession.createDataFrame([], telemetry.schema)
    listed, texts, _ = several(rules, empty, measurements=measurements)
    kind = F.col("machine_type") if "machine_type" in telemetry.columns else F.lit(None).cast("string")
    rows = telemetry.select(
        "machine_id", _bucket(F.col("machine_id"), buckets), kind.alias("machine_type"), "timestamp", _seq(telemetry),
        *[F.col(m).cast("double").alias(f"x{i}") for i, m in enumerate(measurements)],
        *[condition(t, empty).alias(f"v{i}") for i, t in enumerate(texts)])
    processor = RuleState(listed, len(measurements), len(texts), keep_ms)
    return _watched(rows, ticks, lateness).groupBy("bucket").transformWithStateInPandas(processor, OUT, "append", "eventTime")


def standing(log: DataFrame) -> DataFrame:
    """What the log of changes adds up to: one row per alert that stands."""
    names = ["machine_id", "rule_id", "timestamp", "seq", "value"]
    total = log.where(F.col("rule_id").isNotNull()).groupBy(*names).agg(F.sum("change").alias("_n"))
    return total.where(F.col("_n") > 0).withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).drop("_n")


def beyond(log: DataFrame) -> DataFrame:
    """Readings that came too late to be judged by the stream."""
    return log.where(F.col("rule_id").isNull()).select("machine_id", "timestamp", "seq")


def alerts_of(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Changes as alert rows with the rule's routing, and ``change``. Rules are configuration."""
    r = rule_ops.complete(rules).select("rule_id", "rule_type", "measurement", "condition", "threshold", "severity", "actions", "alertChannel")
    held = changes.join(F.broadcast(r), "rule_id")
    names = ("rule_id", "rule_type", "measurement", "condition", "threshold", "severity", "actions", "alertChannel")
    alert = rule_ops.alert_struct(F.col("machine_id"), F.col("timestamp"), F.struct(*names), F.col("value"))
    extra = ["change"] if "change" in changes.columns else []
    return held.select(F.col("machine_id").alias("device_id"), alert.alias("_a"), *extra).select("device_id", "_a.*", *extra)
