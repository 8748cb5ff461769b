"""Whitening of embeddings on their leading components.

Four passes over the table, each vector where it is read: counts and exact sums per dimension; the covariance about the
mean, one matrix a task, whose rows are added up by row number; the covariance of what whitening gives; the rows
themselves. The driver holds matrices of the vectors' dimension, never vectors: components come from ``qdwh.eigen`` and
go to the tasks with the plan, 8 columns of them.

Vectors that are null, empty, or hold a null, NaN or infinite entry are left out. All vectors of one table have one
length; if not, the commonest is meant (the greater of two as common) and others are left out too. A component without
variance (constant vectors, or fewer than components) has null `whitened`; if none has any, `identity_error` is null,
and `explained` too. Repeated rows and ids are rows of their own; null ids stay null. Other columns are not looked at. A
table without vectors gives no rows. An entry beyond 2**42 is an error, as its `x` would lose digits; so is a
`deviation` over 2**63.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm import qdwh
from millwatch.llm.store import arrow_schema, map_arrow, record

SCALE, SHIFT = 1024, 100_000
#: Components that are reported.
LEADING = 8
#: A component counts as without variance below this part of the greatest eigenvalue, times the dimension.
NOTHING = 4 * qdwh.EPS
ROWS = 1 << 14


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _entries(column: pa.Array, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All entries as doubles, null as NaN, and which vectors are whole."""
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    whole = lengths > 0
    whole[np.repeat(np.arange(len(lengths)), lengths)[~np.isfinite(flat)]] = False
    return flat, whole


def _numbers(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(which vectors of `size` entries are whole, their x as a matrix of longs)."""
    lengths = _lengths(column)
    flat, whole = _entries(column, lengths)
    whole &= lengths == size
    c = flat[np.repeat(whole, lengths)].reshape(-1, size)
    if c.size and np.abs(c).max() > 1 << 42:
        raise ValueError("an entry beyond 2**42 has no exact x")
    return whole, np.floor(SCALE * c).astype(np.int64) + SHIFT


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


SUMS = "size long, at int, n long, total decimal(38,0)"


def _sums(schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, tuple[int, list[int]]] = {}
    for batch in _pieces(batches):
        column = batch.column("v")
        for size in np.unique(_lengths(column)).tolist():
            if size and len(x := _numbers(column, size)[1]):
                n, before = totals.get(size, (0, [0] * size))
                totals[size] = (n + len(x), [a + b for a, b in zip(before, x.sum(0).tolist(), strict=True)])
    rows = [(size, at, n, total) for size, (n, sums) in totals.items() for at, total in enumerate(sums)]
    from decimal import Decimal

    yield record({"size": [r[0] for r in rows], "at": [r[1] for r in rows], "n": [r[2] for r in rows], "total": [Decimal(r[3]) for r in rows]}, schema)


class Mean:
    """The mean of the fit list, as its exact sums."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, sums

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if most < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviation(self, spread: np.ndarray) -> list[int]:
        most = int(np.abs(spread).max(initial=0))
        if spread.shape[1] * most * most < 1 << 63:
            return (spread * spread).sum(1).tolist()
        out = (spread.astype(object) ** 2).sum(1).tolist()
        if max(out) >= 1 << 63:
            raise ValueError("a deviation does not fit a long")
        return out

    def centred(self, spread: np.ndarray) -> np.ndarray:
        return spread.astype(float) / self.n


def fit_mean(vectors: DataFrame) -> Mean | None:
    """Count and sums of the whole vectors of a table with the column `v`; None if there are none."""
    found = vectors.mapInArrow(partial(_sums, arrow_schema(SUMS)), SUMS).groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    of: dict[int, list] = {}
    for r in found.collect():  # one row per dimension
        of.setdefault(r["size"], []).append((r["at"], r["n"], int(r["total"])))
    if not of:
        return None
    size = max(of, key=lambda s: (of[s][0][1], s))
    return Mean(of[size][0][1], [t for _, _, t in sorted(of[size])])


PRODUCTS = "at int, task long, line binary"


def _products(schema, mean: Mean, weights: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One matrix of a task: sums of products of its centred vectors, or of what `weights` make of them, and their sums."""
    total = None
    for batch in _pieces(batches):
        z = mean.centred(mean.spread(_numbers(batch.column("v"), len(mean.sums))[1]))
        z = z if weights is None else z @ weights
        part = np.vstack([z.T @ z, z.sum(0)])
        total = part if total is None else total + part
    if total is not None:
        yield record({"at": range(len(total)), "task": [TaskContext.get().partitionId()] * len(total), "line": [line.tobytes() for line in total]}, schema)


def _added(schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one number come together, ordered by task, so sums are the same in every run."""
    at, total = None, None
    for batch in batches:
        for here, line in zip(batch.column("at").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if at is not None and here != at:
                yield record({"at": [at], "line": [total.tobytes()]}, schema)
            line = np.frombuffer(line)
            total = total + line if here == at else line
            at = here
    if at is not None:
        yield record({"at": [at], "line": [total.tobytes()]}, schema)


def covariance(vectors: DataFrame, mean: Mean, weights: np.ndarray | None = None) -> np.ndarray:
    """Over the fit list, divisor n: of x, or of (x - mean) weights."""
    lines = vectors.mapInArrow(partial(_products, arrow_schema(PRODUCTS), mean, weights), PRODUCTS)
    ranged = lines.repartition("at").sortWithinPartitions("at", "task")
    schema = "at int, line binary"
    added = ranged.mapInArrow(partial(_added, arrow_schema(schema)), schema).collect()  # a line per dimension
    *rows, sums = [np.frombuffer(r["line"]) for r in sorted(added, key=lambda r: r["at"])]
    centre = sums / mean.n  # what rounding has left of the mean
    return np.array(rows) / mean.n - np.outer(centre, centre)


def _whiten(batch: pa.RecordBatch, mean: Mean, weights: np.ndarray, explained: list, error: float | None) -> dict:
    whole, x = _numbers(batch.column("v"), len(mean.sums))
    spread = mean.spread(x)
    white = mean.centred(spread) @ weights
    k = weights.shape[1]
    ids = batch.column("vec_id").filter(pa.array(whole))
    return {
        "vec_id": ids.take(pa.array(np.repeat(np.arange(len(ids)), k))),
        "component": np.tile(np.arange(1, k + 1), len(x)),
        "n": np.full(len(x) * k, mean.n),
        "deviation": np.repeat(np.array(mean.deviation(spread), np.int64), k),
        "whitened": pa.array(white.ravel(), mask=np.isnan(white.ravel())),
        "explained": explained * len(x),
        "identity_error": [error] * (len(x) * k),
    }


def whitening_report(embeddings: DataFrame, vector: str = "embedding", leading: int = LEADING) -> DataFrame:
    """A row for each whole vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = embeddings.select("vec_id", F.col(f"`{vector}`").alias("v"))
    schema = (f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    mean = fit_mean(rows.select("v"))
    if mean is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    weights, explained, error = fit(rows.select("v"), mean, leading)
    return map_arrow(rows, _whiten, schema, mean, weights, explained, error)


def fit(vectors: DataFrame, mean: Mean, leading: int = LEADING) -> tuple[np.ndarray, list, float | None]:
    """(weights of the leading components as columns, NaN where there is no variance; their part of it; identity error)."""
    v = covariance(vectors, mean)
    values, components = qdwh.eigen(v)
    k = min(leading, len(values))
    trace = float(np.trace(v))
    live = values[:k] > NOTHING * len(values) * max(values[0], 0.0)
    weights = np.full((len(values), k), np.nan)
    weights[:, live] = components[:, :k][:, live] / np.sqrt(values[:k][live])
    explained = [max(float(e), 0.0) / trace if live.any() else None for e in values[:k]]
    if not live.any():
        return weights, explained, None
    white = covariance(vectors, mean, weights[:, live])
    return weights, explained, float(np.abs(white - np.eye(int(live.sum()))).max())
