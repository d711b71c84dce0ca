"""Whitening of embeddings on their leading components, the eigenvectors found by spectrum slicing.

Counts, sums and the covariance are taken over the distinct quantised vectors, a few numbers for each task and
dimension. Only what has the size of the dimensions, never of the rows, meets the driver: the sums, the covariance and
the eigenvectors. How white the result is, is measured over the whole list in a pass of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.spectrum import leading
from wattloom.sources.tables import stage

SCALE, COMPONENTS = 256, 4
# Partial sums are added in groups of so many tasks, then once more.
BINS = 64

_TOTALS = "at int, n bigint, total decimal(38,0), top bigint"
_ROWS = "at int, bin int, sums array<double>"
_WHITE = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

_LONG = 1 << 63


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of every entry; null for a vector that is null, empty or has an unusable entry."""
    doubles = vector.cast("array<double>")
    usable = F.forall(doubles, lambda c: F.coalesce(F.abs(c * F.lit(float(scale))) < F.lit(2.0**62), F.lit(False)))
    return F.when(usable & (F.size(doubles) > 0), F.transform(doubles, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")))


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _totals(size: int):
    """Number, exact sums and largest absolute entry of each dimension."""

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, top = 0, [0] * size, [0] * size
        for batch in batches:
            x = _matrix(batch.column(0), size)
            if not len(x):
                continue
            high = np.abs(x).max(axis=0)
            found = x.sum(axis=0) if int(high.max()) * len(x) < _LONG else x.astype(object).sum(axis=0)
            n, sums, top = n + len(x), [a + int(b) for a, b in zip(sums, found)], [max(a, int(b)) for a, b in zip(top, high)]
        if n:
            columns = [pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)), pa.array(top, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "n", "total", "top"])

    return totals


def _products(centre: np.ndarray, project: np.ndarray | None):
    """Sums of products of the centred vectors, or of their projections, and in a last column the sums themselves."""

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            y = _matrix(batch.column(0), len(centre)) - centre
            y = y if project is None else y @ project
            part = np.concatenate([y.T @ y, y.sum(axis=0)[:, None]], axis=1)
            found = part if found is None else found + part
        if found is not None:
            size = len(found)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * (size + 1)), pa.array(found.ravel()))
            bins = np.full(size, TaskContext.get().partitionId() % BINS, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(bins), lists], names=["at", "bin", "sums"])

    return products


def _add(table: pa.Table) -> pa.Table:
    sums = np.array(table["sums"].to_pylist()).sum(axis=0)
    return table.slice(0, 1).set_column(2, table.schema.field("sums"), pa.array([sums.tolist()], table.schema.field("sums").type))


def _covariance(fit: DataFrame, n: int, centre: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance of the fit list, or of its projections, with divisor n."""
    partial = fit.mapInArrow(_products(centre, project), _ROWS)
    binned = partial.groupBy("at", "bin").applyInArrow(_add, _ROWS)
    summed = binned.groupBy("at").applyInArrow(_add, _ROWS)
    size = len(centre) if project is None else project.shape[1]
    found = np.zeros((size, size + 1))
    for row in summed.collect():  # a row for each dimension
        found[row["at"]] = row["sums"]
    mean = found[:, -1] / n
    return found[:, :-1] / n - np.outer(mean, mean)


def _whiten(n: int, sums: list[int], top: int, project: np.ndarray, explained: np.ndarray, error: float):
    """Rows of (vec_id, component) for the batches of (vec_id, x)."""
    size, k = project.shape
    centre, total = np.array([s / n for s in sums]), np.array(sums, object)
    exact = size * (n * top + max(map(abs, sums))) ** 2 < _LONG

    def deviations(x: np.ndarray) -> pa.Array:
        if exact:
            y = n * x - total.astype(np.int64)
            return pa.array((y * y).sum(axis=1))
        y = n * x.astype(object) - total
        return pa.array([v if v < _LONG else None for v in (y * y).sum(axis=1)], pa.int64())

    def whiten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), size)
            rows = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column(0).take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), n)),
                deviations(x).take(pa.array(rows)),
                pa.array(((x - centre) @ project).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return whiten


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row and component.

    A row is usable if its vector is neither null nor empty, has only finite entries (256 times an entry below
    2^62, else it counts as infinite) and is as long as most of the distinct vectors, the shorter length on a tie.
    Entries become x = floor(256 * entry). The fit list has every distinct x vector once: n of them with sums S.
    Components are those of its covariance with the largest eigenvalues, from 1 on; those without
    variance don't exist, so copies of one vector give no rows, as an empty table does. whitened is x - S / n on the
    component, over the root of its eigenvalue; deviation is the sum of (n * x - S)^2, exact, and null
    where it doesn't fit a long; explained the eigenvalue over the trace; identity_error the largest entry of the
    whitened fit list's covariance less the identity. Repeated rows and null identifiers each give their rows.
    Other columns aren't read.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(F.col(vector_col), scale).alias("x")).where("x IS NOT NULL")
    fit = stage(rows.select("x").distinct(), "distinct-vectors")
    lengths = fit.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), "size").first()
    nothing = rows.sparkSession.createDataFrame([], _WHITE)
    if first is None:
        return nothing
    size, n = first["size"], first["n"]
    usable = F.size("x") == size
    fit, rows = fit.where(usable), rows.where(usable)

    totals = fit.mapInArrow(_totals(size), _TOTALS).groupBy("at").agg(F.sum("total").alias("total"), F.max("top").alias("top")).collect()
    sums = [int(r["total"]) for r in sorted(totals, key=lambda r: r["at"])]
    centre = np.array([s / n for s in sums])
    covariance = _covariance(fit, n, centre)
    values, axes = leading(covariance, components)
    if not len(values):
        return nothing
    project = (axes / np.sqrt(values)[:, None]).T
    error = float(np.abs(_covariance(fit, n, centre, project) - np.eye(len(values))).max())
    made = _whiten(n, sums, max(r["top"] for r in totals), project, values / np.trace(covariance), error)
    return rows.mapInArrow(made, _WHITE)
