"""PCA whitening of embeddings: a pivoted Cholesky factor of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries become whole numbers (256ths, rounded down), so that equal vectors are equal exactly; each distinct vector is fitted once. Tasks add up the
centred products of their share; what comes together is a matrix of the vectors' dimension squared, whatever the number of rows, and the
driver factors that. The norms of the rotated columns are square roots of eigenvalues, the columns themselves the components. All rows are
projected in a last pass.

Defined cases: rows whose vector is null or holds a null, NaN or infinite entry go; so do those of another length than most rows have (of equally
frequent lengths the longer one counts), empty vectors among them; an entry beyond a long saturates; a deviation beyond a long is null;
components of no variance are left out, so that one distinct vector gives no rows; repeated rows and ids give rows of their own, and a
null vec_id stays null; an empty table gives no rows; other columns, of whatever name, stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnspark.llm.common import materialize

COMPONENTS = 4
SCALE = 256
#: Sweeps of the Jacobi rotations; five to ten are needed.
SWEEPS = 40
_TWO_64, _TWO_63 = 1 << 64, 1 << 63


def whole(rows: DataFrame) -> DataFrame:
    """vec_id and x, the vector in whole 256ths, of rows that have one in full."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    odd = F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("e").isNotNull() & (F.size("e") > 0) & ~odd)
    return rows.select("vec_id", F.transform("e", lambda c: F.floor(c * SCALE)).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


class Centre:
    """The count n and sums S of the fit list. S / n is held as its floor and the rest, so that centred entries are as exact as doubles are."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, sums
        parts = [divmod(s, n) for s in sums]
        self.low = np.array([q for q, _ in parts], dtype=np.float64)
        self.rest = np.array([r / n for _, r in parts])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.low) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - S) ** 2: exact modulo 2 ** 64, which is all of it where it fits a long."""
        about = (self.centred(x) ** 2).sum(axis=1) * float(self.n) ** 2
        y = x.view(np.uint64) * np.uint64(self.n % _TWO_64) - np.array([s % _TWO_64 for s in self.sums], dtype=np.uint64)
        out: list[int | None] = (y * y).sum(axis=1, dtype=np.uint64).tolist()
        for i in np.flatnonzero(about > _TWO_63 * 0.999999):
            exact = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums)) if about[i] < _TWO_63 * 1.000001 else _TWO_63
            out[i] = exact if exact < _TWO_63 else None
        return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, l) with a[order][:, order] = l @ l.T, l lower trapezoidal; the largest diagonal left is the next pivot, and what is left at the end is rounding."""
    d = len(a)
    order, left, l = np.arange(d), a.diagonal().copy(), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(left[order[k:]]))
        if left[order[p]] <= least:
            return order, l[:, :k]
        order[[k, p]] = order[[p, k]]
        l[[k, p], :k] = l[[p, k], :k]
        l[k, k] = np.sqrt(left[order[k]])
        below = order[k + 1 :]
        l[k + 1 :, k] = (a[below, order[k]] - l[k + 1 :, :k] @ l[k, :k]) / l[k, k]
        left[below] -= l[k + 1 :, k] ** 2
    return order, l


def jacobi(w: np.ndarray) -> np.ndarray:
    """The columns of w rotated against each other until they are orthogonal: disjoint pairs at once, all pairs in a sweep."""
    d, r = w.shape
    w = np.hstack([w, np.zeros((d, r % 2))])
    m = w.shape[1]
    seats, enough = np.arange(m), 2 * np.finfo(float).eps * np.sqrt(d)
    for _ in range(SWEEPS):
        turned = False
        for _ in range(m - 1):
            i, j = seats[: m // 2], seats[m // 2 :][::-1]
            a, b = w[:, i], w[:, j]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            turn = np.abs(ab) > enough * np.sqrt(aa * bb)
            if turn.any():
                turned = True
                zeta = np.where(turn, (bb - aa) / (2 * np.where(turn, ab, 1.0)), 0.0)
                t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
                c = 1 / np.hypot(1.0, t)
                w[:, i], w[:, j] = c * a - c * t * b, c * t * a + c * b
            seats[1:] = np.roll(seats[1:], 1)
        if not turned:
            break
    return w[:, :r]


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance v, falling, and the unit components as columns; the largest entry of each is positive."""
    order, l = pivoted_cholesky(v)
    if not l.shape[1]:
        return np.zeros(0), np.zeros((len(v), 0))
    w = jacobi(l)
    values = (w * w).sum(axis=0)
    falling = np.argsort(-values, kind="stable")
    unit = np.zeros_like(w)
    unit[order] = (w / np.sqrt(values))[:, falling]
    top = np.abs(unit).argmax(axis=0)
    return values[falling], unit * np.sign(unit[top, np.arange(len(top))])


def _added(rows: DataFrame) -> list[np.ndarray]:
    """Rows (i, cells: doubles as bytes) of the tasks, summed by i."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, dtype=np.float64) for b in table["cells"].to_pylist())
        return pa.table({"i": table["i"][:1], "cells": [total.tobytes()]}, schema=pa.schema([("i", pa.int32()), ("cells", pa.binary())]))

    got = rows.groupBy("i").applyInArrow(add, "i int, cells binary").orderBy("i").collect()
    return [np.frombuffer(r["cells"], dtype=np.float64) for r in got]


def _partial(rows: DataFrame, products) -> DataFrame:
    """A matrix of each task: the sum of ``products`` of its batches' vectors, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                new = products(_matrix(batch))
                total = new if total is None else total + new
        if total is not None:
            yield pa.record_batch({"i": pa.array(range(len(total)), pa.int32()), "cells": pa.array([r.tobytes() for r in total], pa.binary())})

    return rows.mapInArrow(run, "i int, cells binary")


def whiten(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component up to ``k``."""
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = whole(rows)
    length = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if not length:
        return spark.createDataFrame([], schema)
    x = x.where(F.size("x") == length["d"])
    fit = materialize(x.select("x").distinct(), "fit")
    cells = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("c").cast("decimal(19,0)")).alias("s")).orderBy("i").collect()
    centre = Centre(cells[0]["n"], [int(c["s"]) for c in cells])

    def scatter(m: np.ndarray) -> np.ndarray:
        y = centre.centred(m)
        return y.T @ y

    v = np.array(_added(_partial(fit, scatter))) / centre.n
    values, unit = components(v)
    k = min(k, len(values))
    if not k:
        return spark.createDataFrame([], schema)
    project = unit[:, :k] / np.sqrt(values[:k])
    explained = values[:k] / v.trace()

    def moments(m: np.ndarray) -> np.ndarray:
        z = centre.centred(m) @ project
        return np.vstack([z.sum(axis=0), z.T @ z])

    mean, *square = np.array(_added(_partial(fit, moments))) / centre.n
    error = float(np.abs(np.array(square) - np.outer(mean, mean) - np.eye(k)).max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.num_rows
            if not b:
                continue
            m = _matrix(batch)
            z = centre.centred(m) @ project
            each = pa.array(np.repeat(np.arange(b), k))
            yield pa.record_batch({
                "vec_id": batch.column(0).take(each), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b)), "n": pa.array(np.full(b * k, centre.n)),
                "deviation": pa.array(centre.deviations(m), pa.int64()).take(each), "whitened": pa.array(z.ravel()), "explained": pa.array(np.tile(explained, b)), "identity_error": pa.array(np.full(b * k, error)),
            })

    return x.mapInArrow(out, schema)
