"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes, modulo ``DIM``, of its words, its pairs of neighbours and the pairs with one or
two words between, each present or not. Labelled rows are hashed in distributed tasks; at most
``TRAIN_ROWS`` of them (the least hashes of doc_id) train one model with per-coordinate rates and an L1 term that
leaves a few thousand weights, which are broadcast to score every whole text. Labels, lang, source and
doc_id are never features.

Defined cases: null and empty texts have only the bias as a feature and get its score; null doc_ids count
as not held out, and null labels or labelled documents that are missing are left out of training; a
document with several labels takes the largest; without any labelled row all scores are 0.5, which is no
toxic verdict; repeated rows are scored one by one; a very long text is hashed whole; empty tables work on
either side; other columns, of whatever name, stay out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnspark.llm.common import materialize
from tarnspark.llm.words import Hashes, fold_words, mix

DIM, TRAIN_ROWS, EPOCHS = 1 << 22, 16_000, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.5
#: Features of fewer training rows get no weight; one row in CALIBRATE of the sample sets the scale and bias, unseen by the fit.
LEAST_ROWS, CALIBRATE = 4, 6
THRESHOLD = 0.7


def features(text: str | None, cache: Hashes, dim: int = DIM) -> np.ndarray:
    """Feature numbers of a text, with repeats. Number 0 is the bias."""
    w = cache.of(fold_words(text))
    parts = [mix(w, 1)]
    with np.errstate(over="ignore"):
        for gap in (1, 2, 3):
            if len(w) > gap:
                parts.append(mix(w[:-gap] * np.uint64(0x9E3779B97F4A7C15) + w[gap:], 1 + gap))
    return (np.concatenate(parts) % np.uint64(dim - 1)).astype(np.int32) + np.int32(1)


def fit(rows: list[np.ndarray], labels: list[int], dim: int = DIM, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights that are not zero."""
    z, n = np.zeros(dim), np.zeros(dim)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[(np.abs(zi) <= L1) & (at != 0)] = 0.0
        return w

    order = np.arange(len(rows))
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for i in order:
            at = rows[i]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    used = np.flatnonzero(n)
    w = weights(used)
    return used[w != 0].astype(np.int64), w[w != 0]


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the margins of rows that the fit did not see: logistic regression on one variable,
    with a weak pull towards scale 1, by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        v, r = p * (1 - p), p - labels
        grad = np.array([(r * margins).sum() + (a - 1), r.sum() + 0.01 * b])
        hess = np.array([[(v * margins**2).sum() + 1, (v * margins).sum()], [(v * margins).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.1), b


def model_of(rows: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights of the model for a sample of hashed rows."""
    count = np.zeros(DIM, np.int32)
    for r in rows:
        count[r] += 1
    keep = count >= LEAST_ROWS
    keep[0] = True
    number = np.flatnonzero(keep)
    place = (np.cumsum(keep) - 1).astype(np.int32)
    rows = [place[r[keep[r]]] for r in rows]
    y = np.array(labels, np.float64)
    held = np.arange(len(rows)) % CALIBRATE == 0
    at, w = fit([r for r, h in zip(rows, held, strict=True) if not h], y[~held].tolist(), len(number))
    dense = np.zeros(len(number))
    dense[at] = w
    if held.any() and len(set(y[held])) == 2:
        a, b = calibrate(np.array([dense[r].sum() for r, h in zip(rows, held, strict=True) if h]), y[held])
        dense *= a
        dense[0] += b
    used = np.flatnonzero(dense)
    return number[used], dense[used]


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _hash_rows(batches):
    cache = Hashes()
    for b in batches:
        rows = [np.unique(np.append(features(x, cache), np.int32(0))).tobytes() for x in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(rows, pa.binary())], ["doc_id", "toxic", "at"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS, rows_allowed: F.Column | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights from at most ``max_rows`` labelled rows. One task holds the hashed features of those; what
    comes back to the driver are the weights that are not zero."""
    allowed = ~held_out() if rows_allowed is None else rows_allowed
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(allowed).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hashed = materialize(slim.join(F.broadcast(known), "doc_id").mapInArrow(_hash_rows, "doc_id long, toxic int, at binary"), "hashed")  # at most max_rows rows

    def fit_all(batches):
        rows, y, ids = [], [], []
        for b in batches:
            rows += [np.frombuffer(x, np.int32) for x in b.column("at").to_pylist()]
            y += b.column("toxic").to_pylist()
            ids += b.column("doc_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (xxhash.xxh3_64_intdigest(str(ids[i])), rows[i].tobytes()))
        at, w = model_of([rows[i] for i in order], [y[i] for i in order]) if order else (np.empty(0, np.int64), np.empty(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w)], ["at", "w"])

    model = hashed.coalesce(1).mapInArrow(fit_all, "at long, w double").toPandas()
    return model["at"].to_numpy(np.int64), model["w"].to_numpy(np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], dim: int = DIM) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.int32), model[1].astype(np.float32)))

    def run(batches):
        at, w = shared.value
        dense = np.zeros(dim, np.float32)
        dense[at] = w
        bias, cache = float(dense[0]), Hashes()
        for b in batches:
            out = []
            for x in b.column("text").to_pylist():
                f = features(x, cache, dim)
                f = np.unique(f[dense[f] != 0])
                out.append(1 / (1 + np.exp(-np.clip(bias + float(dense[f].sum(dtype=np.float64)), -35, 35))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels, max_rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
