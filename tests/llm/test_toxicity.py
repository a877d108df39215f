import math
import random
import re
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tarnspark.llm import toxicity as T


def corpus(n=1500):
    r = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        t = [r.choice(words) for _ in range(r.randrange(5, 60))]
        bad = r.random() < 0.2
        if bad:
            t.insert(r.randrange(len(t)), r.choice(["scum", "idiot"]))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(9000, None), (9001, ""), (None, "scum"), (0, rows[0][1])], "doc_id long, text string").withColumns({"score": F.lit("?"), "toxic": F.lit(1), "at": F.lit(1)})
    lab = spark.createDataFrame(labels + [(None, 1), (3, None), (77777, 1)], "doc_id long, toxic int").withColumn("text", F.lit("scum"))
    got = T.toxicity(docs, lab).collect()
    assert len(got) == len(rows) + 4
    y = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in y]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    hit = [r.predicted for r in held if y[r.doc_id]]
    false = [r.predicted for r in held if not y[r.doc_id]]
    assert sum(hit) / len(hit) > 0.9 and sum(false) / len(false) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    empty = {r.score for r in got if r.doc_id in (9000, 9001)}
    assert len(empty) == 1 and empty.pop() < 0.5


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in T.toxicity(docs, none).collect()] == [(0.5, 0)]
    assert T.toxicity(docs.limit(0), none).count() == 0


def test_held_out_labels_are_not_used(spark):
    rows, labels = corpus(300)
    flip = [(d, 1 - y if zlib.crc32(str(d).encode()) % 3 == 1 else y) for d, y in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (sorted(map(tuple, T.toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect())) for x in (labels, flip))
    assert a == b


def test_ftrl_is_sparse():
    r = np.random.default_rng(0)
    rows = [np.unique(np.append(r.integers(2, 5000, 40), [0] + [1] * (i % 2))) for i in range(400)]
    at, w = T.fit(rows, [i % 2 for i in range(400)], 5000)
    assert len(at) < 400 and dict(zip(at.tolist(), w.tolist(), strict=True))[1] > 1


def test_fit_against_plain_ftrl():
    """One row and one coordinate at a time, by the published update."""
    r = random.Random(4)
    rows = [np.array(sorted({0, *(r.randrange(1, 60) for _ in range(r.randrange(1, 12)))}), np.int32) for _ in range(300)]
    labels = [int(5 in x or r.random() < 0.1) for x in rows]
    dim, epochs = 60, 3
    z, n = [0.0] * dim, [0.0] * dim

    def weight(i):
        if i and abs(z[i]) <= T.L1:
            return 0.0
        return -(z[i] - math.copysign(T.L1, z[i]) * (z[i] != 0)) / ((T.BETA + math.sqrt(n[i])) / T.ALPHA + T.L2)

    order = np.arange(len(rows))
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for k in order:
            w = {int(i): weight(int(i)) for i in rows[k]}
            p = 1 / (1 + math.exp(-sum(w.values())))
            for i, wi in w.items():
                g = p - labels[k]
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / T.ALPHA
                z[i] += g - sigma * wi
                n[i] += g * g
    want = {i: weight(i) for i in range(dim) if n[i] and weight(i)}
    at, w = T.fit(rows, labels, dim, epochs)
    got = dict(zip(at.tolist(), w.tolist(), strict=True))
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want) and 5 in got and len(got) < dim


def test_very_long_text(spark):
    rows, labels = corpus(300)
    long = " ".join(f"w{i % 400}" for i in range(400_000))
    docs = spark.createDataFrame([*rows, (5000, long), (5001, long + " scum")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in T.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert 0 <= got[5000] <= 1 and got[5001] > got[5000]


def plain_features(text):
    """Numbers of words, neighbour pairs and pairs over one and two words, one at a time in whole numbers."""
    mask = 2**64 - 1

    def mixed(x, seed):
        x = (x + 0x9E3779B97F4A7C15 * (seed + 1)) & mask
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        return x ^ x >> 31

    words = re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    h = [xxhash.xxh3_64_intdigest(w) for w in words]
    out = {mixed(x, 1) for x in h}
    for gap in (1, 2, 3):
        out |= {mixed((a * 0x9E3779B97F4A7C15 + b) & mask, 1 + gap) for a, b in zip(h, h[gap:])}
    return {x % (T.DIM - 1) + 1 for x in out}


def test_every_score_against_plain_sums(spark):
    """The whole table's scores are those of the trained weights summed one feature at a time."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    at, w = T.train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    weight = dict(zip(at.tolist(), w.tolist(), strict=True))
    got = sorted((r.doc_id, r.score) for r in T.score(docs, (at, w)).collect())
    want = sorted((r.doc_id, 1 / (1 + math.exp(-(weight.get(0, 0.0) + sum(weight.get(f, 0.0) for f in plain_features(r.text)))))) for r in docs.collect())
    assert [d for d, _ in got] == [d for d, _ in want] and all(abs(a - b) < 1e-4 for (_, a), (_, b) in zip(got, want))
