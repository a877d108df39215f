import random

import numpy as np
from pyspark.sql import functions as F

from tarnspark.llm import near_dup as N
from tarnspark.llm.components import components
from tarnspark.llm.words import Hashes, fold_words


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment_against_dynamic_programming():
    r = np.random.default_rng(0)
    for _ in range(200):
        a = r.integers(0, 30, r.integers(0, 60)).astype(np.uint64)
        b = np.delete(a, r.integers(0, len(a), min(len(a), int(r.integers(0, 6))))) if len(a) else a
        if r.random() < 0.5:
            b = np.insert(b, r.integers(0, len(b) + 1), r.integers(0, 30))
        if r.random() < 0.2:
            b = r.permutation(b)
        common = lcs(a.tolist(), b.tolist())
        want = common / (len(a) + len(b) - common) if len(a) and len(b) else 0.0
        got = N.similarity(a, b)
        assert abs(got - (want if want >= 0.8 else 0.0)) < 1e-12


def corpus(seed=7, groups=12, size=6):
    r = random.Random(seed)
    words = [f"v{i}" for i in range(3000)]
    rows, i = [], 0
    for _ in range(groups):
        base = [r.choice(words) for _ in range(r.randrange(40, 200))]
        for _ in range(r.randrange(1, size)):
            w = list(base)
            for _ in range(r.randrange(0, max(1, len(w) // 60) + 1)):
                w[r.randrange(len(w))] = r.choice(words)
            rows.append((i, " ".join(w).capitalize() + r.choice(["", ".", "!"])))
            i += 1
    r.shuffle(rows)
    return rows


def brute(rows):
    cache = Hashes()
    g = {i: N.shingles(cache.of(fold_words(t))) for i, t in rows if i is not None}
    parent = {i: i for i in g}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(g)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(g[a]) and len(g[b]) and (N.similarity(g[a], g[b]) or np.array_equal(g[a], g[b])):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_classes_against_all_pairs(spark):
    rows = corpus() + [(900, None), (901, ""), (902, "..."), (903, "one two"), (904, "One, two"), (905, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("?"), "sketch": F.lit(1), "class_id": F.lit(2)})
    got = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_large_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 2)
    r = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(120))
    rows = [(i, passage + " " + " ".join(f"q{r.randrange(9**5)}" for _ in range(60))) for i in range(40)]
    for i in range(40, 60):  # copies of a hidden pair inside the large buckets
        w = rows[i % 7 + 3][1].split()
        w[r.randrange(150, 175)] = f"new{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_stage_and_edges(spark):
    rows = [(5, "a b c d e f g h"), (3, "a b c d e f g h"), (3, "a b c d e f g h"), (None, "a b c d e f g h"), (9, None), (10, "x y z x y z x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    assert sorted((r.doc_id or -1, r.class_id or -1) for r in N.near_duplicates(docs).collect()) == [(-1, -1), (3, 3), (3, 3), (5, 3), (9, 9), (10, 10)]
    out = N.keep_one(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [3, 9, 10]
    same = spark.createDataFrame([(1, "b c", "x", 1), (1, "a c", "z", 2), (1, "a c", "y", 3)], "doc_id long, text string, lang string, id int")
    assert [tuple(r) for r in N.keep_one(same).collect()] == [(1, "a c", "y", 3)]
    assert N.near_duplicates(docs.limit(0)).count() == 0 and N.keep_one(docs.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(2)
    chain = list(range(60))
    r.shuffle(chain)
    edges = list(zip(chain, chain[1:], strict=False)) + [(100, 101), (101, 102), (200, 200), (300, 301), (300, 301)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = {x.id: x.comp for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(60), 0), 100: 100, 101: 100, 102: 100, 300: 300, 301: 300, **dict.fromkeys(range(1000, 1050), 1000)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_pairs_lose_none(spark):
    r = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(40):
        w = passage + [f"q{r.randrange(60)}" for _ in range(r.randrange(4, 20))]
        rows.append((2 * i, " ".join(w)))
        if i % 2:
            w[r.randrange(len(w))] = f"new{i}"
        rows.append((2 * i + 1, " ".join(w[: len(w) - i % 3])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.a, x.b) for x in N.prefix_pairs(docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("comp")), docs).collect()}
    cache = Hashes()
    g = {i: N.shingles(cache.of(fold_words(t))) for i, t in rows}
    want = {(a, b) for a in g for b in g if a < b and N.similarity(g[a], g[b])}
    assert len(want) > 30 and want <= got and len(got) < len(g) * (len(g) - 1) // 2


def test_chain_beside_a_hub(spark):
    """The core's hub takes A, and B is similar to A alone."""
    r = random.Random(19)

    def new():
        return f"w{r.randrange(10**7)}"

    core = [new() for _ in range(300)]
    rows = []
    for _ in range(60):
        w = list(core)
        w[r.randrange(300)] = new()
        rows.append(w)
    a = list(core)
    for i in r.sample(range(150), 3):
        a[i] = new()
    b = list(a)
    for i in r.sample(range(150, 300), 6):
        b[i] = new()
    rows = [(i, " ".join(w)) for i, w in enumerate([*rows, a, b])]
    got = {x.doc_id: x.class_id for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) == dict.fromkeys(range(62), 0)


def test_tables_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """A group that shares a passage, most of it taken by no hub: every written table at two sizes."""
    real, rows = N.materialize, {}

    def counted(df, tag):
        out = real(df, tag)
        rows[tag] = rows.get(tag, 0) + out.count()
        return out

    monkeypatch.setattr(N, "materialize", counted)
    passage = " ".join(f"p{i}" for i in range(120))
    made = []
    for n in (150, 600):
        r = random.Random(n)
        docs = [(i, passage + " " + " ".join(f"q{r.randrange(9**5)}" for _ in range(r.randrange(10, 60)))) for i in range(n)]
        rows.clear()
        N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).count()
        made.append(dict(rows))
    assert made[1]["prefixes"] > 0
    assert all(made[1][t] <= 6 * max(made[0][t], 150) for t in made[1]), {t: (made[0][t], made[1][t]) for t in made[1]}


def test_very_long_text(spark):
    words = [f"w{i}" for i in range(300_000)]
    other = list(words)
    other[1000:3000] = [f"x{i}" for i in range(2000)]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:200_000]))]
    got = {x.doc_id: x.class_id for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
