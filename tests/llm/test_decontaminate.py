import hashlib
import random
import re

from pyspark.sql import functions as F

from tarnspark.llm import decontaminate as D
from tarnspark.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, width=13):
    windows = {}
    for item, t in items:
        w = words(t)
        k = min(width, len(w))
        if item is not None:
            for i in range(len(w) - k + 1 if k else 0):
                windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                own = windows.get(tuple(w[i : i + k]))
                if own:
                    found |= own
                    hit |= set(range(i, i + k))
        names = ",".join(sorted(map(str, found)))
        out.append((repr(d), len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def run(spark, docs, items, monkeypatch=None, **bounds):
    for k, v in bounds.items():
        monkeypatch.setattr(D, k, v)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"shard": F.lit(1), "spans": F.lit(2), "item_ids": F.lit(3)})
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    found = D.contamination(d, b)
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    rows = found.select("doc_id", "n_words", "n_hit", F.size("item_ids").alias("n"), F.sha2(names.cast("binary"), 256).alias("s"), D.is_contaminated().alias("c")).collect()
    return sorted((repr(r[0]), *r[1:]) for r in rows)


def fixture():
    r = random.Random(4)
    vocab = ["the", "of", "a", "é", "Ünter"] * 3 + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.randrange(1, 40))) for i in range(25)] + [(100, ""), (101, None), (102, "..."), (None, text(20)), (103, "the " * 20), (104, "zebra"), (105, "THE-of; a")]
    docs = [(i, text(r.randrange(0, 50)) + r.choice(["", " ", "\n- "]) + r.choice([t or "" for _, t in items]).upper().replace("É", "é").replace("Ü", "Ü") + text(10)) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "?!"), (None, items[0][1]), (3, docs[3][1]), (3, docs[3][1]), (600, " ".join(t or "" for _, t in items) * 40)]
    return docs, items


def test_brute_force(spark):
    docs, items = fixture()
    assert run(spark, docs, items) == brute(docs, items)


def test_many_shards_and_blocks(spark, monkeypatch):
    docs, items = fixture()
    real_build, real_blocks = D.build_index, D.blocks
    monkeypatch.setattr(D, "build_index", lambda d: real_build(d, 300))
    monkeypatch.setattr(D, "blocks", lambda i: real_blocks(i, 60))
    assert run(spark, docs, items) == brute(docs, items)


def test_small_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((repr(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.op3_decontaminate(spark, sf).collect())
    assert got == brute(docs, items) and any(r[5] for r in got)


def test_empty_tables_and_stage(spark):
    docs, items = fixture()
    assert run(spark, docs[:3], []) == brute(docs[:3], []) and run(spark, [], items) == []
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("lang", F.lit("x"))
    kept = D.remove_contaminated(d, spark.createDataFrame(items, "item_id long, text string"))
    bad = {r[0] for r in brute(docs, items) if r[5]}
    assert kept.columns == d.columns and sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(i) for i, _ in docs if i is not None and repr(i) not in bad)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon"
    docs = [(1, "x alpha beta gamma delta epsilon"), (2, "alpha x beta gamma delta epsilon"), (3, "alpha x x x beta gamma delta epsilon"), (4, "epsilon delta gamma beta alpha"), (5, "alpha beta gamma delta"), (6, "epsilon")]
    index = D.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    [block] = D.blocks(spark.createDataFrame([(1, item)], "item_id int, text string"))
    near = lambda slop: {r.doc_id for r in D.search(index, block, slop=slop).collect()}
    assert near(0) == {1} and near(1) == {1, 2} and near(3) == {1, 2, 3}


def test_ids_that_are_no_numbers_and_chunks_of_long_items(spark, monkeypatch):
    real = D.item_chunks
    monkeypatch.setattr(D, "item_chunks", lambda items: real(items, chunk_words=7))
    docs, items = fixture()
    named = [(None if i is None else f"item-{i}", t) for i, t in items]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(named, "item_id string, text string")
    rows = D.contamination(d, b).select("doc_id", "n_words", "n_hit", F.size("item_ids").alias("n"), F.sha2(F.array_join(F.array_sort("item_ids"), ",").cast("binary"), 256).alias("s"), D.is_contaminated().alias("c")).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in rows) == brute(docs, named)


def test_very_long_text(spark):
    r = random.Random(9)
    long = " ".join(f"w{r.randrange(5000)}" for _ in range(400_000))
    items = [(1, " ".join(long.split()[200_000:200_040])), (2, "no such words here at all in any of the texts that are there")]
    got = D.contamination(spark.createDataFrame([(1, long), (2, "x")], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got} == {(1, 400_000, 40, ("1",)), (2, 1, 0, ())}
