"""The manifest against a plain tree, in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tarnspark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, arity):
    """The top, and for each leaf the list of (before, after)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // arity * arity : p // arity * arity + arity]
            proofs[i].append(("".join(run[: p % arity]), "".join(run[p % arity + 1 :])))
        nodes = [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        at = [p // arity for p in at]
    return nodes[0], proofs


def brute(rows, arity=3):
    by, out = {}, []
    for r in rows:
        by.setdefault(r[1], []).append((h(*map(value, r)), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, proofs = {}, {}
    for s in names:
        by[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        tops[s], proofs[s] = tree([x[0] for x in by[s]], arity)
    root, above = tree([tops[s] for s in names], arity)
    for s, up in zip(names, above):
        for (leaf, r), proof in zip(by[s], proofs[s]):
            node, path = leaf, proof + up
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4]:
                node = h(*map(value, (*r[:4], r[4].replace("\n", ""))))
            for before, after in path:
                node = h(before, node, after)
            out.append((r[0], leaf, tops[s], root, h(*[b + a for b, a in path]), node, node == root))
    return sorted(out, key=repr)


def got(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        df = df.withColumns({"leaf": F.lit("x"), "place": F.lit(1), "tree": F.lit(2), "root": F.lit("y"), "digest": F.lit(3)})
    found = merkle.audit(df).select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "folded_root", "verified")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_trees_of_many_sizes(spark):
    rng = random.Random(1)
    rows = [(i, s, "en", None if i % 7 == 0 else i, f"text {i}\nand é {rng.random()}\n") for s, n in zip([None, "", "a", "b", "é", "z", "zz"], [1, 2, 3, 4, 9, 10, 29]) for i in rng.sample(range(1000), n)]
    want = brute(rows)
    assert got(spark, rows) == want and {w[-1] for w in want} == {True, False}


def test_odd_rows(spark):
    rows = [(1, "a", None, None, None), (1, "a", None, None, None), (1, "a", "x", 3, "t\n"), (None, "a", "x", 3, "t\n"), (None, None, None, None, None), (2, None, "-", 0, ""), (-5, "b", "1:2", 1, "\n"), (6, "c", "en", 9, "long\n" * 200_000)]
    assert got(spark, rows, extra=True) == brute(rows)


@pytest.mark.parametrize("n", [1, 2])
def test_lone_rows(spark, n):
    rows = [(i, "s", "en", 1, "a\nb") for i in range(n)]
    assert got(spark, rows) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == []


def test_binary_runs_are_the_xor_of_places(spark):
    rows = [(i, "s", "en", 1, str(i)) for i in range(11)]
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), arity=2).collect()
    top, proofs = tree([h(*map(value, r)) for r in rows], 2)
    assert {r.root for r in found} == {top} and {r.doc_id: [tuple(s) for s in r.proof] for r in found} == dict(enumerate(proofs))


def test_hot_source_is_spread(spark):
    """A source with nearly all rows: the joins of a level are dealt by runs, so no task has more than a share of it."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3900, "hot").otherwise("x").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.col("id").cast("string").alias("text"))
    leaves = rows.select("doc_id", "source", merkle.leaf().alias("digest"))
    placed = merkle._placed(leaves.repartition(8), "source", ["doc_id"], "t")
    assert [tuple(r) for r in placed.groupBy("source").agg(F.min("place"), F.max("place"), F.max("size")).orderBy("source").collect()] == [("hot", 0, 3899, 3900), ("x", 0, 99, 100)]
    spread = merkle._runs(placed, 3).groupBy(F.spark_partition_id().alias("p")).count()
    assert spread.agg(F.max("count")).first()[0] < 2500 or spread.count() == 1
