import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarnspark.llm import mixing as M


def brute_shares(sizes, total):
    """Targets by trying the sources that are full in order of weight needed."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full and sizes[s] > 0]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            return {s: share.get(s, 2.0 * sizes[s] if s in full else 0.0) for s in order}
        full |= over


def check(spark, docs):
    got = M.mix(docs).collect()
    rows = docs.select("doc_id", "text", "source").collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r["size"]) for r in got) == sorted((r.doc_id if r.doc_id is not None else -1, size(r.text)) for r in rows)
    per = defaultdict(int)
    for r in rows:
        per[r.source] += size(r.text)
    want = brute_shares(per, 1.5 * sum(per.values())) if sum(per.values()) else dict.fromkeys(per, 0.0)
    taken, largest = defaultdict(int), defaultdict(int)
    source = {r.doc_id: r.source for r in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == per[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
    for s in per:
        assert abs(taken[s] - want[s]) <= largest[s]
    return got


def test_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = check(spark, docs)
    b = M.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_edges(spark):
    rows = [(i, "w " * (i % 7), ["a", "b", None, "é"][i % 4]) for i in range(200)] + [(500, None, "z"), (501, "", "z"), (600, "one two", "a"), (600, "one two", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit("?"), "target": F.lit("?"), "copies": F.lit(0)})
    check(spark, docs)
    assert M.mix(docs.limit(0)).count() == 0
    out = M.apply_mix(docs)
    assert out.columns == docs.columns and out.groupBy("doc_id", "text").count().where("count > 4").count() == 0
    nulls = spark.createDataFrame([(None, "a b", "s"), (1, "a b c", "s")], "doc_id long, text string, source string")
    assert M.mix(nulls).count() == 2


def targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    return {r.source: r.target for r in M.targets(spark.createDataFrame(rows, "source string, size long")).collect()}


def test_targets_against_trial_and_error(spark):
    assert targets(spark, {"a": 0, "b": 10}) == {"a": 0.0, "b": 15.0}
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 7, "b": 90, "c": 1000, "d": 3, None: 5, "é": 0, "Z": 12}, {"a": 1}, {f"s{i}": i * i % 97 for i in range(300)}):
        want = brute_shares(sizes, 1.5 * sum(sizes.values()))
        got = targets(spark, sizes)
        assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def brute_shares_of(sizes, target):
    """Copies to be had of each document: its weight's share of the target, two at most, by trying."""
    weight = [16 + len(bin(n)) - 2 for n in sizes]
    full = set()
    while True:
        left = target - 2 * sum(sizes[i] for i in full)
        free = sum(weight[i] * sizes[i] for i in range(len(sizes)) if i not in full)
        e = [2.0 if i in full else weight[i] * left / free if free else 0.0 for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in full and e[i] >= 2}
        if not over:
            return e
        full |= over


def brute_pareto(rows, goal):
    """number -> copies by sorting each source by random odds over inclusion odds. rows: (number, source, size, u)."""
    out = {}
    for s, (_, target) in goal.items():
        mine = [r for r in rows if r[1] == s]
        e = brute_shares_of([r[2] for r in mine], target)
        certain = [int(x + 1e-12) for x in e]
        out |= {r[0]: c for r, c in zip(mine, certain)}
        need = target - sum(c * r[2] for r, c in zip(mine, certain))
        if need < 0.5:
            continue
        rank = {}
        for r, x, c in zip(mine, e, certain):
            p = x - c
            if c < 2 and p > 1e-12:
                rank.setdefault(round((r[3] / (1 - r[3])) / (p / (1 - p)), 12), []).append(r)
        upto = 0
        for x in sorted(rank):
            words = sum(r[2] for r in rank[x])
            upto += words
            if upto - words / 2 <= need:
                for r in rank[x]:
                    out[r[0]] += 1
    return out


@pytest.mark.parametrize("slices", [2, 256])
def test_pareto_order_against_sorting(spark, monkeypatch, slices):
    """Whole sources sorted by rank, with repeated rows; two slices a level leave many rows to the last sort."""
    monkeypatch.setattr(M, "SLICES", slices)
    rows = [(i, "w " * (i * 13 % 29), f"s{i % 7 if i % 3 else 0}") for i in range(900)] + [(2000, "a b c " * 50, "one"), (3000, "x y", None), (3001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    twice = docs.unionByName(docs.where("doc_id % 10 = 0"))  # repeated rows tie
    for d in (docs, twice):
        got = M.plan(d).collect()
        goal = {r.source: (r.source_size, r.target) for r in got}
        numbered = [(i, r.source, r["size"], r.u) for i, r in enumerate(got)]
        want = brute_pareto(numbered, goal)
        assert {i: r.copies for i, r in enumerate(got)} == want
        ranked = [r for r in got if r["rank"] is not None and r.source == "s0"]
        assert len({r.p for r in ranked}) > 2 and [r.doc_id for r in sorted(ranked, key=lambda r: r["rank"])] != [r.doc_id for r in sorted(ranked, key=lambda r: r.u)]
        by = {}
        for r in got:
            assert by.setdefault(r.doc_id, r.copies) == r.copies


def test_very_long_text_and_one_hot_source(spark):
    rows = [(i, "w " * (400_000 if i == 5 else 3), "hot") for i in range(300)] + [(1000 + i, "v v v v", f"s{i}") for i in range(5)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"))


def test_copies_follow_the_inclusion_probability(spark):
    """A source at 1.5 copies: the mean copies of short and of long documents over many draws are near what is to be had of each, and long ones get more."""
    rows = [(i, "w " * (3 if i % 4 else 150), "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    e = brute_shares_of([3 if i % 4 else 150 for i in range(400)], 1.5 * (300 * 3 + 100 * 150))
    copies = defaultdict(list)
    for seed in range(6):
        for r in M.plan(docs, seed).collect():
            copies[r["size"]].append(r.copies)
    for n, at in ((3, 1), (150, 0)):
        assert abs(sum(copies[n]) / len(copies[n]) - e[at]) < 0.06
    assert e[0] > e[1]
