"""Groups of N and 4N rows under one key: results stay, and no task holds the group."""

import random

import pytest
from pyspark.sql import functions as F
from test_near_dup import brute, corpus

from tarnspark.llm import components as K
from tarnspark.llm import near_dup as N
from tarnspark.llm.common import salted_join


@pytest.fixture
def plain(spark):
    """Joins shuffle, and partitions are what the join dealt."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("n", [2000, 8000])
def test_largest_task_of_a_join(spark, plain, n):
    rows = spark.range(n + 100).select(F.when(F.col("id") < n, 7).otherwise(F.col("id")).alias("key"), "id")
    one = spark.range(n + 100).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("v"))
    largest = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    whole, dealt = rows.join(one, "key"), salted_join(rows, one, "key", "id", 100)
    assert largest(whole) >= n and largest(dealt) <= n / 3
    assert sorted(map(tuple, dealt.select("key", "id", "v").collect())) == sorted(map(tuple, whole.select("key", "id", "v").collect()))
    some = one.where("key > 9")
    assert salted_join(rows, some, "key", "id", 100, "left").where("v is null").count() == n
    assert salted_join(rows, one, "key", "id", 10**6).count() == n + 100


@pytest.mark.parametrize("n", [200, 800])
def test_components_with_a_hot_node(spark, monkeypatch, n):
    """A star around the least node, one around the greatest, and a chain between them."""
    monkeypatch.setattr(K, "NODE_ROWS", 20)
    edges = [(0, i) for i in range(1, n)] + [(10**6, 10_000 + i) for i in range(n)] + [(20_000 + i, 20_001 + i) for i in range(30)] + [(20_000, 5), (20_030, 10_007), (50_000, 50_001)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.comp for r in K.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 50_000 if i >= 50_000 and i != 10**6 else 0 for e in edges for i in e}


def test_near_duplicates_with_hot_hubs(spark, monkeypatch):
    monkeypatch.setattr(N, "TEXT_PAIRS", 3)
    monkeypatch.setattr(K, "NODE_ROWS", 3)
    rows = corpus(groups=3, size=40)
    got = {r.doc_id: r.class_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
