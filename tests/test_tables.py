"""Snapshots, bucketed tables and summaries."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tarnspark.operators import summaries
from tarnspark.sources import buckets, snapshots


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ids(spark, a, b):
    return spark.range(a, b)


def test_versions_stay_readable(spark, tmp_path):
    t = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, t)
    assert [snapshots.replace(ids(spark, 0, 3), t), snapshots.append(ids(spark, 3, 5), t), snapshots.replace(snapshots.read(spark, t).where("id > 1"), t)] == [1, 2, 3]
    early = snapshots.read(spark, t, 1)
    assert [snapshots.read(spark, t, v).count() for v in (1, 2, 3)] == [3, 5, 3] and rows(snapshots.read(spark, t)) == [(2,), (3,), (4,)]
    with pytest.raises(ValueError):
        snapshots.append(spark.range(1).withColumnRenamed("id", "x"), t)
    assert snapshots.append(ids(spark, 0, 0), t) == 4 and rows(snapshots.read(spark, t)) == [(2,), (3,), (4,)]
    assert snapshots.vacuum(spark, t, keep=2) >= 2 and snapshots.versions(spark, t) == [3, 4]
    with pytest.raises(Exception):
        early.count()


def test_a_failed_job_leaves_the_table_as_it_was(spark, tmp_path):
    t = f"file://{tmp_path}/t"
    snapshots.replace(ids(spark, 0, 3), t)
    with pytest.raises(Exception):
        snapshots.replace(ids(spark, 0, 9).select(F.raise_error(F.lit("x")).cast("long").alias("id")), t)
    assert rows(snapshots.read(spark, t)) == [(0,), (1,), (2,)] and snapshots.versions(spark, t) == [1]


def test_two_writers_on_one_version(spark, tmp_path):
    """The second replacement from the same version is refused; appends go in one after the other, all of them."""
    t = f"file://{tmp_path}/t"
    base = snapshots.replace(ids(spark, 0, 1), t)
    assert snapshots.replace(ids(spark, 5, 6), t, base) == 2
    with pytest.raises(snapshots.Conflict):
        snapshots.replace(ids(spark, 7, 8), t, base)
    assert rows(snapshots.read(spark, t)) == [(5,)]
    threads = [threading.Thread(target=snapshots.append, args=(ids(spark, 10 * k, 10 * k + 2), t)) for k in range(1, 7)]
    [x.start() for x in threads], [x.join() for x in threads]
    assert snapshots.read(spark, t).count() == 13 and snapshots.versions(spark, t) == list(range(1, 9))


@pytest.fixture
def bucketed(spark, tmp_path):
    left = spark.range(1000).select((F.col("id") % 300).alias("key"), F.col("id").alias("n"))
    right = spark.range(0, 400, 2).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("v"))
    for name, df in (("bl", left), ("br", right)):
        buckets.write_bucketed(df, name, "key", 8, f"file://{tmp_path}/{name}")
    yield left, right
    for name in ("bl", "br"):
        spark.sql(f"DROP TABLE {name}")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_join_without_a_shuffle(spark, bucketed):
    left, right = bucketed
    got = buckets.lookup(spark, "bl", "br", "key")
    assert rows(got) == rows(left.join(right, "key", "left"))
    assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got)


def test_a_key_reads_one_bucket(spark, bucketed):
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan doesn't show the buckets it prunes
    got = buckets.one(spark, "br", "key", 42)
    assert rows(got) == [(42, "v42")] and "SelectedBucketsCount: 1 out of 8" in plan(got) and rows(buckets.one(spark, "br", "key", 43)) == []
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_totals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", "x", 4)], "p string, q string, n int")
    got = rows(summaries.totals(df, summaries.cube(["p", "q"]), {"n": F.sum("n")}))
    assert got == sorted([("a", None, 0, 1), ("a", "x", 0, 2), ("b", "x", 0, 4), ("a", None, 1, 3), ("b", None, 1, 4), (None, None, 2, 1), (None, "x", 2, 6), (None, None, 3, 7)], key=repr)
    assert summaries.rollup(["p", "q"]) == [["p", "q"], ["p"], []] and sorted(map(tuple, summaries.cube(["p", "q"]))) == [(), ("p",), ("p", "q"), ("q",)]
    assert "Expand" in summaries.totals(df, [["p"], []], {"n": F.count("*")})._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_within_their_bounds(spark):
    """Sketches of days give for any range what one of the whole range gives, and that is as near as promised."""
    rng = random.Random(7)
    data = [(d, rng.randrange(3000) if rng.random() < 0.5 else 7) for d in range(8) for _ in range(2500)]
    df = spark.createDataFrame(data, "day int, v long")
    some = df.where("day between 2 and 5")
    about = summaries.distinct_of(summaries.distinct_sketches(df, ["day"], "v").where("day between 2 and 5").withColumn("one", F.lit(1)), ["one"]).first()["about"]
    whole = summaries.distinct_of(summaries.distinct_sketches(some.withColumn("one", F.lit(1)), ["one"], "v"), ["one"]).first()["about"]
    exact = some.select("v").distinct().count()
    assert abs(about - exact) <= 6 * 0.83 / 64 * exact and abs(about - whole) <= 2
    exact = {r.v: r["count"] for r in some.groupBy("v").count().collect()}
    n = some.count()
    asked = some.select("v").distinct().unionByName(spark.createDataFrame([(10**9,)], "v long"))
    for width, depth in ((256, 3), (2048, 5)):
        months = summaries.count_sketches(df, ["day"], "v", width, depth)
        assert months.groupBy("day").count().agg(F.max("count")).first()[0] <= width * depth
        over = [r.about - exact.get(r.v, 0) for r in summaries.counts_of(months.where("day between 2 and 5"), asked, "v", width, depth).collect()]
        assert min(over) >= 0 and sum(x > 2.72 / width * n for x in over) <= len(over) * 2.72**-depth + 3
