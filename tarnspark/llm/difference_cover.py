"""A suffix array as tables: the difference-cover algorithm with every sort, naming and merge done by Spark.

``ranks`` takes rows (pos, sym), pos from 0 without gaps and sym from 1, and gives (pos, rank) of every suffix. The suffixes at positions 1 and 2 modulo 3 are the
sample: their triples are sorted by range and equal ones get one name; while names repeat, the names in text order are a shorter text whose suffixes are ranked by
recursion. The other suffixes are then ordered by their symbol and the rank behind it, and both orders merge: every suffix gets keys by which suffixes of any two kinds
compare, namely (symbol, rank behind it) or (two symbols, rank behind them). A global number is a count of the rows of earlier ranges plus the place in a range, so no task holds a
whole order. Texts of up to ``SMALL`` symbols are sorted in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnspark.llm.common import drop, materialize
from tarnspark.llm.substrings import suffix_array

SMALL = 200_000


def _numbered(df: DataFrame, keys: list[str], distinct: bool) -> DataFrame:
    """``df`` with ``name``: from 1, the place of its keys in the order of all rows, one for equal keys if ``distinct``."""
    rows = df.select(*keys).distinct() if distinct else df
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed, "sorted")
    counts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    named = placed.join(F.broadcast(starts), F.shiftright("_at", 33) == F.col("_part")).select(*rows.columns, number.alias("name"))
    return df.join(named, keys) if distinct else named


def _small(text: DataFrame) -> DataFrame:
    def run(batches):
        table = pa.Table.from_batches(list(batches), schema=pa.schema([("pos", pa.int64()), ("sym", pa.int64())]))
        pos, sym = table.column("pos").to_numpy(), table.column("sym").to_numpy()
        order = suffix_array(sym[np.argsort(pos)])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rank))), pa.array(rank)], ["pos", "rank"])

    return text.select("pos", "sym").coalesce(1).mapInArrow(run, "pos long, rank long")


def ranks(text: DataFrame, small: int = SMALL) -> DataFrame:
    """(pos, rank), rank from 1, of every suffix of the text (pos, sym)."""
    text = text.select(F.col("pos").cast("long").alias("pos"), F.col("sym").cast("long").alias("sym"))
    n = text.count()
    if n <= small:
        return _small(text)
    at = lambda k, name: text.select((F.col("pos") - k).alias("pos"), F.col("sym").alias(name))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    # a sample that ends with a triple of padding where the last one would otherwise run on into the next part
    last = text.sparkSession.range(1).select(F.lit(n).cast("long").alias("pos"), F.lit(0).cast("long").alias("sym"))
    padded = text.unionByName(last) if n % 3 == 1 else text
    three = padded.join(at(1, "s1"), "pos", "left").join(at(2, "s2"), "pos", "left").select("pos", "sym", zero("s1"), zero("s2"))
    three = materialize(three, "triples")
    sample = materialize(_numbered(three.where("pos % 3 != 0"), ["sym", "s1", "s2"], True).select("pos", "name"), "names")
    ones = (n + 2) // 3 if n % 3 == 1 else (n + 1) // 3  # positions at 1 modulo 3, the padded one included
    place = F.when(F.col("pos") % 3 == 1, (F.col("pos") - 1) / 3).otherwise(ones + (F.col("pos") - 2) / 3).cast("long")
    total = sample.agg(F.count("*").alias("n"), F.max("name").alias("names")).first()
    if total.names < total.n:
        deep = ranks(sample.select(place.alias("pos"), F.col("name").alias("sym")), small).withColumnRenamed("pos", "place")
        sample_rank = sample.select("pos", place.alias("place")).join(deep, "place").select("pos", "rank")
    else:
        sample_rank = sample.select("pos", F.col("name").alias("rank"))
    sample_rank = materialize(sample_rank, "ranks")
    drop(sample)
    behind = lambda k, name: sample_rank.select((F.col("pos") - k).alias("pos"), F.col("rank").alias(name))
    rows = three.where(F.col("pos") < n).join(sample_rank, "pos", "left").join(behind(1, "r1"), "pos", "left").join(behind(2, "r2"), "pos", "left")
    rows = rows.select("pos", "sym", "s1", F.col("rank").alias("own"), zero("r1"), zero("r2"))
    # first among each other: sampled suffixes by their rank, the rest by (symbol, rank behind)
    rest = _numbered(materialize(rows.where("pos % 3 = 0"), "rest"), ["sym", "r1"], False).select("pos", "sym", "s1", "r1", "r2", F.col("name").alias("place"))
    out = _merged(materialize(rows.where("pos % 3 != 0"), "sample"), materialize(rest, "rest"))
    out = materialize(out, "suffixes")
    drop(three)
    drop(sample_rank)
    return out


def _merged(sample: DataFrame, rest: DataFrame) -> DataFrame:
    """Ranks in the merge: a suffix's place among its own kind plus how many of the other kind come before it. Those at 1 modulo 3 and the rest compare by
    (symbol, rank behind), those at 2 modulo 3 by (two symbols, rank behind them)."""
    first, second = sample.where("pos % 3 = 1"), sample.where("pos % 3 = 2")
    by_one = lambda df, kind: df.select("pos", F.lit(kind).alias("kind"), "sym", F.col("r1").alias("k1"), F.lit(0).cast("long").alias("k2"))
    by_two = lambda df, kind: df.select("pos", F.lit(kind).alias("kind"), "sym", F.col("s1").alias("k1"), F.col("r2").alias("k2"))
    ones = _ahead(by_one(first, 1).unionByName(by_one(rest, 0)))
    twos = _ahead(by_two(second, 1).unionByName(by_two(rest, 0)))
    of_rest = ones.where("kind = 0").select("pos", F.col("ahead").alias("a1")).join(twos.where("kind = 0").select("pos", F.col("ahead").alias("a2")), "pos")
    merged_rest = rest.join(of_rest, "pos").select("pos", (F.col("place") + F.col("a1") + F.col("a2")).alias("rank"))
    ahead = ones.where("kind = 1").unionByName(twos.where("kind = 1")).select("pos", "ahead")
    merged_sample = sample.join(ahead, "pos").select("pos", "own", "ahead")
    # ranks of the sample can have gaps only where a padded triple stands, which is the least of all
    merged_sample = merged_sample.select("pos", (F.col("own") - F.lit(_padded(sample)) + F.col("ahead")).alias("rank"))
    return merged_rest.unionByName(merged_sample)


def _padded(sample: DataFrame) -> int:
    """1 if the padded triple took the least rank, else 0."""
    return int(sample.agg(F.min("own").alias("n")).first().n or 1) - 1


def _ahead(rows: DataFrame) -> DataFrame:
    """pos, kind and ahead: how many rows of the other kind have smaller keys. Keys of two kinds are never equal."""
    keys = ["sym", "k1", "k2"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(2, np.int64)
        for b in batches:
            kind = b.column("kind").to_numpy()
            others = np.where(kind == 0, seen[1] + np.cumsum(kind == 1), seen[0] + np.cumsum(kind == 0))
            seen += np.bincount(kind, minlength=2)
            yield pa.RecordBatch.from_arrays([b.column("pos"), pa.array(kind.astype(np.int32)), pa.array(others), pa.array(np.full(len(kind), part, np.int32))], ["pos", "kind", "ahead", "part"])

    placed = materialize(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("pos", "kind").mapInArrow(run, "pos long, kind int, ahead long, part int"), "ahead")
    counts = placed.groupBy("part").agg(F.count_if(F.col("kind") == 0).alias("n0"), F.count_if(F.col("kind") == 1).alias("n1"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n0").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n1").over(before), F.lit(0)).alias("b1"))
    return placed.join(F.broadcast(starts), "part").select("pos", "kind", (F.col("ahead") + F.when(F.col("kind") == 0, F.col("b1")).otherwise(F.col("b0"))).alias("ahead"))
