"""Aggregates over several groupings at once, and mergeable sketches of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A count-min sketch of WIDTH counters in DEPTH rows is over by more than e / WIDTH of all rows with a chance of e ** -DEPTH at most.
WIDTH, DEPTH = 2048, 5


def totals(df: DataFrame, sets: list[list[str]], aggregates: dict[str, Column]) -> DataFrame:
    """Aggregates for each of several groupings in one pass: every dimension, null where a grouping leaves it out, and ``level``, whose bits (the first
    dimension highest) say which ones are left out, so that a null of the data stays apart. Spark expands rows before a partial aggregate."""
    dims = list(dict.fromkeys(d for s in sets for d in s))
    grouped = df.groupingSets([[F.col(d) for d in s] for s in sets], *[F.col(d) for d in dims])
    return grouped.agg(F.grouping_id().alias("level"), *[c.alias(n) for n, c in aggregates.items()]).select(*dims, "level", *aggregates)


def rollup(dims: list[str]) -> list[list[str]]:
    """All leading dimensions, from all to none."""
    return [dims[:n] for n in range(len(dims), -1, -1)]


def cube(dims: list[str]) -> list[list[str]]:
    """All subsets of the dimensions."""
    return [[d for i, d in enumerate(dims) if not n >> (len(dims) - 1 - i) & 1] for n in range(1 << len(dims))]


def distinct_sketches(df: DataFrame, by: list[str], value: str, log2: int = 12) -> DataFrame:
    """by and ``sketch``: a HyperLogLog sketch of the values of each group, a few kilobytes whatever their number; its error is about 0.83 / sqrt(2 ** log2)."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, log2).alias("sketch"))


def distinct_of(sketches: DataFrame, by: list[str]) -> DataFrame:
    """by and ``about``, the distinct values of all sketches of each group together."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))


def _cells(value: Column, width: int, depth: int) -> Column:
    return F.array(*[F.struct(F.lit(r).alias("r"), F.pmod(F.xxhash64(F.lit(r), value), F.lit(width)).cast("int").alias("c")) for r in range(depth)])


def count_sketches(df: DataFrame, by: list[str], value: str, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """by, r, c, n: a count-min sketch of each group as its counters, ``width * depth`` at most whatever the number of values. Sketches merge by adding counters."""
    return df.select(*by, F.inline(_cells(F.col(value), width, depth))).groupBy(*by, "r", "c").agg(F.count("*").alias("n"))


def counts_of(sketches: DataFrame, asked: DataFrame, value: str, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """asked (distinct values) with ``about``: no less than how often all sketches together have the value."""
    merged = sketches.groupBy("r", "c").agg(F.sum("n").alias("n"))
    cells = asked.select(value, F.inline(_cells(F.col(value), width, depth))).join(merged, ["r", "c"], "left")
    return cells.groupBy(value).agg(F.min(F.coalesce("n", F.lit(0))).alias("about"))
