"""First, best and latest rows by key, with total orders so that results never depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key. ``row_number() <= n`` lets Spark keep n rows a key before the shuffle (WindowGroupLimit)."""
    name = rank or "_rank_in_key"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_keys(df: DataFrame, key: Column, ordinal: str, name: str = "key") -> DataFrame:
    """Distinct values with the least ordinal each was seen at: an ordered distinct as one aggregate, without a sort."""
    return df.select(key.alias(name), ordinal).groupBy(name).agg(F.min(ordinal).alias(ordinal))


def latest_by(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """The values of ``columns`` in each key's last row, and its row count, by one partial aggregate. ``order`` must be total in a key."""
    last = F.max(F.struct(*order, *columns))
    return df.groupBy(*keys).agg(last.alias("_last"), F.count("*").alias("n")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in dict.fromkeys([*order, *columns])], "n")


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """A global top-n; Spark plans TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)


def first_level(df: DataFrame, keys: list[str], level: str, order: list[Column], n: int) -> DataFrame:
    """Only rows of the least ``level`` a key has, at most ``n`` of them: the first query with any result wins."""
    best = F.min(level).over(Window.partitionBy(*keys))
    return first_by(df.withColumn("_least_level", best).where(F.col("_least_level") == F.col(level)).drop("_least_level"), keys, order, n)


def nest_top(df: DataFrame, keys: list[str], order: list[Column], fields: list[str], n: int, name: str) -> DataFrame:
    """The first ``n`` rows of each key as an array of structs in order."""
    ranked = first_by(df, keys, order, n, rank="_place")
    nested = F.array_sort(F.collect_list(F.struct("_place", *fields)))
    return ranked.groupBy(*keys).agg(F.transform(nested, lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias(name))


def outcome_counts(df: DataFrame, outcome: str, prefixes: dict[str, str]) -> DataFrame:
    """One row of counters by the prefix of an outcome; ``other`` counts the rest."""
    c = F.col(outcome)
    known = F.lit(False)
    for p in prefixes.values():
        known = known | F.coalesce(c.startswith(p), F.lit(False))
    return df.agg(*[F.count_if(c.startswith(p)).alias(n) for n, p in prefixes.items()], F.count_if(~known).alias("other"))


def most_common(df: DataFrame, values: Column, n: int) -> DataFrame:
    """The ``n`` most frequent elements of an array column, ties by value."""
    return top_n(df.select(F.explode(values).alias("value")).groupBy("value").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("value")], n)
