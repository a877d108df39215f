"""Broadcasts behind a count, and groups that are too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a lookup table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Rows of one group that one task may hold.
ROWS_IN_TASK = 1_000_000


def counted(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def hot_groups(df: DataFrame, keys: list[str], rows: int = ROWS_IN_TASK) -> DataFrame:
    """keys and ``parts`` (2 or more) of the groups with over ``rows`` rows; their number is that of all rows over ``rows`` at most."""
    counts = df.groupBy(*keys).count().where(F.col("count") > rows)
    return counts.select(*keys, F.ceil(F.col("count") / rows).cast("int").alias("parts"))


def time_pieces(df: DataFrame, keys: list[str], bin_: str, rows: int = ROWS_IN_TASK) -> DataFrame:
    """keys, ``bin_`` and ``piece`` for the bins of hot keys: consecutive bins fill a piece to about ``rows`` rows, and pieces count from 0 in the order of bins.
    Keys with no more than ``rows`` rows have no entry."""
    per_bin = df.groupBy(*keys, bin_).count()
    by_key = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("count").over(by_key.orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hot = per_bin.withColumn("_all", F.sum("count").over(by_key)).withColumn("_before", before).where(F.col("_all") > rows)
    return hot.select(*keys, bin_, F.floor(F.col("_before") / rows).cast("int").alias("piece"))
