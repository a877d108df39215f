"""Lookup tables that are bucketed and sorted by their key: joins of two of them need no shuffle, and a key reads one bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save ``df`` as table ``name`` in ``buckets`` buckets by ``key``. Rows are dealt to the buckets first, so that each is one file and stays sorted; tables that
    are joined have the same number of buckets. One bucket is one task of a join: size them for that."""
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def lookup(spark: SparkSession, asked: str, table: str, key: str, how: str = "left") -> DataFrame:
    """Table ``asked`` joined with table ``table`` by the key that both are bucketed by: a merge of buckets."""
    return spark.table(asked).join(spark.table(table).hint("merge"), key, how)


def one(spark: SparkSession, table: str, key: str, value) -> DataFrame:
    """The rows of one key, from the one bucket that can have them."""
    rows = spark.table(table)
    return rows.where(rows[key] == value)
