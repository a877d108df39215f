"""Sinks: CSV and Parquet, replaced as a whole or appended, and the review export."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnspark.functions import rules
from tarnspark.functions.reviews import to_cell
from tarnspark.sources.readers import LEAD, exists

REVIEW_TABLE = "row_idx int, " + LEAD.replace("google_page int", "google_page string") + ", " + ", ".join(
    f"{s}_rating float" + (f", {s}_reviews array<struct<author:string,rating:double,date:string,text:string>>" if has else "") for s, has, *_ in rules.SITES
) + ", created_at timestamp, updated_at timestamp"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single: bool = False) -> None:
    """A header and minimal quotes. ``single`` writes one file: only for exports that are meant to be one."""
    (df.coalesce(1) if single else df).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)


def append_leads(df: DataFrame, path: str) -> None:
    """Lead rows in column order; pages count from 1."""
    names = [c.split()[0] for c in LEAD.split(", ")]
    ready = df.withColumn("google_page", F.col("google_page") + 1)
    write_csv(ready.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names]), path, "append")


def append_reviews(df: DataFrame, path: str, inputs: list[str]) -> None:
    """Review rows in export order: null ratings empty, cells of reviews only for the sites that have them."""
    write_csv(df.select(*[export_column(df, h) for h in export_headers(inputs)]), path, "append")


def replace_parquet(df: DataFrame, path: str) -> None:
    """Replace a table, also one that ``df`` reads: written beside it whole, then renamed. Between the two renames readers find no table;
    if the second fails, the old one is put back."""
    spark = df.sparkSession
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    staged, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.{uuid.uuid4().hex}.old"
    df.write.parquet(staged)
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = exists(spark, path)
    if had and not fs.rename(Path(path), Path(old)):
        raise OSError(f"can't move {path}")
    if not fs.rename(Path(staged), Path(path)):
        if had:
            fs.rename(Path(old), Path(path))
        raise OSError(f"can't move {staged}")
    if had:
        fs.delete(Path(old), True)


def export_headers(inputs: list[str], sites=rules.SITES) -> list[str]:
    return ["_row_idx", *inputs, *[c for s, has, *_ in sites for c in ([f"{s}_rating", f"{s}_reviews"] if has else [f"{s}_rating"])]]


def export_column(df: DataFrame, name: str) -> Column:
    if name == "_row_idx":
        return F.col("row_idx").cast("string").alias(name)
    if name.endswith("_reviews"):
        return to_cell(F.col(name)).alias(name)
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def export(df: DataFrame, headers: list[str]) -> DataFrame:
    """The review table as text columns, by row: nulls empty, reviews cleaned and encoded."""
    return df.orderBy("row_idx").select(*[export_column(df, h) for h in headers])
