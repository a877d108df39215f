"""Work units: keywords x locations x pages, less what is completed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnspark.functions.text import strip


def seed_lists(seed: DataFrame, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """The two independent lists of a seed table: trimmed, blanks dropped, distinct, with the ordinal of the first sight."""

    def column(name, out):
        return seed.select(strip(F.col(name)).alias(out), ordinal).where(F.col(out) != "").groupBy(out).agg(F.min(ordinal).alias(f"{out}_at"))

    return column("keywords", "keyword"), column("locations", "location")


def work_units(keywords: DataFrame, locations: DataFrame, pages: int = 50, completed: DataFrame | None = None) -> DataFrame:
    """keyword, location, page (from 0). The key stays three columns, so no separator can break it."""
    units = keywords.crossJoin(locations).crossJoin(keywords.sparkSession.range(pages).select(F.col("id").cast("int").alias("page")))
    return units if completed is None else units.join(completed.select("keyword", "location", "page"), ["keyword", "location", "page"], "left_anti")


def shuffled(units: DataFrame, seed: int = 0) -> DataFrame:
    """The units in a random order that a seed repeats; ``place`` is their sort key."""
    return units.withColumn("place", F.xxhash64(F.lit(seed), *units.columns)).orderBy("place", *units.columns)


def unit_status(log: DataFrame) -> DataFrame:
    """The status of each unit from a log of (keyword, location, page, status, seq): a completed unit leaves the failed ones."""
    done = F.max(F.col("status") == "completed")
    return log.groupBy("keyword", "location", "page").agg(F.when(done, "completed").otherwise(F.max_by("status", "seq")).alias("status"))


def failed_units(log: DataFrame) -> DataFrame:
    """The units of a second pass."""
    return unit_status(log).where("status = 'failed'").select("keyword", "location", "page")


def page_status(attempts: DataFrame, threshold: int = 3) -> DataFrame:
    """Status of each page from its attempts (page, blocked boolean, urls int): blocked from ``threshold`` blocked attempts on."""
    found = F.coalesce(F.max("urls"), F.lit(0)) > 0
    return attempts.groupBy("page").agg(F.count("*").alias("attempts"), F.count_if("blocked").alias("blocked"), F.when(found, "ok").when(F.count_if("blocked") >= threshold, "blocked").otherwise("empty").alias("status"))
