"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents; the mixing stage returns a row for
each copy it takes, and the last returns what is read back from the token files. Documents without a doc_id go at the first stage,
since no verdict can name them; null texts count as empty, null languages and sources are groups of their own; repeated rows share a fate in every stage, and of
different rows with one doc_id quality keeps all or none; ties go by the operators' rules; very long texts are worked on whole; an empty table goes through empty; extra columns, of whatever name,
are carried along to the mixing stage and stay out of the last. The method's hashes and sketches aren't expressible in SQL, so
ORACLE_SQL is None and tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnspark.llm import decontaminate, mixing, near_dup, quality, tokens
from tarnspark.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.tokenize(docs)


STAGES = [("quality", quality_stage), ("near_dup", near_dup_stage), ("decontaminate", decontaminate_stage), ("mixing", mixing_stage), ("tokens", tokens_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
