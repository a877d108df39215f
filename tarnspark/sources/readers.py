"""Landed files as DataFrames. Schemas are given, never inferred from values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tarnspark.functions.reviews import from_cell

LEAD = "keyword string, location string, google_page int, business_name string, website_url string, business_description string, services_offered string, contact_phone string, contact_email string, address string, business_city string, business_state string, supply_location string, logo_url string"
BUSINESS = "business_id string, name string, address string, city string, state string, stars double, review_count int, categories string"
REVIEW = "business_id string, stars double, date string, text string"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob has files, in whatever store it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def csv(spark: SparkSession, path: str, encoding: str = "UTF-8", schema: str | None = None, lines: bool = True) -> DataFrame:
    """A CSV with a header, all strings, quotes doubled, cells of any size that may hold newlines; empty cells are empty strings."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", lines).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)
    return df.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def seed(spark: SparkSession, path: str) -> DataFrame:
    """keywords and locations of a latin-1 seed file, with row_idx."""
    return with_row_idx(csv(spark, path, "ISO-8859-1"))


def with_row_idx(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """Numbers rows in file order, once, at ingest. Write the result; the number is the key from then on."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())  # the partition above 33 bits, the place in it below
    counts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each input partition
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(starts), F.shiftright("_at", 33) == F.col("_part")).select(number.alias(name), *[F.col(f"`{c}`") for c in df.columns])


def written_rows(output: DataFrame, key: str = "_row_idx") -> DataFrame:
    """The digit-only row keys of an output file."""
    return output.where(F.col(key).rlike("^[0-9]+$")).select(F.col(key).cast("int").alias("row_idx")).distinct()


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, gzipped or plain; blank and malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def first_available(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON lines of the first path that exists, else no rows."""
    for p in paths:
        if exists(spark, p):
            return json_lines(spark, p, schema)
    return empty(spark, schema)


def state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table, empty if it is missing or can't be read."""
    try:
        return spark.read.schema(schema).parquet(path) if exists(spark, path) else empty(spark, schema)
    except AnalysisException:
        return empty(spark, schema)


def migrate_progress(old: DataFrame) -> DataFrame:
    """kind, key from an old snapshot row of arrays: a file that numbers its combinations keeps its urls and drops those numbers."""
    numbered = F.coalesce(F.exists("completed_combos", lambda x: x.rlike("^[0-9]+$")), F.lit(False))
    combos = F.when(numbered, F.expr("cast(array() as array<string>)")).otherwise(F.col("completed_combos"))
    parts = [old.select(F.lit(kind).alias("kind"), F.explode(values).alias("key")) for kind, values in (("combo", combos), ("url", F.col("processed_urls")))]
    return parts[0].unionByName(parts[1])


def import_reviews(df: DataFrame, inputs: list[str], ratings: list[str], reviews: list[str], key: str = "_row_idx") -> DataFrame:
    """Rows of a review CSV as table rows: other keys skipped, empty inputs null, ratings that aren't numbers null, bad reviews none."""
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return df.where(F.col(key).rlike("^[0-9]+$")).select(
        F.col(key).cast("int").alias("row_idx"), *[blank(c).alias(c) for c in inputs], *[blank(c).try_cast("float").alias(c) for c in ratings], *[from_cell(F.col(c)).alias(c) for c in reviews]
    )


def first_valid(candidates: DataFrame, key: str, rank: str, valid: Column) -> DataFrame:
    """The candidate of the least rank that is valid, for each key: the first contact page that exists."""
    from tarnspark.operators.keyed import first_by

    return first_by(candidates.where(valid), [key], [F.asc(rank)])


def relational(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A table over JDBC, read in ``parts`` ranges of its key; filters and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, **options).load()
