"""Shared storage, materialisation and bounded broadcasts for the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnspark.operators.skew import hot_groups

#: Rows of a lookup table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only where it is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tarnspark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends there and
    a lost executor costs no recomputation of what stands above."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tarn_path = path
    return out


def drop(df: DataFrame | None) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    path = getattr(df, "_tarn_path", None)
    if path:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``max_rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def with_docs(docs: DataFrame, rows: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs`` joined with ``rows`` of unique keys, whose cells can be large: only the keys are ever broadcast, so that texts of
    other documents aren't shuffled."""
    ids = rows.select(*keys)
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        docs = docs.join(F.broadcast(ids), list(keys), "left_semi")
    return docs.join(rows.hint("merge"), list(keys))


def salted_join(rows: DataFrame, one: DataFrame, key: str, spread: str, most: int, how: str = "inner", keys: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``one``, which has a row for each key. The rows of a key with over ``most`` of them are dealt to parts by the column ``spread``, and the
    key's row goes to each part, so that no task holds a hot key. Tables of ``most`` rows or fewer are joined as they are. ``keys`` is a written table with
    the keys of ``rows``, where that is none itself."""
    keys = rows if keys is None else keys
    if keys.count() <= most:
        return rows.join(one, key, how)
    hot = hot_groups(keys, [key], most)
    if hot.isEmpty():
        return rows.join(one, key, how)
    hot = lookup(hot)
    dealt = rows.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(spread), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    copies = one.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, null texts as empty ones; other columns, of whatever name, stay out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
