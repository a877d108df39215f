"""Tables as snapshots: data files that never change, and a numbered manifest for each commit.

A commit writes its data to a folder of its own, then creates the next manifest under a name that must not exist yet. Creating it is one atomic
step, so readers always find a whole table, a failed job leaves nothing that is read, and of two writers that build on the same version one is
refused. It needs a file system whose rename refuses an existing target, as HDFS does; on a local one a hard link does the same.
"""

from __future__ import annotations

import json
import os
import urllib.parse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(Exception):
    """Another writer has committed the version that this one was to be."""


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), spark.sparkContext._jvm.org.apache.hadoop.fs.Path


def _name(version: int) -> str:
    return f"{version:012d}.json"


def _create(spark: SparkSession, path: str, body: str) -> None:
    """A small file that appears whole, or not at all if the name is taken."""
    fs, Path = _fs(spark, path)
    staged = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    out = fs.create(Path(staged), False)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    try:
        if fs.getScheme() == "file":
            plain = lambda p: urllib.parse.urlparse(p).path
            try:
                os.link(plain(staged), plain(path))
            except FileExistsError as e:
                raise Conflict(path) from e
        elif not fs.rename(Path(staged), Path(path)):
            raise Conflict(path)
    finally:
        fs.delete(Path(staged), False)


def versions(spark: SparkSession, table: str) -> list[int]:
    """The committed versions, from 1."""
    fs, Path = _fs(spark, table)
    folder = Path(f"{table}/manifest")
    if not fs.exists(folder):
        return []
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json") and not s.getPath().getName().startswith("."))


def manifest(spark: SparkSession, table: str, version: int | None = None) -> dict:
    """What a version consists of: version, schema, folders of data. Version 0 is a table without commits."""
    if version is None:
        version = max(versions(spark, table), default=0)
    if not version:
        return {"version": 0, "schema": None, "folders": []}
    fs, Path = _fs(spark, table)
    stream = fs.open(Path(f"{table}/manifest/{_name(version)}"))
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the latest by default. Later commits don't change what it reads."""
    m = manifest(spark, table, version)
    if not m["version"]:
        raise FileNotFoundError(table)
    schema = StructType.fromJson(m["schema"])
    if not m["folders"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table}/data/{f}" for f in m["folders"]])


def _commit(df: DataFrame, table: str, base: dict, folder: str, keep: bool) -> int:
    schema = df.schema.jsonValue()
    if keep and base["schema"] and [(f["name"], f["type"]) for f in base["schema"]["fields"]] != [(f["name"], f["type"]) for f in schema["fields"]]:
        raise ValueError("an appended table has the columns of what it is appended to")
    version = base["version"] + 1
    body = {"version": version, "schema": schema, "folders": [*(base["folders"] if keep else []), folder]}
    fs, Path = _fs(df.sparkSession, table)
    fs.mkdirs(Path(f"{table}/manifest"))
    _create(df.sparkSession, f"{table}/manifest/{_name(version)}", json.dumps(body))
    return version


def replace(df: DataFrame, table: str, base: int | None = None) -> int:
    """Replace the table, also one that ``df`` reads; the new version. ``base`` is the version that ``df`` was made from, by default the latest before the data are written.
    Raises ``Conflict`` if another commit came in between: what was made from an older version must be made anew."""
    spark = df.sparkSession
    before = manifest(spark, table, base)
    folder = uuid.uuid4().hex
    df.write.parquet(f"{table}/data/{folder}")
    return _commit(df, table, before, folder, False)


def append(df: DataFrame, table: str, tries: int = 20) -> int:
    """Add rows; the new version. Appends don't depend on what is there, so a conflict is tried again on the newer version, without writing the data again."""
    spark = df.sparkSession
    folder = uuid.uuid4().hex
    df.write.parquet(f"{table}/data/{folder}")
    for left in range(tries - 1, -1, -1):
        try:
            return _commit(df, table, manifest(spark, table), folder, True)
        except Conflict:
            if not left:
                raise
    raise AssertionError


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Delete the versions before the last ``keep`` and the data that only they read; how many folders went. Data of a commit that is under way isn't in any
    manifest yet, so this runs while nothing is written."""
    have = versions(spark, table)
    kept, old = have[-keep:], have[:-keep]
    wanted = {f for v in kept for f in manifest(spark, table, v)["folders"]}
    fs, Path = _fs(spark, table)
    for v in old:
        fs.delete(Path(f"{table}/manifest/{_name(v)}"), False)
    gone = [s.getPath() for s in fs.listStatus(Path(f"{table}/data")) if s.getPath().getName() not in wanted]
    for p in gone:
        fs.delete(p, True)
    return len(gone)
