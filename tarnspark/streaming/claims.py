"""Claims and status over file drops: the streaming forms of first-by-domain and latest-by-key."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_drops(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they land in a folder; NTZ times become instants, so that they can be watermarked."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return stream.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in stream.schema.fields])


def claim(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Each key once over the stream's life. With ``delay`` the state of old keys is dropped: a bounded variant."""
    if delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def work(stream: DataFrame, keys: list[str], output: Callable[[DataFrame], DataFrame], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """What ``output`` makes of each key, once: the claim is state of the same query that writes the output, so a batch commits both or neither. A job that stops between
    claiming and writing loses no claim: the batch runs again from the state before it. ``output`` gives rows from rows, without state."""
    return output(claim(stream, keys, event_time, delay))


STATUS = "key string, status string, attempts long, ts timestamp, seq long"


def track(stream: DataFrame) -> DataFrame:
    """The status machine of (key, status, ts, seq) rows: in update mode, a row for each key of a batch with its last status and attempts so far.
    A reset is a row with status ``pending``: it keeps the attempts (``reset_rows`` makes them)."""
    last = F.max(F.struct("ts", "seq", "status"))
    return stream.groupBy("key").agg(last.alias("_last"), F.count_if(F.col("status") != "pending").alias("attempts")).select("key", "_last.status", "attempts", "_last.ts", "_last.seq")


def reset_rows(targets: DataFrame, ts: Column, seq: Column) -> DataFrame:
    """The rows of a log that set keys back to pending."""
    return targets.select("key", F.lit("pending").alias("status"), ts.alias("ts"), seq.alias("seq"))


def epoch_writer(sink: str):
    """A foreachBatch function that writes each epoch to a folder of its own, so that a batch that is played again replaces itself."""
    return lambda df, epoch: df.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")


def start_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", batch: Any = None):
    """A query that processes what is there and stops."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.foreachBatch(batch) if batch else writer.format("parquet").option("path", sink)).start()


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", batch: Any = None) -> None:
    """Process what is there and stop. A restart from the checkpoint goes on after the last committed batch.
    Parquet sinks commit claims together with their output; ``batch`` (a foreachBatch function) replaces the sink."""
    start_available(stream, sink, checkpoint, mode, batch).awaitTermination()


def run_every(stream: DataFrame, sink: str, checkpoint: str, interval: str = "5 seconds"):
    """A standing query that commits every ``interval``."""
    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=interval).format("parquet").option("path", sink).start()


def settle(claimed: DataFrame, outputs: DataFrame, delay: str, limit: str) -> DataFrame:
    """Claims (key, claimed_at) joined with outputs (key, made_at) that came within ``limit`` after them: a row for each claim and output with state ``done``, and
    one with state ``free`` for a claim that the watermark has left without any, so that the unit can be claimed again.

    Both sides are streams; the time bound lets Spark drop either side's state once the other's watermark has passed it."""
    left = claimed.select("key", "claimed_at").withWatermark("claimed_at", delay)
    right = outputs.select(F.col("key").alias("_key"), "made_at").withWatermark("made_at", delay)
    within = F.expr(f"key = _key AND made_at >= claimed_at AND made_at <= claimed_at + INTERVAL {limit}")
    return left.join(right, within, "leftOuter").select("key", "claimed_at", "made_at", F.when(F.col("made_at").isNull(), "free").otherwise("done").alias("state"))
