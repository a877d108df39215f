"""Event-time windows and sessions over streams: state is dropped behind a watermark, results are final when they appear (append mode).

A row is late if the watermark had passed its time when its batch began: it is dropped and counted, one by one, by the operator that drops repeated
deliveries, ahead of the windows. Counting it at the windows would count groups, since Spark combines rows before its state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnspark.streaming.claims import start_available


def windows(rows: DataFrame, time: str, keys: list[str], length: str, slide: str | None = None, **aggregates: Column) -> DataFrame:
    """keys, start, end and the aggregates of tumbling windows, or with ``slide`` of overlapping ones: of a table, or of a stream that has a watermark."""
    grouped = rows.groupBy(F.window(time, length, slide), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return grouped.select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), *aggregates)


def sessions(rows: DataFrame, time: str, keys: list[str], gap: str, **aggregates: Column) -> DataFrame:
    """keys, first, last, n and the aggregates of runs of rows with gaps of at most ``gap``; on a stream, sessions that meet are merged in the state."""
    grouped = rows.groupBy(F.session_window(time, gap), *keys).agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n"), *[c.alias(n) for n, c in aggregates.items()])
    return grouped.select(*keys, "first", "last", "n", *aggregates)


def on_time(stream: DataFrame, time: str, delay: str, ids: list[str]) -> DataFrame:
    """The stream under a watermark of ``delay``, each row once by ``ids``, without the late ones."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(ids)


def late_rows(query: StreamingQuery, operator: str = "dedupeWithinWatermark") -> dict[int, int]:
    """Rows that came too late, by batch, of the query's latest hundred batches. The driver reads numbers that Spark has counted, no rows."""
    return {p.batchId: sum(s.numRowsDroppedByWatermark for s in p.stateOperators if s.operatorName == operator) for p in query.recentProgress}


def run_windows(result: DataFrame, sink: str, checkpoint: str) -> int:
    """Process what is there, append the windows that are final, and return the number of late rows."""
    query = start_available(result, sink, checkpoint)
    query.awaitTermination()
    return sum(late_rows(query).values())
