"""Attempts as keyed state with timers: a blocked unit goes back to pending when its backoff is over.

State and timers of a key live in RocksDB and are checkpointed with the stream. Spark gives timers to programs through transformWithState only, which
runs Python beside the JVM; everything that comes to it is a key's few rows of a batch.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RETRIES = "key string, status string, attempt int, at long, history string"


@contextlib.contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start in this block keep their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def backoff_seconds(attempt: int, first: float = 3, most: float = 30) -> float:
    """The wait after an attempt (from 1) that failed: doubled each time, up to ``most``."""
    return min(first * 2 ** (attempt - 1), most)


class Retries(StatefulProcessor):
    """Rows (key, status, ts, millis, seq) in, rows of RETRIES out, times in milliseconds: ``pending`` at the time when a failed attempt may be repeated, if none came before, and
    ``exhausted`` with the last one allowed. A terminal status forgets the key, and so do ``idle`` seconds without a row."""

    def __init__(self, failed: tuple[str, ...], terminal: tuple[str, ...], attempts: int, first: float, most: float, idle: float) -> None:
        self.failed, self.terminal, self.attempts, self.first, self.most, self.idle = failed, terminal, attempts, first, most, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "attempt int, due long, ends long")  # milliseconds; due is 0 if nothing is due
        self.history = handle.getListState("history", "status string")

    def _load(self) -> None:
        """The state of the key at hand, which its rows then change in memory: a call to the store for a batch's key, not for each of its rows."""
        self.now = tuple(self.last.get()) if self.last.exists() else None  # attempt, due, ends
        self.said = [s for (s,) in self.history.get()] if self.now else []
        self.before = (self.now, list(self.said))

    def _store(self) -> None:
        now, said = self.before
        if self.now == now and self.said == said:
            return
        timer = lambda x: x and (x[1] or x[2])
        if timer(now) != timer(self.now):
            for t in list(self.handle.listTimers()) if now else ():
                self.handle.deleteTimer(t)
            if self.now:
                self.handle.registerTimer(timer(self.now))
        if not self.now:
            self.last.clear()
            self.history.clear()
            return
        if self.now != now:
            self.last.update(self.now)
        if self.said != said:
            self.history.put([(s,) for s in self.said])

    def _forget(self) -> None:
        self.now, self.said = None, []

    def _row(self, key: str, status: str, attempt: int, at: int) -> Row:
        return Row(key=key, status=status, attempt=attempt, at=at, history=",".join(self.said))

    def _until(self, key: str, now: int) -> Iterator[Row]:
        """What fell due up to ``now``: rows of a batch come before its timers, so that a batch's size doesn't change results."""
        if self.now:
            attempt, due, ends = self.now
            if due and due <= now:
                yield self._row(key, "pending", attempt, due)
                due = 0
            if ends <= now:
                self._forget()
            else:
                self.now = (attempt, due, ends)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        self._load()
        for r in sorted(rows, key=lambda r: (r.ts, r.seq)):
            now = r.millis
            yield from self._until(key[0], now)
            if r.status in self.terminal:
                self._forget()
            elif r.status in self.failed:
                attempt = (self.now[0] if self.now else 0) + 1
                self.said.append(r.status)
                if attempt >= self.attempts:
                    yield self._row(key[0], "exhausted", attempt, now)
                    self._forget()
                else:
                    wait = backoff_seconds(attempt, self.first, self.most)
                    self.now = (attempt, now + int(wait * 1000), now + int(self.idle * 1000))
        self._store()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self._load()
        yield from self._until(key[0], max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()))
        self._store()

    def close(self) -> None:
        pass


def retries(
    log: DataFrame, delay: str, failed: tuple[str, ...] = ("blocked", "error"), terminal: tuple[str, ...] = ("done", "not_found"),
    attempts: int = 4, first: float = 3, most: float = 30, idle: float = 86_400,
) -> DataFrame:
    """The retries that a stream of attempts (key, status, ts, seq) makes due, final once the watermark has passed them. ``idle`` is no less than ``most``."""
    if idle < most:
        raise ValueError("a key is forgotten before its retry is due")
    rows = log.select("key", "status", "ts", F.unix_millis("ts").alias("millis"), "seq").where(F.col("key").isNotNull() & F.col("status").isin(*failed, *terminal)).withWatermark("ts", delay)
    found = rows.groupBy("key").transformWithState(Retries(failed, terminal, attempts, first, most, idle), RETRIES, "Append", "EventTime")
    return found.withColumn("at", F.timestamp_millis("at"))
