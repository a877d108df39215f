"""Session defaults: UTC, AQE, unchunked base64, and RocksDB state for streaming."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(app: str = "tarnspark", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults; ``conf`` keys may use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}).getOrCreate()
