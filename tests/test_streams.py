"""Event-time windows, sessions, timers and stream joins over drops that land between restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnspark.operators import temporal
from tarnspark.streaming import claims, retries, windows

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "id long, key string, ts timestamp"


def land(spark, folder, name, rows):
    data = [(i, k, DAY + dt.timedelta(seconds=s)) for i, k, s in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")
    return claims.read_drops(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema)


def seconds(df, *columns):
    return sorted(tuple(int((v - DAY).total_seconds()) if isinstance(v, dt.datetime) else v for v in r) for r in df.select(*columns).collect())


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    """The second drop has rows behind the watermark (late), repeats of the first (once), and rows that move windows on."""
    build = lambda s: windows.windows(windows.on_time(s, "ts", "60 seconds", ["id"]), "ts", ["key"], "10 seconds", n=F.count("*"))
    run = lambda s: windows.run_windows(build(s), f"{tmp_path}/out", f"{tmp_path}/check")
    assert run(land(spark, f"{tmp_path}/in", "1", [(1, "a", 1), (2, "a", 9), (3, "a", 10), (4, "b", 100), (4, "b", 100)])) == 0
    assert run(land(spark, f"{tmp_path}/in", "2", [(5, "a", 20), (6, "a", 40), (7, "a", 30), (4, "b", 100), (8, "b", 101), (9, "c", 500)])) == 3
    got = spark.read.parquet(f"{tmp_path}/out")
    assert seconds(got, "key", "start", "n") == [("a", 0, 2), ("a", 10, 1), ("b", 100, 2)]  # the window of c is open
    assert run(land(spark, f"{tmp_path}/in", "3", [(10, "d", 900)])) == 0
    assert seconds(spark.read.parquet(f"{tmp_path}/out"), "key", "start")[-1] == ("c", 500)


def test_sliding_windows_of_tables_and_streams_agree(spark, tmp_path):
    rows = [(i, "ab"[i % 2], i * 13 % 700) for i in range(60)]
    build = lambda s: windows.windows(s, "ts", ["key"], "60 seconds", "20 seconds", n=F.count("*"))
    stream = land(spark, f"{tmp_path}/in", "1", rows + [(99, "z", 5000)])
    windows.run_windows(build(stream.withWatermark("ts", "30 seconds")), f"{tmp_path}/out", f"{tmp_path}/check")
    table = spark.createDataFrame([(i, k, DAY + dt.timedelta(seconds=s)) for i, k, s in rows], SCHEMA)
    assert seconds(spark.read.parquet(f"{tmp_path}/out"), "key", "start", "n") == seconds(build(table), "key", "start", "n")


def test_sessions_merge_across_drops(spark, tmp_path):
    """A row exactly a gap later is of the session, in tables and streams alike; a session goes on in the next drop."""
    first = [(1, "a", 0), (2, "a", 10), (3, "a", 19), (4, "b", 5)]
    second = [(5, "a", 28), (6, "b", 16), (7, "b", 14), (8, "z", 4000)]
    run = lambda s: claims.run_available(windows.sessions(s.withWatermark("ts", "100 seconds"), "ts", ["key"], "10 seconds"), f"{tmp_path}/out", f"{tmp_path}/check")
    run(land(spark, f"{tmp_path}/in", "1", first))
    run(land(spark, f"{tmp_path}/in", "2", second))
    table = spark.createDataFrame([(i, k, DAY + dt.timedelta(seconds=s)) for i, k, s in first + second], SCHEMA)
    want = [r for r in seconds(temporal.sessions(table, ["key"], "ts", 10), "key", "first", "last", "n") if r[0] != "z"]
    assert seconds(spark.read.parquet(f"{tmp_path}/out"), "key", "first", "last", "n") == want
    assert seconds(windows.sessions(table, "ts", ["key"], "10 seconds"), "key", "first", "last", "n")[:-1] == want


LOG = "key string, status string, ts timestamp, seq long"


def log(spark, folder, name, rows):
    data = [(k, s, DAY + dt.timedelta(seconds=t), i) for i, (k, s, t) in enumerate(rows)]
    spark.createDataFrame(data, LOG).coalesce(1).write.parquet(f"{folder}/{name}")
    return claims.read_drops(spark, f"{folder}/*", spark.createDataFrame([], LOG).schema)


def test_timers_send_failed_units_back(spark, tmp_path):
    """Backoffs of 3, 6 and 12 seconds; a later attempt before the backoff is over takes its place, a terminal one forgets, the fourth exhausts, and state outlives a restart."""
    run = lambda s: claims.run_available(retries.retries(s, "1 second", idle=100), f"{tmp_path}/out", f"{tmp_path}/check")
    run(log(spark, f"{tmp_path}/in", "1", [("a", "blocked", 0), ("a", "error", 2), ("b", "blocked", 0), ("b", "done", 1), ("c", "error", 10), ("c", "error", 20), ("c", "error", 30), (None, "error", 0), ("d", "odd", 1), ("e", "error", 29)]))
    want = [("a", "pending", 2, 8, "blocked,error"), ("c", "pending", 1, 13, "error"), ("c", "pending", 2, 26, "error,error")]
    assert seconds(spark.read.parquet(f"{tmp_path}/out"), "key", "status", "attempt", "at", "history") == want
    run(log(spark, f"{tmp_path}/in", "2", [("c", "error", 43), ("e", "not_found", 31), ("a", "blocked", 400), ("z", "done", 500)]))
    want += [("a", "pending", 1, 403, "blocked"), ("c", "exhausted", 4, 43, "error,error,error,error"), ("c", "pending", 3, 42, "error,error,error")]  # a was forgotten at 102
    assert seconds(spark.read.parquet(f"{tmp_path}/out"), "key", "status", "attempt", "at", "history") == sorted(want)


def test_claims_are_settled_or_set_free(spark, tmp_path):
    """An output in time, one too late, two outputs, none at all; a claim of the first drop meets its output in the second."""
    def run(rows):
        s = land(spark, f"{tmp_path}/in", str(rows[0][0]), rows)
        claimed = s.where("id % 2 = 0").select("key", F.col("ts").alias("claimed_at"))
        made = s.where("id % 2 = 1").select("key", F.col("ts").alias("made_at"))
        claims.run_available(claims.settle(claimed, made, "5 seconds", "60 SECONDS"), f"{tmp_path}/out", f"{tmp_path}/check")
        return seconds(spark.read.parquet(f"{tmp_path}/out"), "key", "claimed_at", "made_at", "state")

    first = run([(0, "a", 0), (2, "b", 0), (4, "c", 10), (6, "d", 20), (1, "a", 60), (3, "b", 61), (5, "z", 50), (8, "y", 50)])
    assert first == [("a", 0, 60, "done")]
    second = run([(7, "c", 30), (9, "c", 70), (11, "x", 400), (10, "x", 400)])
    assert sorted(second, key=repr) == sorted([("a", 0, 60, "done"), ("b", 0, None, "free"), ("c", 10, 70, "done"), ("d", 20, None, "free"), ("x", 400, 400, "done"), ("y", 50, None, "free")], key=repr)


def test_a_stop_between_claim_and_output_loses_nothing(spark, tmp_path):
    """A batch whose output fails has claimed nothing: after a restart each key's output is there once, also those claimed before."""
    def run(rows, name, broken):
        s = land(spark, f"{tmp_path}/in", name, rows) if rows else claims.read_drops(spark, f"{tmp_path}/in/*", spark.createDataFrame([], SCHEMA).schema)
        fail = F.when(F.col("key") == F.lit(broken), F.raise_error(F.lit("stopped")).cast("string")).otherwise(F.concat(F.lit("made of "), "key"))
        claims.run_available(claims.work(s, ["key"], lambda c: c.select("key", fail.alias("made"))), f"{tmp_path}/out", f"{tmp_path}/check")

    run([(1, "a", 0), (2, "a", 1)], "1", "none")
    with pytest.raises(Exception, match="stopped"):
        run([(3, "b", 2), (4, "c", 3), (5, "a", 4)], "2", "c")
    run(None, "", "none")
    got = sorted((r.key, r.made) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(k, f"made of {k}") for k in "abc"]
