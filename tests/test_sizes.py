"""Work that must not grow faster than the input: repeated names, time frames, few rows a key, long intervals, state calls."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from tarnspark.operators import resolve, temporal
from tarnspark.streaming.retries import Retries


def test_repeated_names_match_once(spark, monkeypatch):
    df = spark.range(300).select("id", F.lit("x").alias("block"), F.array(F.lit("a"), F.lit("b"), F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("name_tokens"))
    right = df.select((F.col("id") + 1000).alias("other"), F.col("id").alias("ord"), "block", "name_tokens")
    sizes, plain = [], resolve._fuzzy_sets
    monkeypatch.setattr(resolve, "_fuzzy_sets", lambda a, b, *rest: (sizes.extend([a.count(), b.count()]), plain(a, b, *rest))[1])
    got = resolve.fuzzy_match(df, right, ["block"], "id", "other", "ord", stop=()).collect()
    assert sizes == [3, 3] and sorted(map(tuple, got)) == [(i, 1000 + i % 3, 1.0) for i in range(300)]


def test_frames_are_not_read_again(spark):
    df = spark.range(9).select(F.lit(1).alias("key"), F.timestamp_seconds("id").alias("ts"))
    plan = temporal.moving_sums(df, ["key"], "ts", 5, {"n": F.lit(1)})._jdf.queryExecution().optimizedPlan().toString()
    assert "RangeFrame" not in plan.replace("UnboundedPreceding", "") and "unboundedfollowing" not in plan.lower()


def test_few_rows_of_a_key_are_not_multiplied(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("key"), "id", F.timestamp_seconds("id").alias("s"), F.timestamp_seconds(F.col("id") * 3 + 1).alias("e"))
    plan = temporal.overlap_join(df, df.withColumnRenamed("id", "other"), ["key"], ("s", "e"), ("s", "e"), ["other"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_bins_hold_few_points_outside_an_interval(spark):
    lengths = [120, 240, 480, 3600, 86_400]
    for x in lengths:
        level = spark.range(1).select(temporal._level(F.lit(x * 1_000_000))).first()[0] - temporal._FINER
        assert temporal._LEVEL**level <= x * 1_000_000 / 4


class _Store:
    def __init__(self):
        self.value, self.calls = None, 0

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            if name in ("update", "put"):
                self.value = args[0]
            elif name == "clear":
                self.value = None
            return self.value is not None if name == "exists" else self.value

        return call


def test_state_calls_of_a_batch():
    made = Retries(("error",), ("done",), 4, 3, 30, 100)
    stores, timers = {}, []
    made.init(SimpleNamespace(
        getValueState=lambda n, s: stores.setdefault(n, _Store()), getListState=lambda n, s: stores.setdefault(n, _Store()), listTimers=lambda: list(timers),
        deleteTimer=timers.remove, registerTimer=timers.append,
    ))
    rows = [SimpleNamespace(ts=i, seq=i, millis=i * 1000, status="done" if i % 7 == 6 else "error") for i in range(1000)]
    out = list(made.handleInputRows(("k",), iter(rows), None))
    assert len(out) == 143 and {r.status for r in out} == {"exhausted"} and sum(s.calls for s in stores.values()) <= 6 and len(timers) == 1
