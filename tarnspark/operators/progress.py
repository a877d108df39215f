"""Status analytics over attempt logs: rows (row_idx, site_id, status, ts, seq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnspark.functions import rules
from tarnspark.functions.text import first_filled
from tarnspark.operators.keyed import latest_by

STATUSES = ["done", "not_found", "blocked", "error", "pending"]
TERMINAL = ["done", "not_found"]


def site_dimension(spark: SparkSession, sites=rules.SITES) -> DataFrame:
    """The registry: a row for each site with its order and limits."""
    rows = [(i, *s) for i, s in enumerate(sites)]
    return spark.createDataFrame(rows, "site_ord int, site_id string, has_reviews boolean, max_reviews int, max_retries int, heavy_blocker boolean")


def latest_status(log: DataFrame, keys=("row_idx", "site_id")) -> DataFrame:
    """The last status of each key and its attempts."""
    return latest_by(log, list(keys), ["status"], ["ts", "seq"]).withColumnRenamed("n", "attempts")


def status_grid(rows: DataFrame, sites: DataFrame, latest: DataFrame) -> DataFrame:
    """Every row at every site; unknown and missing statuses are pending, missing attempts 0."""
    grid = rows.select("row_idx").crossJoin(sites)
    status = F.when(F.col("status").isin(STATUSES), F.col("status")).otherwise("pending")
    return grid.join(latest.select("row_idx", "site_id", "status", "attempts"), ["row_idx", "site_id"], "left").select(*[c for c in grid.columns], status.alias("status"), F.coalesce("attempts", F.lit(0)).alias("attempts"))


def pending_work(grid: DataFrame, complete: DataFrame | None = None) -> DataFrame:
    """Cells that aren't terminal, of rows that aren't complete."""
    open_cells = grid.where(~F.col("status").isin(TERMINAL))
    return open_cells if complete is None else open_cells.join(complete.select("row_idx"), "row_idx", "left_anti")


def status_pivot(grid: DataFrame, by: str = "site_id", statuses=STATUSES) -> DataFrame:
    """Counts of each status by site, zero-filled, in one aggregate."""
    return grid.groupBy(by).agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])


def retry_targets(grid: DataFrame, pending_of_complete: bool = False, complete: DataFrame | None = None) -> DataFrame:
    """row_idx and its sites to retry in registry order: blocked and error ones, and with the flag the pending ones of complete rows."""
    failed = F.col("status").isin("blocked", "error")
    todo = grid.where(failed)
    if pending_of_complete and complete is not None:
        todo = todo.unionByName(grid.where("status = 'pending'").join(complete.select("row_idx"), "row_idx", "left_semi").select(*grid.columns))
    sites = F.array_sort(F.collect_list(F.struct("site_ord", "site_id")))
    return todo.groupBy("row_idx").agg(F.transform(sites, lambda s: s["site_id"]).alias("sites"))


def classify(heavy: Column, search_error: Column, url: Column, scrape_error: Column, has_data: Column, given: Column, rating: Column, reviews: Column) -> Column:
    """The status of one attempt from what it brought."""
    return (
        F.when(search_error, "error")
        .when(F.coalesce(url, F.lit("")) == "", F.when(heavy, "blocked").otherwise("not_found"))
        .when(scrape_error, "error")
        .when(~has_data, "blocked")
        .when(given.isin("blocked", "error", "not_found"), given)
        .when(rating.isNull() & (F.coalesce(reviews, F.lit(0)) == 0), "not_found")
        .otherwise("done")
    )


def after_retries(log: DataFrame, keys: list[str]) -> DataFrame:
    """The status after a retry loop: a terminal one stops it; else blocked if the last attempt was, else error."""
    stop = F.min_by(F.when(F.col("status").isin(TERMINAL), F.col("status")), F.when(F.col("status").isin(TERMINAL), F.struct("ts", "seq")))
    last = F.max(F.struct("ts", "seq", "status"))
    return log.groupBy(*keys).agg(stop.alias("_stop"), last.alias("_last")).select(*keys, F.coalesce("_stop", F.when(F.col("_last.status") == "blocked", "blocked").otherwise("error")).alias("status"))


def row_range(rows: DataFrame, start: int, n: int) -> DataFrame:
    """``n`` rows from ``start`` on, as far as there are rows."""
    return rows.where(F.col("row_idx").between(start, start + n - 1))


def retry_rows(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The input rows of retry targets (row_idx, sites); targets beyond the input are skipped."""
    return rows.join(targets, "row_idx")


def reset(latest: DataFrame, targets: DataFrame, keys=("row_idx", "site_id")) -> DataFrame:
    """Latest statuses with the targets set back to pending; attempts stay."""
    marked = latest.join(targets.select(*keys).distinct().withColumn("_again", F.lit(True)), list(keys), "left")
    return marked.withColumn("status", F.when(F.col("_again"), "pending").otherwise(F.col("status"))).select(*latest.columns)


def mark_complete(rows: DataFrame, handled: DataFrame) -> DataFrame:
    """rows (row_idx, row_complete) after a pass: every row that it handled is complete, whatever its statuses."""
    seen = handled.select("row_idx").distinct().withColumn("_handled", F.lit(True))
    done = F.coalesce("row_complete", F.lit(False)) | F.coalesce("_handled", F.lit(False))
    return rows.join(seen, "row_idx", "left").withColumn("row_complete", done).select(*rows.columns)


def retry_passes(grid_of, run_pass, passes: int = 3):
    """Bounded retries: ``grid_of()`` gives the current grid, ``run_pass(targets)`` handles one pass. Stops when no target is left.
    Returns the number of passes run. Nothing but a row's existence comes to the driver."""
    for n in range(passes):
        targets = retry_targets(grid_of())
        if targets.isEmpty():
            return n
        run_pass(targets)
    return passes


def site_totals(targets: DataFrame) -> DataFrame:
    """Rows and sites of a retry pass."""
    return targets.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("sites")), F.lit(0)).alias("sites"))


def state_counts(rows: DataFrame, state: str) -> DataFrame:
    """Rows by state, most first, ties by state; a null state is a group."""
    return rows.groupBy(state).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(state))


def best_name(names: dict[str, Column]) -> Column:
    """The first discovered name that isn't blank, by site priority."""
    return first_filled(*[names[s] for s in rules.NAME_PRIORITY if s in names])


def snapshot(latest: DataFrame, complete: DataFrame) -> DataFrame:
    """row_idx, sites (a map of site to status and attempts) and row_complete, from rows (row_idx, site_id, status, attempts): a row's sites are few."""
    entries = F.collect_list(F.struct("site_id", F.struct("status", "attempts")))
    done = complete.select("row_idx").distinct().withColumn("_done", F.lit(True))
    kept = latest.groupBy("row_idx").agg(F.map_from_entries(F.array_sort(entries)).alias("sites"))
    return kept.join(done, "row_idx", "left").select("row_idx", "sites", F.coalesce("_done", F.lit(False)).alias("row_complete"))


def from_snapshot(kept: DataFrame) -> DataFrame:
    """The rows of a snapshot again: row_idx, site_id, status, attempts."""
    return kept.select("row_idx", F.explode("sites").alias("site_id", "_s")).select("row_idx", "site_id", "_s.status", "_s.attempts")
