"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target: its weight's share of the budget, at most ``MAX_REPEAT`` times its
own size, the excess dealt again by weight. The sources that reach that limit are the first in the order of limit / weight, so sums over
that order give all targets at once. Within a source longer documents are likelier: one whose size has k binary digits weighs ``BASE`` + k, and is to have that weight's
share of the source's target in copies, ``MAX_REPEAT`` at most, the excess again dealt by weight. What is to be had of a document is first
allocated in certain whole copies; the rest of it is its inclusion probability p, which differs by k. Documents are ranked by (u / (1 - u)) / (p / (1 - p)), u a hash of the
document, and taken in that order while what the source still needs holds. Only (source, doc_id, size, u) rows are ranked, never texts. A rank r stands as
s / (1 + s), s = r * p0 / (1 - p0) with the mean p0 of the source, which keeps the order and spreads ranks over (0, 1). The last rank taken is found by sums over ``SLICES`` even slices of
it, then over as many slices of the slice where the need ends, ``LEVELS`` times, so that no task sorts a source: what is sorted at the end is about one row in ``SLICES`` ** ``LEVELS``, summed by
rank. Documents that get whole copies only aren't ranked.

Defined cases: null or empty texts have size 0 and take 0 words; null source is a source of its own,
sorted last; rows with one doc_id and text, or of one rank, share a fate, null ids too; a very long text is one large size; an empty table gives none; other columns, of
whatever name, aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnspark.llm.common import drop, lookup, materialize

WEIGHTS, BUDGET, MAX_REPEAT, BASE, SLICES, LEVELS = (5.0, 2.0, 1.0), 1.5, 2.0, 16.0, 4096, 2


def document_sizes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, source, size and u in (0, 1), a digest of doc_id and text that other engines compute alike."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    drawn = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), u.alias("u"))


def targets(sizes: DataFrame, budget: float = BUDGET, weights: tuple = WEIGHTS, most: float = MAX_REPEAT) -> DataFrame:
    """source, source_size, target: one row a source."""
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row a source stands in these windows; null comes last, and binary order is that of code points
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))) - 1
    own = own.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    limit = F.when(F.col("source_size") > 0, most * F.col("source_size")).otherwise(0.0)
    own = own.withColumns({"limit": limit, "weight": F.when(F.col("source_size") > 0, F.col("weight")).otherwise(0.0)})
    by = Window.orderBy(F.when(F.col("weight") > 0, F.col("limit") / F.col("weight")).otherwise(-1.0), "source")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = budget * F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum("limit").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    free = F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    own = own.withColumn("full", (F.col("weight") == 0) | (F.col("weight") * (left / F.greatest(free, F.lit(1e-300))) >= F.col("limit"))).withColumn("total", total)
    unit = (F.col("total") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(every)) / F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every)
    return own.select("source", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * unit).alias("target"))


def _last_taken(ranked: DataFrame) -> DataFrame:
    """source_of and last, the greatest rank that is taken, of rows (source_of, need, size, rank); no row for a source that takes none of them."""
    cuts = None  # source_of, cut: the slice in which the target ends, before: the words of the slices before it
    inside = ranked
    for level in range(1, LEVELS + 1):
        if cuts is not None:
            inside = ranked.join(cuts, "source_of").where(F.floor(F.col("rank") * float(SLICES ** (level - 1))) == F.col("cut"))
        before = F.lit(0).cast("long") if cuts is None else F.col("before")
        words = inside.groupBy("source_of", F.floor(F.col("rank") * float(SLICES**level)).alias("slice")).agg(F.sum("size").alias("words"), F.first("need").alias("need"), F.first(before).alias("before"))
        upto = Window.partitionBy("source_of").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)  # at most SLICES rows a source
        words = words.withColumn("upto", F.sum("words").over(upto) + F.col("before"))
        # the first slice that ends beyond the target, or the last of all
        ends = F.struct((F.col("upto") <= F.col("need")).alias("within"), F.when(F.col("upto") > F.col("need"), F.col("slice")).otherwise(-F.col("slice")).alias("order"), "slice", (F.col("upto") - F.col("words")).alias("before"))
        cuts = lookup(materialize(words.groupBy("source_of").agg(F.min(ends).alias("cut")).select("source_of", F.col("cut.slice").alias("cut"), F.col("cut.before").alias("before")), "cuts"))
    edge = ranked.join(cuts, "source_of").where(F.floor(F.col("rank") * float(SLICES**LEVELS)) == F.col("cut"))
    edge = edge.groupBy("source_of", "rank").agg(F.sum("size").alias("words"), F.first("need").alias("need"), F.first("before").alias("before"))
    upto = F.sum("words").over(Window.partitionBy("source_of").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    # the document that crosses the target is taken if that ends nearer to it
    edge = edge.withColumn("taken", upto - F.col("words") / 2.0 <= F.col("need"))
    last = F.coalesce(F.max(F.when(F.col("taken"), F.struct("rank", F.lit(True).alias("own")))), F.struct(F.min("rank").alias("rank"), F.lit(False).alias("own")))
    return edge.groupBy("source_of").agg(last.alias("last")).select("source_of", F.col("last.rank").alias("last"), F.col("last.own").alias("with_last"))


def shares(classes: DataFrame) -> DataFrame:
    """source, k, target, certain, p, open, need, p0 of rows (source, k, words) of the documents of each size: certain copies, the probability
    of one more where it is ``open``, what the source needs beside the certain copies, and the mean probability of the open ones. At most 64 rows a source."""
    goal = targets(classes.select("source", F.col("words").alias("size"))).withColumnRenamed("source", "of")
    rows = classes.join(lookup(goal), F.col("source").eqNullSafe(F.col("of"))).withColumn("w", BASE + F.col("k"))
    own = Window.partitionBy("source")
    by = own.orderBy(F.desc("k"))  # the largest weights reach the limit first
    weighted = F.col("w") * F.col("words")
    left = F.col("target") - MAX_REPEAT * F.coalesce(F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    full = F.col("w") * (left / F.greatest(F.sum(weighted).over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)), F.lit(1e-300))) >= MAX_REPEAT
    rows = rows.withColumn("full", full)
    free = F.sum(F.when(F.col("full"), 0.0).otherwise(weighted)).over(own)
    unit = (F.col("target") - F.sum(F.when(F.col("full"), MAX_REPEAT * F.col("words")).otherwise(0.0)).over(own)) / F.greatest(free, F.lit(1e-300))
    rows = rows.withColumn("e", F.when(F.col("full"), MAX_REPEAT).otherwise(F.col("w") * unit)).withColumn("certain", F.floor(F.col("e") + 1e-12).cast("int"))
    rows = rows.withColumn("open", (F.col("certain") < int(MAX_REPEAT)) & (F.col("e") - F.col("certain") > 1e-12))
    need = F.col("target") - F.sum(F.col("certain") * F.col("words")).over(own)
    unsure = F.sum(F.when(F.col("open"), F.col("words")).otherwise(0)).over(own)
    safe = lambda p: F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    # a target at whole copies leaves nothing to sample
    rows = rows.withColumns({"need": F.when(need >= 0.5, need).otherwise(0.0), "p": safe(F.col("e") - F.col("certain")), "unsure": unsure})
    return rows.select("source", "k", "source_size", "target", "certain", "p", (F.col("open") & (F.col("need") > 0)).alias("open"), "need", safe(F.col("need") / F.greatest("unsure", F.lit(1))).alias("p0"))


def plan(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, u, p, rank (null for documents that get certain copies only) and copies."""
    sizes = materialize(document_sizes(docs, seed).withColumn("k", F.length(F.bin("size"))), "sizes")
    classes = materialize(sizes.groupBy("source", "k").agg(F.sum("size").alias("words")), "classes")
    goal = materialize(shares(classes).withColumnsRenamed({"source": "of", "k": "of_k"}), "targets")
    drop(classes)
    odds = lambda p: p / (1 - p)
    s = odds(F.col("u")) * (odds(F.col("p0")) / odds(F.col("p")))
    code = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # a name that is never null
    joined = sizes.join(lookup(goal), F.col("source").eqNullSafe(F.col("of")) & (F.col("k") == F.col("of_k"))).withColumn("rank", F.when(F.col("open"), s / (1 + s))).withColumn("code", code)
    last = _last_taken(joined.where("open").select(F.col("code").alias("source_of"), "need", "size", "rank")).withColumnRenamed("source_of", "code")
    last = lookup(materialize(last, "goals"))
    more = F.col("open") & ((F.col("rank") < F.col("last")) | (F.col("rank") == F.col("last")) & F.col("with_last"))
    copies = F.col("certain") + F.coalesce(more, F.lit(False)).cast("int")
    return joined.join(last, "code", "left").select("doc_id", "source", "size", "source_size", "target", "u", "p", "rank", copies.alias("copies"))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken."""
    return plan(docs, seed).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def apply_mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents the mix takes, a row for each copy, with all their columns.
    Documents without an id can't be named by the plan and go."""
    takes = plan(docs.where("doc_id is not null"), seed).groupBy("doc_id").agg(F.max("copies").alias("_copies"))
    takes = takes.where("_copies > 0").withColumn("_copies", F.sequence(F.lit(1), F.col("_copies")))
    names = docs.columns
    joined = docs.alias("d").join(takes.alias("t"), F.col("d.doc_id") == F.col("t.doc_id"))
    return joined.select(*[F.col(f"d.`{c}`") for c in names], F.explode(F.col("t._copies")).alias("_copy_of_this_row")).drop("_copy_of_this_row")
