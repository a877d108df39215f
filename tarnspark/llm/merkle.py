"""A Merkle manifest of documents: a tree of SHA-256 digests for each source, and one over the trees' roots.

Every level is a table of nodes (tree, place, digest). A level equijoins itself with the computed places of the siblings
(slot + 1 and slot + 2 within a run of three; for an arity of two that is the XOR of the place with one), and the rows of slot zero
emit the parents. Runs, and so all rows that meet, lie together by (tree, run), never by source: a source of any size is spread over
all tasks, and its leaves get their places from counts of sorted slices. Proofs are handed down level by level, so that a level costs
one join of its own nodes; texts are read once and never shuffled.

Defined cases: a null value hashes as ``-``; documents without a source are a tree of their own, the first; a null doc_id sorts first and
leaves are ordered by digest within one doc_id; repeated rows are leaves of their own; a run of one node is hashed like any other, and a tree of one leaf is
that leaf; a very long text is one value of a digest; empty tables give no rows; other columns, of whatever name, stay out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnspark.llm.common import materialize

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _value(c: Column) -> Column:
    """A value of any type with its length in bytes before it, so that no two lists of values read the same."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a document, with some of its fields replaced."""
    return F.sha2(F.concat(*[_value(changed.get(f, F.col(f))) for f in FIELDS]).cast("binary"), 256)


def _placed(rows: DataFrame, key: str | None, order: list[str], tag: str) -> DataFrame:
    """rows with tree (a number for each key, ascending with it), place (from 0 within the tree) and size (rows of the tree): a sort over
    all tasks, then counts for each slice of it and key."""
    by = [key] if key else []
    at = materialize(rows.orderBy(*[F.asc_nulls_first(c) for c in [*by, *order]]).withColumn("at", F.monotonically_increasing_id()), tag)
    at = at.withColumn("slice", F.shiftright("at", 33))
    counts = at.groupBy("slice", *by).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    group = f"PARTITION BY {key}" if key else "PARTITION BY 1"
    counts = counts.select(
        *[F.col(c).alias("_" + c) for c in ["slice", *by]], "first",
        F.expr(f"coalesce(sum(n) OVER ({group} ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("before"),
        F.expr(f"sum(n) OVER ({group})").alias("size"), F.expr(f"min(first) OVER ({group})").alias("tree"),
    )
    same = F.col("slice") == F.col("_slice")
    if key:
        same = same & F.col(key).eqNullSafe(F.col("_" + key))
    return at.join(counts, same).select(*rows.columns, "tree", (F.col("before") + F.col("at") - F.col("first")).alias("place"), "size")


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with run, slot, and the digests ``before`` and ``after`` them in their run, concatenated."""
    own = nodes.withColumn("run", F.expr(f"place div {arity}")).withColumn("slot", F.col("place") % arity).repartition("tree", "run")
    sides = own.select(F.col("tree").alias("t"), F.col("run").alias("r"), F.col("place").alias("p"), F.col("digest").alias("d"))
    out, found = own, []
    for k in range(1, arity):
        slot = (F.col("slot") + k) % arity
        other = sides.select(*[F.col(c).alias(f"{c}{k}") for c in sides.columns])
        out = out.join(other, (F.col("tree") == F.col(f"t{k}")) & (F.col("run") == F.col(f"r{k}")) & (F.col("place") - F.col("slot") + slot == F.col(f"p{k}")), "left")
        found.append((slot, F.col(f"d{k}")))
    side = lambda left: F.concat_ws("", *[F.when((s < F.col("slot")) == F.lit(left), d) for s, d in found])
    return out.select(*own.columns, side(True).alias("before"), side(False).alias("after"))


def _grow(nodes: DataFrame, arity: int, tag: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """The levels of all trees from their leaves (tree, place, size, digest, ...) up: runs of each level, and the trees whose top stands at it."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels, tops = [], []
    while most:
        tops.append(nodes.where("size = 1").select("tree", "digest"))
        if most == 1:
            break
        levels.append(materialize(_runs(nodes.where("size > 1"), arity), f"{tag}-{len(levels)}"))
        first = levels[-1].where("slot = 0")
        nodes = first.select("tree", F.col("run").alias("place"), F.expr(f"(size + {arity - 1}) div {arity}").alias("size"), F.sha2(F.concat("digest", "after").cast("binary"), 256).alias("digest"))
        most = -(-most // arity)
    return levels, tops


def _hand_down(levels: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """The leaves of trees with more than one, each with the columns of its tree's top and its proof: its own level first, the top's proof last.
    tops: tree, height, proof and the ``carried`` columns."""
    top = lambda h: tops.where(F.col("height") == h).select("tree", F.lit(0).cast("long").alias("place"), "proof", *carried)
    above = top(len(levels))
    for h in range(len(levels) - 1, -1, -1):
        parents = above.select(F.col("tree").alias("_tree"), F.col("place").alias("_run"), F.col("proof").alias("_proof"), *carried)
        own = levels[h].select(*[c for c in levels[h].columns if c not in ("run", "slot", "before", "after", "size")], "run", F.array(F.struct("before", "after")).alias("_own"))
        below = own.join(parents, (F.col("tree") == F.col("_tree")) & (F.col("run") == F.col("_run"))).withColumn("proof", F.concat("_own", "_proof")).drop("run", "_own", "_tree", "_run", "_proof")
        if h == 0:
            return below
        above = below.select("tree", "place", "proof", *carried).unionByName(top(h))


_PROOF = "array<struct<before: string, after: string>>"


def manifest(docs: DataFrame, arity: int = ARITY, **carry: Column) -> DataFrame:
    """doc_id, leaf, subroot (of its source), root, proof, and the columns ``carry`` computed from the document's row.

    ``proof`` has an element for each level on the way to the root: the digests ``before`` and ``after`` the node in its run."""
    leaves = docs.select(*FIELDS).select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf().alias("digest"), *[c.alias(n) for n, c in carry.items()])
    leaves = _placed(materialize(leaves, "leaves"), "source", ["doc_id", "digest"], "places").drop("source")
    leaves = materialize(leaves, "trees")
    levels, tops = _grow(leaves, arity, "level")
    columns = ["doc_id", *carry]
    if not tops:
        return leaves.select("doc_id", F.col("digest").alias("leaf"), F.lit("").alias("subroot"), F.lit("").alias("root"), F.expr(f"cast(array() as {_PROOF})").alias("proof"), *carry)
    roots = tops[0].withColumn("height", F.lit(0))
    for h, t in enumerate(tops[1:], 1):
        roots = roots.unionByName(t.withColumn("height", F.lit(h)))
    roots = roots.select(F.col("tree").alias("of"), "digest", "height", F.col("digest").alias("subroot"))
    roots = materialize(_placed(roots, None, ["of"], "subroots"), "roots")
    upper, top = _grow(roots, arity, "upper")
    root = top[-1].first()["digest"]
    highest = top[-1].select("tree", F.lit(len(upper)).alias("height"), F.expr(f"cast(array() as {_PROOF})").alias("proof"))
    if upper:
        roots = _hand_down(upper, highest, [])
    else:
        roots = roots.withColumn("proof", F.expr(f"cast(array() as {_PROOF})"))
    roots = materialize(roots.select(F.col("of").alias("tree"), "height", "subroot", "proof"), "subproofs")
    lone = leaves.where("size = 1").join(roots.select("tree", "subroot", "proof"), "tree")
    out = lone.select(*columns, "digest", "subroot", "proof")
    if levels:
        out = out.unionByName(_hand_down(levels, roots, ["subroot"]).select(*columns, "digest", "subroot", "proof"))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).alias("root"), "proof", *carry)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof give."""
    return F.aggregate(proof, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def tampered_leaf() -> Column:
    """The leaf of a document whose text lost its line feeds, where 2 divides the CRC-32 of its id; else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(chosen & F.contains("text", F.lit("\n")), leaf(text=F.replace(F.col("text"), F.lit("\n"), F.lit(""))))


def audit(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, and what its proofs say of the tampered ones."""
    found = manifest(docs, tampered=tampered_leaf()).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root")).drop("tampered")
