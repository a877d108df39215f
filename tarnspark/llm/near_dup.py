"""MinHash near-dedup by Order MinHash with verification by banded alignment.

A text is its sequence of 5-word shingles (lower-cased words), each labelled with its occurrence number. Each of ``SKETCHES`` hash
functions picks the ``PICKS`` least labelled shingles and keeps them in text order: two texts agree on a sketch with a
chance that follows their edit similarity (about s**3; 16 sketches miss a pair of similarity 0.8 once in 80,000). The pairs that
share a sketch are verified by a banded alignment (longest common subsequence within the band that similarity 0.8 allows) of
the shingle sequences: common / (a + b - common) >= 0.8.

Equal texts are first folded into one representative. A sketch shared by up to ``SMALL`` representatives gives all its pairs. In a larger one each
member meets the hub, the member that shares most sketches with others, and two more; where that leaves several components, the sketch is split by the members'
next sketches, each part with a hub of its own, ``LEVELS`` times. Members that no hub took are then compared with all members of the large sketches they are in, and of
those members' components, by an exact prefix-filter join on their rarest shingles (rare by a counter table of fixed size, so only prefixes are shuffled). No step pairs the members of a large sketch that a hub took with each other.

Defined cases: texts with under five words have one shingle, all their words; texts without words (null, empty) are their own
class; rows without a doc_id get no class; repeated rows of a doc_id share a class, and if their texts differ the least text is the one verified;
a very long text is aligned within its band; an empty table gives none; other columns, of whatever name, aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnspark.llm.common import drop, lookup, materialize, salted_join
from tarnspark.llm.components import components
from tarnspark.llm.words import Hashes, fold_words, grams, mix

SHINGLE, SIMILARITY, SKETCHES, PICKS, SMALL, LEVELS = 5, 0.8, 16, 3, 16, 1
#: Counters of shingles, 4 bytes each, that the prefix filter sends to every task.
SLOTS = 1 << 20
#: Pairs of one document whose texts one task compares.
TEXT_PAIRS = 50_000
_MULTIPLIERS = mix(np.arange(SKETCHES, dtype=np.uint64), 77) | np.uint64(1)
_SKETCH = "doc_id long, content binary, n int, sketch array<long>"


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles in text order; a short text is one shingle."""
    return grams(words, min(SHINGLE, max(1, len(words))))


def labelled(g: np.ndarray) -> np.ndarray:
    """Shingles mixed with their occurrence numbers."""
    order = np.argsort(g, kind="stable")
    s = g[order]
    first = np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, bool)
    if first.all():
        return g
    number = np.arange(len(s)) - np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    out = np.empty_like(g)
    with np.errstate(over="ignore"):
        out[order] = np.where(number == 0, s, mix(s + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 5))
    return out


def order_minhash(g: np.ndarray, picks: int = PICKS) -> list[int]:
    """The sketches of a shingle sequence: a 64-bit number for each hash function."""
    if not len(g):
        return []
    h = labelled(g)
    k = min(picks, len(h))
    out = np.zeros(SKETCHES, np.uint64)
    step = max(1, 2_000_000 // len(h))
    with np.errstate(over="ignore"):
        for s in range(0, SKETCHES, step):
            v = h[None, :] * _MULTIPLIERS[s : s + step, None]
            at = np.argpartition(v, k - 1, axis=1)[:, :k] if k < len(h) else np.tile(np.arange(len(h)), (len(v), 1))
            at.sort(axis=1)  # text order
            key = np.zeros(len(v), np.uint64)
            for j in range(k):
                key = mix(key * np.uint64(31) + h[at[:, j]], 3)
            out[s : s + step] = key
    return out.astype(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Common / (a + b - common) by a banded alignment of two shingle sequences; 0 if it can't reach ``least``."""
    n, m = len(a), len(b)
    need = least / (1 + least) * (n + m)  # shingles in common
    if not n or not m or min(n, m) < need - 1e-9:
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    tail_a, tail_b = a[head:], b[head:]
    short = min(len(tail_a), len(tail_b))
    differ = np.flatnonzero(tail_a[len(tail_a) - short :][::-1] != tail_b[len(tail_b) - short :][::-1])
    foot = int(differ[0]) if len(differ) else short
    mid_a, mid_b = tail_a[: len(tail_a) - foot].tolist(), tail_b[: len(tail_b) - foot].tolist()
    common = head + foot
    if mid_a and mid_b:
        band = int(n + m - 2 * need) + 1  # insertions and deletions that the similarity allows
        place: dict[int, int] = {}
        for i, x in enumerate(mid_a):
            place[x] = place.get(x, 0) | (1 << i)
        row = (1 << len(mid_a)) - 1
        full, width = row, (1 << (2 * band + 1)) - 1
        for j, y in enumerate(mid_b):
            p = place.get(y)
            if p:
                u = row & p & (width << (j - band) if j >= band else width >> (band - j))
                row = ((row + u) | (row - u)) & full
        common += len(mid_a) - row.bit_count()
    s = common / (n + m - common)
    return s if s >= least - 1e-12 else 0.0


def _sketch(batches):
    cache = Hashes()
    for b in batches:
        content, n, sketch = [], [], []
        for text in b.column("text").to_pylist():
            words = fold_words(text)
            g = shingles(cache.of(words))
            content.append(xxhash.xxh3_128_digest(b" ".join(words)))
            n.append(len(g))
            sketch.append(order_minhash(g))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(content, pa.binary()), pa.array(n, pa.int32()), pa.array(sketch, pa.list_(pa.int64()))], ["doc_id", "content", "n", "sketch"])


def _verify(batches):
    cache = Hashes()
    for b in batches:
        keep = []
        for x, y in zip(b.column("text_a").to_pylist(), b.column("text_b").to_pylist(), strict=True):
            keep.append(similarity(shingles(cache.of(fold_words(x))), shingles(cache.of(fold_words(y)))) > 0)
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar. Only texts of documents in pairs are moved, and the pairs of a document that has many, as hubs do, are dealt to several tasks."""
    ids = materialize(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ids")
    own = docs.join(lookup(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    own = materialize(own, "texts")
    left, right = own.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), own.withColumnsRenamed({"doc_id": "b", "text": "text_b"})
    both = salted_join(salted_join(pairs, left, "a", "b", TEXT_PAIRS), right, "b", "a", TEXT_PAIRS, keys=pairs)
    good = materialize(both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long"), "links")
    drop(ids)
    drop(own)
    return good


_MEMBER = ("id", "n", "comp")
#: What similarity asks of two shingle counts.
_NEAR = "x.id != y.id and x.comp != y.comp and 10 * least(x.n, y.n) >= 8 * greatest(x.n, y.n)"
#: common / (n + m - common) >= 0.8 in whole numbers; ``left`` counts the shingles from a place on.
_REACH = "9 * least(x.left, y.left) >= 4 * (x.n + y.n)"


def _counted(rows: DataFrame) -> DataFrame:
    """The rows whose key occurs more than once, with its count c."""
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "key")


def _pairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of buckets (key, band, id, n, comp, weight, c) and the rows of large buckets with their hub: all pairs of
    a small bucket; in a large one each member and the hub, the member of most weight, and two members by chance, whose groups then are one in the exact join, however
    many links they have. Only small buckets are gathered; large ones meet a table of hubs."""
    small = rows.where(F.col("c") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list(F.struct(*_MEMBER))).alias("m"))
    small = small.select(F.posexplode("m").alias("i", "x"), "m").select("x", F.explode(F.slice("m", F.col("i") + 2, F.lit(SMALL))).alias("y"))
    large = rows.where(F.col("c") > SMALL)
    chance = F.struct(F.xxhash64("key", "id").alias("draw"), *_MEMBER)
    hubs = large.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("low"), *_MEMBER)).alias("hub"), F.min(chance).alias("low"), F.max(chance).alias("high"))
    hubs = materialize(hubs.select("key", F.array(*[F.struct(*[F.col(f"{h}.{m}").alias(m) for m in _MEMBER]) for h in ("hub", "low", "high")]).alias("hubs")), "hubs")
    large = materialize(large.join(lookup(hubs), "key").select("key", "band", "id", "n", "comp", "weight", "hubs"), "large")
    drop(hubs)
    pairs = small.unionByName(large.select(F.explode("hubs").alias("x"), F.struct(*_MEMBER).alias("y"))).where(_NEAR)
    pairs = materialize(pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), "pairs")
    return pairs, large.select("key", "band", "id", "n", "weight", F.col("hubs")[0]["id"].alias("hub"))


def shingle_counts(docs: DataFrame) -> np.ndarray:
    """Upper bounds of how often each labelled shingle occurs: a table of ``SLOTS`` counters, whatever the number of documents."""

    def run(batches):
        cache, total, held, size = Hashes(), np.zeros(SLOTS, np.int64), [], 0
        for b in batches:
            for text in b.column("text").to_pylist():
                held.append((labelled(shingles(cache.of(fold_words(text)))) & np.uint64(SLOTS - 1)).astype(np.int64))
                size += len(held[-1])
                if size > SLOTS:
                    total += np.bincount(np.concatenate(held), minlength=SLOTS)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["slot", "n"])

    rows = docs.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n")).where("n > 1").toArrow()
    out = np.ones(SLOTS, np.int32)
    out[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return out


def prefix(g: np.ndarray, counts: np.ndarray, least: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """(places, labelled shingles) of the first n - 0.8 n + 1 from the rarest on, without those that no other text has."""
    h = labelled(g)
    f = counts[(h & np.uint64(SLOTS - 1)).astype(np.int64)]
    order = np.lexsort((h, f))[: len(h) - int(np.ceil(len(h) * least - 1e-9)) + 1]
    at = np.flatnonzero(f[order] > 1)
    return at, h[order[at]]


def prefix_pairs(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """All pairs of documents (id, comp, and open, if only pairs with an open one are wanted) that can be similar, without two of one component: of n shingles in one order of all shingles, similar texts
    share one of the first n - 0.8 n + 1, and from the first one that they share, at places i and j, no more than least(n - i, m - j)
    shingles can be common, which must reach what similarity asks. The order is by the counters of ``shingle_counts``, then by hash, the same in every task; a shingle that
    many documents share stands early in few of them. Only prefixes are shuffled."""
    ids = ids if "open" in ids.columns else ids.withColumn("open", F.lit(True))
    own = docs.join(lookup(ids.withColumnRenamed("id", "doc_id")), "doc_id").select("doc_id", "text", "comp", "open")
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(own))

    def run(batches):
        cache = Hashes()
        for b in batches:
            rows: list[list[np.ndarray]] = [[], [], [], []]
            for i, text in enumerate(b.column("text").to_pylist()):
                g = shingles(cache.of(fold_words(text)))
                at, h = prefix(g, counts.value)
                for held, x in zip(rows, (np.full(len(at), i), np.full(len(at), len(g), np.int32), (len(g) - at).astype(np.int32), h.view(np.int64)), strict=True):
                    held.append(x)
            if rows[0]:
                which, n, left, h = (np.concatenate(x) for x in rows)
                named = [b.column(c).take(pa.array(which)) for c in ("doc_id", "comp", "open")]
                yield pa.RecordBatch.from_arrays([*named, pa.array(n), pa.array(left), pa.array(h)], ["id", "comp", "open", "n", "left", "shingle"])

    shared = own.mapInArrow(run, "id long, comp long, open boolean, n int, left int, shingle long").select("shingle", "open", F.struct("id", "n", "comp", "left").alias("x"))
    shared = materialize(shared, "prefixes")
    opened = shared.where("open").select("shingle", "x")
    pairs = opened.join(shared.select("shingle", F.col("x").alias("y"), F.col("open").alias("both")), "shingle").where("x.id < y.id or not both").where(_NEAR).where(_REACH)
    found = materialize(pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), "pairs")
    drop(shared)
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id, the least doc_id of its class, of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = materialize(slim.mapInArrow(_sketch, _SKETCH), "sketches")
    named = sketches.where("doc_id is not null and n > 0")
    folded = materialize(named.groupBy("content").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("r")).select("content", F.col("r.doc_id").alias("id"), F.col("r.n").alias("n"), F.col("r.sketch").alias("sketch")), "folded")

    rows = folded.select("id", "n", F.posexplode("sketch").alias("band", "v")).select(F.xxhash64("band", "v").alias("key"), "band", "id", "n", F.col("id").alias("comp"))
    # only sketches that occur twice matter from here on; a document's weight is how many others share its sketches
    shared = materialize(_counted(rows), "shared")
    weights = shared.where(F.col("c") > SMALL).groupBy("id").agg(F.sum("c").alias("weight"))
    rows = shared.join(weights, "id", "left").select("key", "band", "id", "n", "comp", F.coalesce("weight", F.lit(0)).alias("weight"), "c")
    links = comps = first = None
    for level in range(LEVELS + 1):
        pairs, large = _pairs(rows)
        drop(shared)
        found = verify(pairs, slim)
        drop(pairs)
        links = found if links is None else links.unionByName(found)
        drop(comps)
        comps = components(links)
        first = large if first is None else first
        named_large = large.join(comps, "id", "left").select("key", "band", "id", "n", "weight", F.coalesce("comp", "id").alias("comp"))
        mixed = named_large.groupBy("key").agg((F.min("comp") != F.max("comp")).alias("mixed")).where("mixed").select("key")
        if level == LEVELS or not mixed.limit(1).count():
            break
        rest = materialize(named_large.join(mixed, "key", "left_semi"), "mixed")
        # split by one more sketch, the next band's
        nxt = F.element_at("sketch", ((F.col("band") + level + 1) % SKETCHES + 1).cast("int"))
        rows = rest.join(folded.select("id", "sketch"), "id").select(F.xxhash64("key", nxt).alias("key"), "band", "id", "n", "comp", "weight")
        rows = shared = materialize(_counted(rows), "shared")
        drop(rest)
    if first.limit(1).count():
        # members of large sketches that no hub took
        hubs = comps.select(F.col("id").alias("hub"), F.col("comp").alias("hub_comp"))
        met = first.join(comps, "id", "left").join(hubs, "hub", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"), F.coalesce("hub_comp", "hub").alias("hub_comp"))
        met = materialize(met, "met")
        alone = met.where("comp != hub_comp").select("id").distinct()
        # the members of their sketches and all that are connected to these
        near = met.join(met.where("comp != hub_comp").select("key").distinct(), "key", "left_semi").select("comp").distinct()
        every = folded.select("id").join(comps, "id", "left").select("id", F.coalesce("comp", "id").alias("comp")).join(near, "comp", "left_semi")
        every = materialize(every.join(alone.withColumn("open", F.lit(True)), "id", "left").select("id", "comp", F.coalesce("open", F.lit(False)).alias("open")), "alone")
        drop(met)
        if every.where("open").limit(1).count():
            pairs = prefix_pairs(every, slim)
            links = links.unionByName(verify(pairs, slim))
            drop(pairs)
            drop(comps)
            comps = components(links)
        drop(every)
    classes = folded.join(comps, "id", "left").select("content", F.coalesce("comp", "id").alias("class_id"))
    out = named.select("doc_id", "content").join(classes, "content").select("doc_id", "class_id")
    return out.unionByName(sketches.where("doc_id is null or n = 0").select("doc_id", F.col("doc_id").alias("class_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: the one with the least doc_id. Documents without an id have no
    class and go; of several rows with one doc_id the one with the least text stays, then the one whose columns are the least as JSON."""
    kept = near_duplicates(docs).where("doc_id = class_id").groupBy("doc_id").agg(F.count("*").alias("_n"))
    kept = materialize(kept, "kept")
    once = docs.join(kept.where("_n = 1").select("doc_id"), "doc_id", "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    twice = docs.join(lookup(kept.where("_n > 1").select("doc_id")), "doc_id", "left_semi")
    twice = twice.groupBy("doc_id").agg(F.min_by(row, F.struct("text", F.to_json(row))).alias("_row")).select("_row.*")
    return once.unionByName(twice)
