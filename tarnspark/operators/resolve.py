"""Entity resolution: exact first-wins lookup, then a blocked fuzzy match for what it missed, then reviews.

The fuzzy match never pairs a whole block: both sides are joined on (block, token) for the tokens of their rarest-first
prefixes, which are as long as the threshold needs, so that frequent tokens of a big block stay out of the join; the places of a shared
token bound what a pair can still reach. Stop words join like others; the score counts a pair as 0 if it shares nothing else.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnspark.functions import rules
from tarnspark.functions.text import normalize_name, slug, text_or_empty, tokens
from tarnspark.functions.urls import profile_link, without_fragment
from tarnspark.operators.keyed import first_by, nest_top

THRESHOLD = 0.7


def with_keys(df: DataFrame, name: str, city: str, state: str) -> DataFrame:
    """state, city_slug, name_norm and name_tokens columns."""
    keyed = df.withColumns({"state_key": F.upper(text_or_empty(F.col(state))), "city_slug": slug(F.col(city)), "name_norm": normalize_name(F.col(name))})
    return keyed.withColumn("name_tokens", tokens(F.col("name_norm")))


def indexable(df: DataFrame) -> DataFrame:
    """Rows with a state, a city and a name."""
    return df.where("state_key != '' and city_slug != '' and name_norm != ''")


def score(a: Column, b: Column, stop=rules.STOP_TOKENS) -> Column:
    """Jaccard similarity of two token sets, 0 if they share stop words only."""
    shared = F.array_intersect(a, b)
    telling = F.size(F.array_except(shared, F.array(*[F.lit(s) for s in stop]))) > 0 if stop else F.size(shared) > 0
    return F.when(telling, F.size(shared) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def plain_score(a: Column, b: Column) -> Column:
    return score(a, b, ())


def exact_match(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, ordinal: str) -> DataFrame:
    """left_id, right_id: the first right row (least ordinal) with the same keys. One aggregate, then an equi-join."""
    first = right.groupBy(*keys).agg(F.min(F.struct(ordinal, right_id)).alias("_first"))
    return left.select(left_id, *keys).join(first, keys).select(left_id, F.col(f"_first.{right_id}").alias(right_id))


def candidate_lists(right: DataFrame, keys: list[str], fields: list[str], ordinal: str, most: int = 100) -> DataFrame:
    """keys and candidates, the first ``most`` rows of each key in order of ``ordinal``. The bound keeps a hot key from being one huge cell; matching never
    needs more than the first."""
    return nest_top(right, keys, [F.asc(ordinal)], fields, most, "candidates")


def profile_candidates(links: DataFrame, key: str, href: str, ordinal: str, host: str, pattern: str, most: int = 5) -> DataFrame:
    """key, href, ordinal: the first ``most`` distinct profile links of each key, without fragments."""
    found = links.where(profile_link(F.col(href), host, pattern)).select(key, without_fragment(F.col(href)).alias(href), ordinal)
    return first_by(found.groupBy(key, href).agg(F.min(ordinal).alias(ordinal)), [key], [F.asc(ordinal), F.asc(href)], most)


def fuzzy_match(left: DataFrame, right: DataFrame, block: list[str], left_id: str, right_id: str, ordinal: str, tokens: str = "name_tokens", threshold: float = THRESHOLD, stop=rules.STOP_TOKENS) -> DataFrame:
    """left_id, right_id, score: the best right row of the block from ``threshold`` on, ties to the least ordinal.

    A pair of at least ``threshold`` shares all but a few tokens: of a set of n tokens at most n - ceil(threshold * n) are not shared,
    so some shared token is among the first n - ceil(threshold * n) + 1 of any fixed order. Both sides explode that prefix in order of
    frequency within the right side's block, rarest first. Rows of a side with the same tokens in a block are matched once: on the right the one of the least
    ordinal stands for them, on the left each gets what their tokens found.
    """
    of = F.array_sort(F.array_distinct(tokens)).alias("_set")
    asked = left.where((F.size(tokens) > 0) & F.col(left_id).isNotNull()).select(F.col(left_id).alias("_left"), *block, of)
    known = right.where(F.size(tokens) > 0).select(F.struct((-F.col(ordinal)).alias("_neg"), F.col(right_id).alias("_r")).alias("_first"), *block, of)
    lefts = asked.select(*block, F.col("_set").alias("_a")).distinct()
    rights = known.groupBy(*block, F.col("_set").alias("_b")).agg(F.max("_first").alias("_first"))
    sets = _fuzzy_sets(lefts, rights, block, threshold, stop).withColumnRenamed("_a", "_set")
    best = asked.join(sets, [*block, "_set"]).groupBy("_left").agg(F.max("_best").alias("_best"))
    return best.select(F.col("_left").alias(left_id), F.col("_best._first._r").alias(right_id), "_best.score")


MOST_SUBSETS = 64  # a set with more subsets that may be shared is matched by prefixes


def _shared(n: int, m: int, threshold: float) -> list[int]:
    """How many tokens sets of n and m may share at ``threshold``."""
    return [i for i in range(1, min(n, m) + 1) if i / (n + m - i) >= threshold]


def _subsets(threshold: float) -> tuple[int, list[tuple], list[tuple]]:
    """The largest size of sets that are matched by subsets, then (n, m, mask, score) for a left set of n tokens and right ones of m, and (m, mask) for right sets."""

    def most(short):
        kinds = [[(m, i) for m in range(1, short + 1) for i in _shared(n, m, threshold)] for n in range(1, short + 1)]
        return max(sum(math.comb(n + 1, i) for _, i in kind) for n, kind in enumerate(kinds))

    short = 1
    while most(short + 1) <= MOST_SUBSETS:
        short += 1
    shared = [(n, m, i) for n in range(1, short + 1) for m in range(1, short + 1) for i in _shared(n, m, threshold)]
    masks = lambda n, i: [sum(1 << x for x in c) for c in itertools.combinations(range(n), i)]
    return short, [(n, m, mask, i / (n + m - i)) for n, m, i in shared for mask in masks(n, i)], sorted({(m, mask) for n, m, i in shared for mask in masks(m, i)})


def _fuzzy_sets(a: DataFrame, b: DataFrame, block: list[str], threshold: float, stop) -> DataFrame:
    """block, _a and ``_best`` (score, _first), the best right set for each left one: ``a`` (block, _a) and ``b`` (block, _b, _first) have a row for each set of tokens.

    Two short sets are matched by what they share: a score follows from both sizes and the number of shared tokens, so the first right set of each size and subset is all that a
    left set with this subset needs, and no pairs are formed. A subset of what a pair shares scores it too low, all that it shares is a subset too, and the highest score counts.
    """
    short, asked, known = _subsets(threshold)
    spark = a.sparkSession
    x = _signed(a, "_a", spark.createDataFrame(asked, "_n int, _m int, _mask int, score double"), "_n", short, stop)
    y = _signed(b, "_b", spark.createDataFrame(known, "_m int, _mask int"), "_m", short, stop)
    firsts = y.groupBy(*block, "_m", "_key").agg(F.max("_first").alias("_first"))
    near = x.join(firsts, [*block, "_m", "_key"]).select(*block, "_a", F.struct("score", "_first").alias("_best"))
    return near.unionByName(_long_pairs(a, b, block, threshold, stop, short)).groupBy(*block, "_a").agg(F.max("_best").alias("_best"))


def _signed(sets: DataFrame, own: str, masks: DataFrame, size: str, short: int, stop) -> DataFrame:
    """Each set of at most ``short`` tokens with the ``_key`` of each of its subsets in ``masks`` that doesn't consist of stop words."""
    words = F.transform(own, lambda t: F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")))
    sets = sets.where(F.size(own) <= short).withColumns({size: F.size(own), "_words": words, "_telling": F.transform(own, lambda t: ~F.coalesce(t.isin(list(stop)), F.lit(False)))})
    bit = lambda i: F.col("_mask").bitwiseAND(F.lit(1 << i)) != 0
    parts = sets.join(F.broadcast(masks), size)
    telling = functools.reduce(operator.or_, [bit(i) & F.get("_telling", F.lit(i)) for i in range(short)])
    key = F.concat_ws(" ", *[F.when(bit(i), F.get("_words", F.lit(i))) for i in range(short)])
    return parts.where(telling).withColumn("_key", key).drop("_words", "_telling", "_mask")


def _long_pairs(a: DataFrame, b: DataFrame, block: list[str], threshold: float, stop, short: int) -> DataFrame:
    """block, _a and ``_best`` for pairs with a set of over ``short`` tokens, by prefixes. Sets that no size of the other side pairs with stay out."""
    n, m = F.col("_n"), F.col("_m")
    near = (m + 1e-9 >= threshold * n) & (n + 1e-9 >= threshold * m) & (F.greatest(n, m) > short)
    sizes_a, sizes_b = a.select(F.size("_a").alias("_n")).distinct(), b.select(F.size("_b").alias("_m")).distinct()
    sizes = F.broadcast(sizes_a).join(F.broadcast(sizes_b), near)
    a = a.withColumn("_n", F.size("_a")).join(F.broadcast(sizes.select("_n").distinct()), "_n").drop("_n")
    b = b.withColumn("_m", F.size("_b")).join(F.broadcast(sizes.select("_m").distinct()), "_m").drop("_m")
    frequency = b.select(*block, F.explode("_b").alias("_t")).groupBy(*block, "_t").agg(F.count("*").alias("_f"))

    def prefix(df, own, size, left):
        exploded = df.select(*block, own, F.size(own).alias(size), F.explode(own).alias("_t")).join(frequency, [*block, "_t"], "left")
        place = F.row_number().over(Window.partitionBy(*block, own).orderBy(F.coalesce("_f", F.lit(0)), "_t"))
        kept = exploded.withColumn("_place", place).where(F.col("_place") <= F.col(size) - F.ceil(F.col(size) * F.lit(threshold) - 1e-9) + 1)
        return kept.select(*block, own, "_t", size, (F.col(size) - F.col("_place") + 1).alias(left))

    x, y = prefix(a, "_a", "_n", "_left_a"), prefix(b, "_b", "_m", "_left_b")
    # from the first shared token on, no more than the tokens that are left on either side can be shared
    near &= F.least("_left_a", "_left_b") * (1 + threshold) + 1e-9 >= threshold * (n + m)
    pairs = x.join(y, [*block, "_t"]).where(near).select(*block, "_a", "_b").distinct()
    scored = pairs.withColumn("score", score(F.col("_a"), F.col("_b"), stop)).where(F.col("score") >= threshold)
    return scored.join(b, [*block, "_b"]).select(*block, "_a", F.struct("score", "_first").alias("_best"))


def match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, ordinal: str, threshold: float = THRESHOLD, stop=rules.STOP_TOKENS) -> DataFrame:
    """left_id, right_id, score, how: exact on (state, city, name), else fuzzy in (state, city). Both sides come from ``with_keys``;
    nameless rows and unknown states match nothing."""
    known, place = indexable(right), ["state_key", "city_slug"]
    asked = left.where("name_norm != ''")
    first = known.groupBy(*place, "name_norm").agg(F.min(F.struct(ordinal, right_id)).alias("_exact"))
    looked_up = asked.join(first, [*place, "name_norm"], "left")
    exact = looked_up.where("_exact is not null").select(left_id, F.col(f"_exact.{right_id}").alias(right_id), F.lit(1.0).alias("score"), F.lit("exact").alias("how"))
    fuzzy = fuzzy_match(looked_up.where("_exact is null"), known, place, left_id, right_id, ordinal, threshold=threshold, stop=stop).withColumn("how", F.lit("fuzzy"))
    return exact.unionByName(fuzzy.join(exact.select(left_id), left_id, "left_anti"))


def top_reviews(reviews: DataFrame, wanted: DataFrame, key: str, order: list[Column], n: int = 100) -> DataFrame:
    """The first ``n`` reviews of each wanted key. The semi-join comes before the ranking; Spark broadcasts the
    wanted keys if they are small."""
    return first_by(reviews.join(wanted.select(key).distinct(), key, "left_semi"), [key], order, n, rank="rank")


def match_table(matches: DataFrame, businesses: DataFrame, nested: DataFrame, key: str, business: str, reviews_type: str) -> DataFrame:
    """Matches with the business's columns and its reviews, an empty array where it has none."""
    return matches.join(businesses, business).join(nested, business, "left").withColumn("reviews", F.coalesce("reviews", F.expr(f"cast(array() as {reviews_type})")))


def uncovered(wanted: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Wanted keys that a materialised table lacks."""
    return wanted.select(key).distinct().join(covered.select(key), key, "left_anti")


def fallback(base: DataFrame, layers: list[DataFrame], key: str, value: str, columns: list[str]) -> DataFrame:
    """``columns`` from the first layer with a non-null ``value``, and the layer's number (null where none has one)."""
    out = base
    for i, layer in enumerate(layers):
        out = out.join(layer.where(F.col(value).isNotNull()).select(key, F.struct(F.lit(i).alias("layer"), *columns).alias(f"_layer{i}")), key, "left")
    best = F.coalesce(*[F.col(f"_layer{i}") for i in range(len(layers))])
    return out.withColumn("_best", best).select(*base.columns, F.col("_best.layer").alias("layer"), *[F.col(f"_best.{c}").alias(c) for c in columns if c not in base.columns])
