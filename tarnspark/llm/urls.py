"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join.

A canonical URL is the host without a leading ``www.``, then the path without a trailing slash. A listed
entry without a path lists its host and all subdomains. The filter is built distributed (one row
for each block of 8 words of 32 bits, one bit set in each word, OR-ed by an aggregate) and sized from the count of
listed entries; its rows are broadcast up to ``FILTER_BLOCKS`` blocks, which bounds them in bytes, and joined
by a shuffle beyond it. Pages whose keys the filter passes go to the exact join, which removes false positives.

Defined cases: null urls and urls without ``://`` have empty host and path, fit no rule and are allowed;
repeated rows are judged one by one, null page_ids too; a very long url is judged whole; of rules that fit the longest decides, which is
never a tie; an empty list or table works; other columns, of whatever name, stay out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnspark.llm.common import lookup, materialize

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: The list of the production query; any DataFrame of urls can take its place.
LISTED = ("http://spam-farm.example.org/", "http://spam-farm.example.com/", "http://spam-farm.example.net/", "http://cheap-pills.example.com/", "http://cheap-pills.example.net/", "http://cheap-pills.example.org/", "http://casino-win.example.org/", "http://casino-win.example.net/", "http://casino-win.example.com/", "http://ads-track.example.org/", "http://ads-track.example.com/", "http://ads-track.example.net/", "http://free-bets.example.com/", "http://free-bets.example.net/", "http://free-bets.example.org/", "http://adult-x.example.com/", "http://adult-x.example.net/", "http://adult-x.example.org/")
KEYS_A_BLOCK, FILTER_BLOCKS = 16, 1 << 20
#: Odd multipliers that pick the bit in each of a block's words.
SALTS = tuple((0x2545F491 * (2 * i + 1)) % (1 << 30) | 1 for i in range(8))


def _lower(c: F.Column) -> F.Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: F.Column) -> F.Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: F.Column) -> F.Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(h: F.Column, p: F.Column, rule_host: str, rule_path: str) -> F.Column:
    return ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)


def rule_of(h: F.Column, p: F.Column, rules=RULES) -> tuple[F.Column, F.Column]:
    """The longest fitting rule and its verdict, null where none fits. Two that fit are suffixes and prefixes of the
    same url, so equal lengths of the joined text leave the longer host."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rh, rp, v in reversed(ordered):
        rule, verdict = F.when(fits(h, p, rh, rp), rh + rp).otherwise(rule), F.when(fits(h, p, rh, rp), v).otherwise(verdict)
    return rule, verdict


def _bare(h: F.Column) -> F.Column:
    return F.regexp_replace(h, r"^www\.", "")


def canonical(h: F.Column, p: F.Column) -> F.Column:
    return F.concat(_bare(h), F.regexp_replace(p, r"/+$", ""))


def keys(h: F.Column, p: F.Column) -> F.Column:
    """The list entries that would cover a url: itself, its host, and each parent domain."""
    labels = F.split(_bare(h), r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.array_distinct(F.array_append(hosts, canonical(h, p)))


def bloom_words(key: F.Column, n_blocks: int) -> tuple[F.Column, list[F.Column]]:
    """The block of a key and its bit in each of the block's words."""
    h = F.xxhash64(key)
    low = F.pmod(h, F.lit(1 << 32))  # times a salt of 30 bits: no overflow
    bits = [F.pow(F.lit(2), F.shiftrightunsigned(F.pmod(low * s, F.lit(1 << 32)), 27)).cast("long") for s in SALTS]
    return F.pmod(F.shiftrightunsigned(h, 32), F.lit(n_blocks)), bits


def build_filter(listed: DataFrame, n_blocks: int) -> DataFrame:
    """block, w0..w7 from a column ``key``."""
    block, bits = bloom_words(F.col("key"), n_blocks)
    return listed.groupBy(block.alias("block")).agg(*[F.bit_or(b).alias(f"w{i}") for i, b in enumerate(bits)])


def listed_hits(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct (host, path) pairs of ``pages`` (host, path) that a listed key covers."""
    names = listed.select(F.col("url").cast("string").alias("url")).where("url is not null").select(canonical(host(F.col("url")), path(F.col("url"))).alias("key")).where("key != ''").distinct()
    names = materialize(names, "listed")
    n_blocks = max(1, -(-names.count() // KEYS_A_BLOCK))
    bloom = lookup(build_filter(names, n_blocks), FILTER_BLOCKS)
    probe = pages.select("host", "path").where("host != ''").distinct().select("host", "path", F.explode(keys(F.col("host"), F.col("path"))).alias("key"))
    block, bits = bloom_words(F.col("key"), n_blocks)
    probe = probe.withColumn("at", block).join(bloom, F.col("at") == F.col("block"))
    passed = probe.where(reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(b) != 0 for i, b in enumerate(bits)]))
    return passed.select("host", "path", "key").join(names, "key", "left_semi").select("host", "path").distinct()


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url").cast("string")).alias("host"), path(F.col("url").cast("string")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = slim.withColumn("rule", rule).withColumn("by_rule", verdict)
    hits = listed_hits(judged.where("rule is null"), listed).withColumn("listed", F.lit(True))
    # urls with a rule or without a host are never looked up, so that they are no common key
    asked = F.col("rule").isNull() & (F.col("host") != "")
    looked_up = judged.where(asked).join(lookup(hits), ["host", "path"], "left").withColumn("by_rule", F.when(F.col("listed"), "block").otherwise("allow"))
    out = judged.where(~asked).unionByName(looked_up.select(*judged.columns))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit("allow")).alias("verdict"))


def default_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(u,) for u in LISTED], "url string")
