"""Quality rules: adaptive fences from mergeable quantile sketches per language and source.

``measure`` counts each whole text once. ``sketches`` holds, for each (lang, source) and measure, how many values lie in each of a row of bins that
widen by ``GROWTH``: a quantile read from it is at most that factor off, sketches merge by adding counts, and a rerun gives the same ones. They are partial
aggregates before the shuffle, so a hot source costs no more than a small one, and have some thousand bins at most. Sketches of languages
and of the corpus are sums of those of sources.

A fence lies ``REACH`` times as far from the median as the tail quantile that is a tenth of the documents from the end; where that is the
median itself, as for measures that are mostly zero, at the outer quantile; but ``REACH`` bins from the median at least, since a sketch tells no more. Quantiles of a source are
drawn towards those of its language as if ``PRIOR`` more documents had the language's, and a language's likewise towards the corpus's. No
cut-off in units of a measure is fixed. ``judge`` joins the fences back.

Defined cases: null or empty texts have no words and fail the base rule, and documents that do lend no values; a null lang or source is a
group of its own; repeated rows are judged one by one; a value at a fence stays within; a very long text is counted whole; an empty table gives an empty result; other
columns of the input, of whatever name, are not read.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnspark.llm.common import lookup, materialize
from tarnspark.llm.words import utf8

SYMBOLS = b"#*$%&|<>"
#: Documents that a source's quantiles are drawn towards its language's by.
PRIOR = 25
#: measure -> (whether it has a lower fence too, its outer quantile). Repeats and duplicate lines also occur in sound documents, so fewer go for them.
MEASURES = {"symbol_ratio": (False, 0.95), "dup_line_ratio": (False, 0.98), "repeat_ratio": (False, 0.98), "word_length": (True, 0.98)}
#: The lower quantiles (outer, tail), the median, the upper tail and the two outer ones, and the distance of a fence in those from the median to the tail.
LEVELS, REACH = (0.02, 0.1, 0.5, 0.9, 0.95, 0.98), 5.0
GROWTH = 1.01
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n + 2)
    base = len(seen)
    if base < 2_000_000:
        _, inverse, count = np.unique((ids[:-2] * base + ids[1:-1]) * base + ids[2:], return_inverse=True, return_counts=True)
    else:  # the three ids no longer fit one number
        _, inverse, count = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True, return_counts=True)
    again = count[inverse.ravel()] > 1
    hit = np.zeros(n + 2, bool)
    for j in range(3):
        hit[j : j + n] |= again
    return int(hit.sum())


_CONTINUATION = bytes(range(0x80, 0xC0))


def count_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    raw = utf8(text)
    words = raw.split()  # on bytes: exactly \x20 and \x09-\x0D
    lines = [x for x in raw.split(b"\n") if x.strip()]
    solid = b"".join(words)
    chars = len(solid) - (len(solid) - len(solid.translate(None, _CONTINUATION)))
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines)


def _measure(batches):
    for batch in batches:
        rows = [count_text(x) for x in batch.column("text").to_pylist()]
        counts = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 6
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("source"), *counts], ["doc_id", "lang", "source", *COUNTS, "n_lines"])


def measure(docs: DataFrame) -> DataFrame:
    """The counts of each document and the measures made from them."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_measure, _SCHEMA)


def _ratios(counts: DataFrame) -> DataFrame:
    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return counts.withColumns({"symbol_ratio": over("n_symbols", "word_chars"), "dup_line_ratio": over("n_dup_lines", "n_lines"), "repeat_ratio": over("n_repeat_words", "n_words"), "word_length": over("word_chars", "n_words")})


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


_ZERO = -(1 << 30)  # the bin of 0


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, m, bin, n: the values of each measure and group by bins, of the documents that pass the base rule."""
    step = math.log(GROWTH)
    bins = [F.struct(F.lit(i).alias("m"), F.when(F.col(m) > 0, F.ceil(F.ln(m) / step)).otherwise(_ZERO).cast("int").alias("bin")) for i, m in enumerate(MEASURES)]
    return _ratios(counts.where(~base_failed())).select("lang", "source", F.inline(F.array(*bins))).groupBy("lang", "source", "m", "bin").agg(F.count("*").alias("n"))


def _quantiles(sketch: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """The keys and m, renamed by ``tag``, with the group's documents and its quantiles: from bins' upper ends for the median and above, from lower ends below."""
    by = [*keys, "m"]
    merged = sketch.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    merged = merged.withColumn("upto", upto).withColumn("all", F.sum("n").over(Window.partitionBy(*by)))
    end = lambda low: F.when(F.col("bin") == _ZERO, 0.0).otherwise(F.pow(F.lit(GROWTH), F.col("bin") - low))
    first = [F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("all")), end(int(p < 0.5)))).alias(f"q{i}{tag}") for i, p in enumerate(LEVELS)]
    return merged.groupBy(*by).agg(F.max("all").alias(f"n{tag}"), *first).withColumnsRenamed({k: f"{k}{tag}" for k in by})


def fences(counts: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(lang, source) -> lower and upper fence of each measure."""
    sketch = materialize(sketches(counts), "sketches")
    own, lang, every = (_quantiles(sketch, k, t) for k, t in ((["lang", "source"], ""), (["lang"], "_lang"), ([], "_all")))
    rows = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_lang")) & (F.col("m") == F.col("m_lang"))).join(F.broadcast(every), F.col("m") == F.col("m_all"))  # every: a row a measure
    drawn = lambda q, n, to: (F.col(n) * F.col(q) + prior * to) / (F.col(n) + prior)
    outer_low, low, middle, high, *outer = (drawn(f"q{i}", "n", drawn(f"q{i}_lang", "n_lang", F.col(f"q{i}_all"))) for i in range(len(LEVELS)))
    strict = [i for i, (_, level) in enumerate(MEASURES.values()) if level == LEVELS[4]]
    outer_high = F.when(F.col("m").isin(strict), outer[0]).otherwise(outer[1])
    near = GROWTH**REACH
    most = F.greatest(F.when(high > middle * (1 + 1e-9), middle + REACH * (high - middle)).otherwise(outer_high), middle * near)
    least = F.least(F.when(low < middle * (1 - 1e-9), middle - REACH * (middle - low)).otherwise(outer_low), middle / near)
    rows = rows.select("lang", "source", "m", most.alias("most"), least.alias("least"))
    of = lambda i, c: F.max(F.when(F.col("m") == i, F.col(c)))
    out = [of(i, "most").alias(f"{m}_most") for i, m in enumerate(MEASURES)]
    out += [(of(i, "least") if two_sided else F.lit(float("-inf"))).alias(f"{m}_least") for i, (m, (two_sided, _)) in enumerate(MEASURES.items())]
    return rows.groupBy("lang", "source").agg(*out)


def within() -> F.Column:
    """Whether all measures are within the fences; those of a group without fences are."""
    return functools.reduce(operator.and_, [F.coalesce(F.col(m).between(F.col(f"{m}_least"), F.col(f"{m}_most")), F.lit(True)) for m in MEASURES])


def judge(docs: DataFrame, prior: float = PRIOR) -> DataFrame:
    """doc_id, the counts, base_failed and kept."""
    counts = materialize(measure(docs), "quality")
    limits = lookup(materialize(fences(counts, prior), "fences"))
    limits = limits.withColumnsRenamed({"lang": "lang_of", "source": "source_of"})
    joined = _ratios(counts).join(limits, F.col("lang").eqNullSafe(F.col("lang_of")) & F.col("source").eqNullSafe(F.col("source_of")), "left")
    return joined.withColumn("base_failed", base_failed()).select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & within()).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. A doc_id with several rows stays if each passes;
    documents without an id can't be named by a verdict and go."""
    bad = judge(docs).where("not kept").select("doc_id").distinct()
    return docs.where("doc_id is not null").join(bad, "doc_id", "left_anti")
