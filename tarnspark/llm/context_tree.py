"""Language-model scores by context-tree weighting over bytes, beside a base score of add-one unigrams.

The model. A byte is eight binary choices; a choice is a node of the byte's prefix under each context of 0 to ``DEPTH`` bytes before it. A node
has the counts of zeros and ones that the training texts show there, a Krichevsky-Trofimov estimate of them, and the weight with which the
tree stops at it: half of its own probability of all its counts over that of the mixture of it with its children. The probability of a byte
mixes the estimates of all depths along its context by these weights. Texts are lower-cased UTF-8 that begins after bytes 0xFF and ends with 0xFE, which
UTF-8 never holds; the score is the log10 probability of all bytes of a text with its end.

The work. One pass counts the strings of DEPTH + 1 bytes and the words of all texts. Tables of nodes, one for each depth, are aggregated upwards
(counts and probabilities) and joined downwards (mixtures), which gives the log probability of each string that any text has. A
second pass sums them for each text: the ``HELD`` most frequent strings and words, a table of fixed size at any input, are sent to the
tasks; a text's others are exploded and joined with their tables by a shuffle, as are all tables that grow with the texts, so that the driver holds no more at a larger input. No string or word that isn't held has more than 1 / HELD of all occurrences, so no key is hot.

Defined cases: a null or empty text is its end alone; a null doc_id isn't held out; repeated rows each count and score; a very long text is read in
pieces cut at white space; with no training text every probability is that of an empty tree (a half a bit) and the base has N = V = 0; an empty table
gives no rows; other columns, of whatever name, stay out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnspark.llm.common import materialize

DEPTH = 4
#: Strings, and words, that a task holds in memory.
HELD = 1 << 18
#: Words or strings of a task that wait before they are given on as partial counts.
WAITING = 1 << 19
#: Bytes of text worked on at once.
PIECE = 1 << 20
_PAD, _END = b"\xff", b"\xfe"
_SPACE = re.compile(rb"[ \t-\r]")
#: The end of a text as a word: no word is or begins with a space.
END_WORD = b" "
_LONG_WORD = 64
#: Whether a byte belongs to a word: white space and the end of a text don't.
_IN_WORD = np.array([i != 32 and not 9 <= i <= 13 and i != _END[0] for i in range(256)])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _word_key(word: bytes) -> bytes:
    """A word, or of a long one its digest after a space."""
    return word if len(word) <= _LONG_WORD else b" " + hashlib.sha256(word).digest()


def _pieces(text: bytes, depth: int) -> Iterator[bytes]:
    """Parts of a text with its end, each after the ``depth`` bytes before it and, but for the last, cut behind white space."""
    whole, at = _PAD * depth + text + _END, 0
    while True:
        cut = _SPACE.search(text, at + PIECE)
        to = cut.end() if cut else len(text)
        last = to == len(text)
        yield whole[at : to + depth + last]
        if last:
            return
        at = to


def _groups(texts: Iterator[str | None], depth: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Pieces of about PIECE bytes together, each with the number of its text."""
    at, group, held = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces((text or "").encode("utf-8", "surrogatepass").lower(), depth):
            at.append(i)
            group.append(piece)
            held += len(piece)
            if held >= PIECE:
                yield at, group
                at, group, held = [], [], 0
    if group:
        yield at, group


def _strings(group: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings that end at each byte of the pieces behind their contexts, the last byte lowest, and the number of them in each piece."""
    data = np.frombuffer(b"".join(group), dtype=np.uint8)
    n = np.array([len(p) for p in group])
    s = np.zeros(len(data), dtype=np.int64)
    for back in range(min(depth + 1, len(data))):
        s[back:] |= data[: len(data) - back].astype(np.int64) << (8 * back)
    own = np.ones(len(data), dtype=bool)
    starts = np.cumsum(n) - n
    for k in range(depth):
        own[starts + k] = False
    return s[own], n - depth


def _words(group: list[bytes], depth: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The number of each word of the pieces in a table of distinct ones, that table as keys, and how many words each piece has. Words are cut and told apart as arrays."""
    data = np.frombuffer(b"".join(group), dtype=np.uint8)
    n = np.array([len(p) for p in group])
    starts = np.cumsum(n) - n
    inside = _IN_WORD[data]
    for k in range(depth):
        inside[starts + k] = False
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    first, last = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
    distinct = found.dictionary
    long = np.flatnonzero(np.diff(np.frombuffer(distinct.buffers()[1], np.int32)[: len(distinct) + 1]) > _LONG_WORD).tolist() if len(distinct) else []
    if long:
        keys = distinct.to_pylist()
        for i in long:
            keys[i] = _word_key(keys[i])
        distinct = pa.array(keys, pa.binary())
    return found.indices.to_numpy(), distinct, np.diff(np.searchsorted(first, np.append(starts, len(data))))


def _summed(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return [keys[first], *[np.add.reduceat(c[order], first) for c in counts]]


_COUNTS = pa.schema([("string", pa.int64()), ("word", pa.binary()), ("seen", pa.int64()), ("total", pa.int64())])


def _count(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[pa.Table] = []
        ends_seen, ends_total, waiting = 0, 0, 0
        held: list[list[np.ndarray]] = []

        def strings_out() -> pa.RecordBatch:
            s, seen, total = held.pop()
            return pa.record_batch([pa.array(s), pa.nulls(len(s), pa.binary()), pa.array(seen), pa.array(total)], schema=_COUNTS)

        def merged() -> pa.Table:
            return pa.concat_tables(words).group_by("word", use_threads=False).aggregate([("seen", "sum"), ("total", "sum")]).select(["word", "seen_sum", "total_sum"]).rename_columns(["word", "seen", "total"])

        def words_out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for b in table.combine_chunks().to_batches():
                yield pa.record_batch([pa.nulls(b.num_rows, pa.int64()), *b.columns], schema=_COUNTS)

        for batch in batches:
            train = batch.column(0).to_pylist()
            for at, group in _groups(batch.column(1).to_pylist(), depth):
                s, n = _strings(group, depth)
                marked = np.sort((s << 1) | np.repeat([train[i] for i in at], n))
                first = np.flatnonzero(np.concatenate([[True], marked[1:] != marked[:-1]]))
                total = np.diff(np.append(first, len(marked)))
                marked = marked[first]
                new = [marked >> 1, total * (marked & 1), total]
                held.append(_summed(*[np.concatenate(c) for c in zip(held.pop(), new)]) if held else _summed(*new))
                if len(held[0][0]) > WAITING:
                    yield strings_out()
                number, distinct, each = _words(group, depth)
                marks = np.array([bool(train[i]) for i in at])
                ends = np.array([piece.endswith(_END) for piece in group])
                ends_seen, ends_total = ends_seen + int(np.count_nonzero(ends & marks)), ends_total + int(np.count_nonzero(ends))
                seen = np.bincount(number[np.repeat(marks, each)], minlength=len(distinct))
                words.append(pa.table([distinct, pa.array(seen), pa.array(np.bincount(number, minlength=len(distinct)))], ["word", "seen", "total"]))
                waiting += len(distinct)
                if waiting > WAITING:
                    words = [merged()]
                    waiting = len(words[0])
                    if waiting > WAITING // 2:
                        yield from words_out(words.pop())
                        waiting = 0
        if held:
            yield strings_out()
        if ends_total:
            words.append(pa.table([pa.array([END_WORD], pa.binary()), pa.array([ends_seen]), pa.array([ends_total])], ["word", "seen", "total"]))
        if words:
            yield from words_out(merged())

    return run


def _lgamma(z: Column) -> Column:
    """ln of the gamma function for z >= 0.5: Stirling's series at z + 8, less the factors in between. JVM arithmetic, right to about 1e-15 of its size."""
    y = z + 8
    factors = z
    for k in range(1, 8):
        factors = factors * (z + k)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7)))
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series - F.ln(factors)


def _with_estimates(nodes: DataFrame, deepest: bool) -> DataFrame:
    """node, n0, n1, log_p of all its counts in the mixture, and stop, the weight of its own estimate; ``below`` has the sum of its children's log_p."""
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    nodes = nodes.withColumn("own", _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1) - math.log(math.pi))
    if deepest:
        return nodes.select("node", "n0", "n1", F.col("own").alias("log_p"), F.lit(1.0).alias("stop"))
    most = F.greatest("own", "below")
    nodes = nodes.withColumn("log_p", most + F.log1p(F.exp(F.least("own", "below") - most)) - math.log(2))
    return nodes.select("node", "n0", "n1", "log_p", F.exp(F.col("own") - math.log(2) - F.col("log_p")).alias("stop"))


def _choices(strings: DataFrame) -> DataFrame:
    """The eight choices of each string's last byte: node (context, then the bits before as 1 to 255) and bit."""
    byte = F.col("string").bitwiseAND(255)
    rows = [F.struct(
        F.shiftleft(F.shiftright("string", 8), 8).bitwiseOR(F.lit(1 << k)).bitwiseOR(F.shiftright(byte, 8 - k)).alias("node"),
        F.shiftright(byte, 7 - k).bitwiseAND(1).alias("bit"),
    ) for k in range(8)]
    return strings.select("*", F.inline(F.array(*rows)))


def string_scores(strings: DataFrame, depth: int) -> DataFrame:
    """strings (string, seen, total) with ``score``, the log10 probability of the last byte after the ones before it."""
    bits = _choices(strings)
    nodes = bits.groupBy("node").agg(F.sum(F.col("seen") * (1 - F.col("bit"))).alias("n0"), F.sum(F.col("seen") * F.col("bit")).alias("n1"))
    levels = [materialize(_with_estimates(nodes, True), f"nodes-{depth}")]
    for d in range(depth - 1, -1, -1):
        up = levels[-1].groupBy(F.col("node").bitwiseAND((1 << (8 * d + 8)) - 1).alias("node")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_p").alias("below"))
        levels.append(materialize(_with_estimates(up, False), f"nodes-{d}"))
    levels.reverse()
    mixed = None
    for d, level in enumerate(levels):
        n = F.col("n0") + F.col("n1") + 1.0
        if mixed is None:
            level = level.withColumns({"above0": F.lit(0.0), "above1": F.lit(0.0), "rest": F.lit(1.0)})
        else:
            up = mixed.select(F.col("node").alias("_up"), F.col("p0").alias("above0"), F.col("p1").alias("above1"), F.col("left").alias("rest"))
            # a table's size on disk says little of its rows in memory: a deep level is not broadcast
            level = level.join(up.hint("merge") if d > 2 else up, F.col("node").bitwiseAND((1 << (8 * d)) - 1) == F.col("_up"))
        share = F.col("rest") * F.col("stop") / n
        mixed = level.select("node", (F.col("above0") + share * (F.col("n0") + 0.5)).alias("p0"), (F.col("above1") + share * (F.col("n1") + 0.5)).alias("p1"), (F.col("rest") * (1 - F.col("stop"))).alias("left"))
    taken = bits.join(mixed.select("node", "p0", "p1").hint("merge"), "node").groupBy("string").agg(F.sum(F.log10(F.when(F.col("bit") == 1, F.col("p1")).otherwise(F.col("p0")))).alias("score"), F.max("seen").alias("seen"), F.max("total").alias("total"))
    return materialize(taken.select("string", "seen", "total", "score"), "strings")


def most_frequent(rows: DataFrame, held: int) -> DataFrame:
    """At most ``held`` rows, those of the largest ``total``: counts of classes of totals say down to which one they fit."""
    total = F.col("total").cast("double")
    size = F.when(total <= 1024, total).otherwise(1024 + F.floor(16 * F.log2(total / 1024)) + 1).cast("long")
    classes = rows.groupBy(size.alias("c")).count().orderBy(F.desc("c")).collect()
    n, least = 0, None
    for r in classes:
        n += r["count"]
        if n > held:
            break
        least = r["c"]
    return rows.where(size >= least) if least is not None else rows.limit(0)


class _Held:
    """Scores of held strings, found through a table of slots in which the most frequent string of a slot stands, else by a search."""

    def __init__(self, strings: np.ndarray, scores: np.ndarray, total: np.ndarray) -> None:
        order = np.argsort(strings)
        self.keys, self.scores = strings[order], scores[order]
        self.bits = max(8, int(len(strings)).bit_length() + 1)
        self.slot_keys, self.slot_scores = np.full(1 << self.bits, -1, dtype=np.int64), np.zeros(1 << self.bits)
        rising = np.argsort(total, kind="stable")
        at = self._slot(strings[rising])
        self.slot_keys[at], self.slot_scores[at] = strings[rising], scores[rising]

    def _slot(self, s: np.ndarray) -> np.ndarray:
        return ((s.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, s: np.ndarray) -> np.ndarray:
        """The score of each string, NaN if it isn't held."""
        at = self._slot(s)
        out = self.slot_scores[at]
        miss = np.flatnonzero(self.slot_keys[at] != s)
        if len(miss):
            if len(self.keys):
                k = np.minimum(np.searchsorted(self.keys, s[miss]), len(self.keys) - 1)
                out[miss] = np.where(self.keys[k] == s[miss], self.scores[k], np.nan)
            else:
                out[miss] = np.nan
        return out


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, strings array<struct<string: long, n: long>>, words array<struct<word: binary, n: long>>"


def _lists(n: int, found: Counter, name: str, kind: pa.DataType) -> pa.Array:
    """Counts of (text, key) as a list for each of n texts."""
    keys = sorted(found, key=lambda k: k[0])
    offsets = np.searchsorted(np.array([k[0] for k in keys], dtype=np.int64), np.arange(n + 1)).astype(np.int32)
    cells = pa.StructArray.from_arrays([pa.array([k[1] for k in keys], kind), pa.array([found[k] for k in keys], pa.int64())], names=[name, "n"])
    return pa.ListArray.from_arrays(pa.array(offsets), cells)


def _score(depth: int, strings, words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Held(*[c.to_numpy(zero_copy_only=False) for c in strings.value])
        logs = dict(zip(words.value[0].to_pylist(), np.log10(words.value[1].to_numpy(zero_copy_only=False) + 1.0).tolist()))
        for batch in batches:
            m = batch.num_rows
            tokens, known, base, score = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64), np.zeros(m), np.zeros(m)
            odd_strings, odd_words = Counter(), Counter()
            for at, group in _groups(batch.column(2).to_pylist(), depth):
                s, n = _strings(group, depth)
                of, got = np.repeat(at, n), lookup.find(s)
                odd = np.isnan(got)
                if odd.any():
                    odd_strings.update(zip(of[odd].tolist(), s[odd].tolist()))
                    got[odd] = 0.0
                score += np.bincount(of, weights=got, minlength=m)
                number, distinct, each = _words(group, depth)
                ended = np.array([i for i, p in zip(at, group) if p.endswith(_END)], dtype=np.int64)
                of = np.concatenate([np.repeat(at, each), ended])
                number = np.concatenate([number, np.full(len(ended), len(distinct))])
                keys = [*distinct.to_numpy(zero_copy_only=False).tolist(), END_WORD]
                got = np.array(list(map(logs.get, keys)), dtype=float)[number]
                odd = np.isnan(got)
                if odd.any():
                    odd_words.update(zip(of[odd].tolist(), [keys[i] for i in number[odd].tolist()]))
                    got[odd] = 0.0
                tokens += np.bincount(of, minlength=m)
                known += np.bincount(of, weights=got > 0, minlength=m).astype(np.int64)
                base += np.bincount(of, weights=got, minlength=m)
            yield pa.record_batch({
                "doc_id": batch.column(0), "held_out": batch.column(1), "n_tokens": pa.array(tokens), "n_known": pa.array(known), "base": pa.array(base), "score": pa.array(score),
                "strings": _lists(m, odd_strings, "string", pa.int64()), "words": _lists(m, odd_words, "word", pa.binary()),
            })

    return run


def score_texts(docs: DataFrame, depth: int = DEPTH, held: int = HELD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each document."""
    if not 0 <= depth <= 5:
        raise ValueError("a node of more than 5 bytes doesn't fit a long")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    counts = materialize(docs.select((~F.col("held_out")).alias("train"), "text").mapInArrow(_count(depth), "string long, word binary, seen long, total long"), "counts")
    sums = [F.sum("seen").alias("seen"), F.sum("total").alias("total")]
    strings = string_scores(materialize(counts.where("string is not null").groupBy("string").agg(*sums), "sums"), depth)
    words = materialize(counts.where("word is not null").groupBy("word").agg(*sums), "words")
    size = words.agg(F.coalesce(F.sum("seen"), F.lit(0)).alias("n"), F.count_if(F.col("seen") > 0).alias("v")).first()
    held_strings = most_frequent(strings, held).select("string", "score", "total").toArrow().combine_chunks()
    held_words = most_frequent(words, held).select("word", "seen").toArrow().combine_chunks()
    send = lambda t: spark.sparkContext.broadcast([t.column(i).combine_chunks() for i in range(t.num_columns)])
    first = materialize(docs.mapInArrow(_score(depth, send(held_strings), send(held_words)), _SCORED).withColumn("row", F.monotonically_increasing_id()), "scored")
    by_string = first.select("row", F.inline("strings")).join(strings.select("string", F.col("score").alias("s")).hint("merge"), "string").groupBy("row").agg(F.sum(F.col("n") * F.col("s")).alias("more_score"))
    by_word = first.select("row", F.inline("words")).join(words.where("seen > 0").select("word", F.col("seen").alias("c")).hint("merge"), "word").groupBy("row").agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_base")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = first.drop("strings", "words").join(by_string.hint("merge"), "row", "left").join(by_word.hint("merge"), "row", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("more_known")).alias("n_known"), F.lit(size["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base") - F.col("n_tokens") * math.log10(size["n"] + size["v"] + 1)).alias("base_score"), (F.col("score") + zero("more_score")).alias("score"),
    )
