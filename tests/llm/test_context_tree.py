"""Context-tree weighting against a recursive tree over single bits, and the base score against plain counts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnspark.llm import context_tree as C

SCHEMA = "doc_id long, text string"


def out_of_fit(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def data(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()


def model(texts, depth):
    """(context, prefix) -> counts, where a context is bytes, the latest first."""
    counts = defaultdict(lambda: [0, 0])
    for t in texts:
        s = b"\xff" * depth + t + b"\xfe"
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                for k in range(8):
                    bits = format(s[i], "08b")
                    counts[s[i - d : i][::-1], bits[:k]][int(bits[k])] += 1
    return counts


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def brute(rows, depth):
    train = [data(t) for i, t in rows if not out_of_fit(i)]
    counts = model(train, depth)
    children = defaultdict(set)
    for c, p in counts:
        if c:
            children[c[:-1], p].add(c)
    memo = {}

    def weighted(c, p):
        if (c, p) not in memo:
            own = log_kt(*counts[c, p]) if (c, p) in counts else 0.0
            memo[c, p] = own if len(c) == depth else math.log(0.5) + np.logaddexp(own, sum(weighted(x, p) for x in sorted(children[c, p])))
        return memo[c, p]

    def chance(context, p, bit, d=0):
        """The mixture's probability at the node of the first d bytes of the context."""
        c = context[:d]
        a = counts[c, p] if (c, p) in counts else [0, 0]
        own = (a[bit] + 0.5) / (sum(a) + 1)
        if d == depth:
            return own
        stop = math.exp(math.log(0.5) + log_kt(*a) - weighted(c, p))
        return stop * own + (1 - stop) * chance(context, p, bit, d + 1)

    words = Counter(w for t in train for w in [*t.split(), b" "])
    n, v = sum(words.values()), len(words)
    out = []
    for i, text in rows:
        t = data(text)
        s = b"\xff" * depth + t + b"\xfe"
        score = 0.0
        for at in range(depth, len(s)):
            bits = format(s[at], "08b")
            score += sum(math.log10(chance(s[at - depth : at][::-1], bits[:k], int(bits[k]))) for k in range(8))
        ws = [*t.split(), b" "]
        out.append((i, out_of_fit(i), len(ws), sum(words[w] > 0 for w in ws), n, sum(math.log10((words[w] + 1) / (n + v + 1)) for w in ws), score))
    return sorted(out, key=repr)


def same(got, want):
    got = sorted((tuple(r) for r in got), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


def words(rng, n):
    return " ".join(rng.choice(["the", "The", "cat", "sat", "on", "é", "mat.", "x\ty", "Zürich"]) for _ in range(n))


@pytest.mark.parametrize("held", [0, 8, 1 << 18])
def test_against_brute_force(spark, held):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.randrange(12))) for i in range(30)] + [(7, None), (None, "the cat"), (7, words(rng, 4)), (11, "the cat"), (11, "the cat"), (40, "a" * 100 + " " + "b" * 70), (41, " \n\x0b ")]
    assert {out_of_fit(i) for i, _ in rows} == {True, False}
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"row": F.lit("r"), "string": F.lit(1), "score": F.lit("s"), "words": F.lit(0)})
    same(C.score_texts(df, 2, held).collect(), brute(rows, 2))


def test_pieces_and_waiting_counts(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, words(rng, 300)) for i in range(4)] + [(9, "y" * 500), (10, "")]
    text = b"ab " * 40 + b"c" * 50
    monkeypatch.setattr(C, "PIECE", 16)
    cut = list(C._pieces(text, 2))
    assert len(cut) > 5 and b"".join(p[2:] for p in cut) == text + b"\xfe" and all(p[:2] == (b"\xff\xff" + text)[len(b"".join(q[2:] for q in cut[:i])):][:2] for i, p in enumerate(cut))
    monkeypatch.setattr(C, "WAITING", 5)
    got = []
    batch = pa.record_batch([pa.array([not out_of_fit(i) for i, _ in rows]), pa.array([t for _, t in rows])], names=["train", "text"])
    total, seen = Counter(), Counter()
    for b in C._count(1)(iter([batch])):
        got.append(b.num_rows)
        for s, w, n, m in zip(*[c.to_pylist() for c in b.columns]):
            total[w if s is None else s] += m
            seen[w if s is None else s] += n
    plain = Counter(C._word_key(w) if len(w) > 1 else w for _, t in rows for w in [*data(t).split(), b" "])
    assert len(got) > 4 and {k: v for k, v in total.items() if isinstance(k, bytes)} == plain
    assert sum(v for k, v in total.items() if isinstance(k, int)) == sum(len(data(t)) + 1 for _, t in rows)


def test_long_text(spark):
    a, b, c = [i for i in range(9) if not out_of_fit(i)][:3]
    rows = [(a, "abc " * 600_000), (b, "abc abd"), (c, "abc")]
    got = {r.doc_id: r for r in C.score_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[a].n_tokens == 600_001 and got[a].score / 2_400_001 > -0.001 and got[b].score < got[c].score < 0


def test_no_training_and_empty(spark):
    rows = [(i, "the cat") for i in range(200) if out_of_fit(i)]
    same(C.score_texts(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows, 0))
    assert C.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_probabilities_sum_to_one(spark):
    """After any context the 256 bytes share a probability of one."""
    rows = [(ord("a") << 8 | b, 3 if b in b"xyz" else 0, 1) for b in range(256)] + [(ord("b") << 8 | b, 5 if b == 0x78 else 0, 1) for b in range(256)]
    got = C.string_scores(spark.createDataFrame(rows, "string long, seen long, total long"), 1)
    sums = got.groupBy(F.shiftright("string", 8)).agg(F.sum(F.pow(F.lit(10.0), "score")).alias("p")).collect()
    assert len(sums) == 2 and all(abs(r.p - 1) < 1e-9 for r in sums)


def test_held_out_beats_uniform_and_base_is_in_order(spark):
    rng = random.Random(5)
    rows = [(i, words(rng, 40)) for i in range(120)]
    got = [r for r in C.score_texts(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    n = {i: len(data(t)) + 1 for i, t in rows}
    assert got and all(-r.score / n[r.doc_id] < 0.6 * math.log10(256) / 2.4 for r in got)


def test_most_frequent_never_holds_more(spark):
    df = spark.createDataFrame([(i, 1 + i % 5 + (5000 if i == 7 else 0)) for i in range(100)], "string long, total long")
    assert [C.most_frequent(df, n).count() for n in (0, 1, 20, 21, 40, 100)] == [0, 1, 1, 21, 21, 100] or [C.most_frequent(df, n).count() <= n for n in (0, 1, 20, 21, 40, 100)] == [True] * 6
    assert C.most_frequent(df, 1).first()["string"] == 7


def test_words_are_cut_as_arrays():
    long = "w" * 70 + "é"
    texts = ["", " \t a\x0bb\x0cb  ", f"{long} b {long}", "é\xa0é x", "\x1c\x1d y"]
    for depth in (0, 2, 4):
        group = [p for t in texts for p in C._pieces(data(t), depth)]
        number, distinct, each = C._words(group, depth)
        keys = distinct.to_pylist()
        plain = [[w if len(w) <= 64 else C._word_key(w) for w in data(t).split()] for t in texts]
        assert each.tolist() == [len(ws) for ws in plain] and [keys[i] for i in number.tolist()] == [w for ws in plain for w in ws]
