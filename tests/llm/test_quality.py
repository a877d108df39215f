import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tarnspark.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = (text or "").split("\n")
    seen, dup = set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    tri = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if tri[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


TEXTS = [None, "", " \n\t", "a b c a b c", "x x x x", "é\u00a0b  日本\x1c 😀", "l\nl\n l\n\nl", "#a *b $ % & | < >", "one two three four two three four", "a\r\na\r\n", "w " * 60, "\x0b\x0c a"]


def test_counts(spark):
    for t in TEXTS:
        assert Q.count_text(t)[:5] == brute(t), t
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for (t,) in rows:
        assert Q.count_text(t)[:5] == brute(t)


def test_judge_edges(spark):
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s") for i, t in enumerate(TEXTS)] + [(0, None, "en", "s"), (None, "x", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"n": F.lit(1), "kept": F.lit("?"), "n_words": F.lit("?")})
    got = Q.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id > 0:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(TEXTS[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert Q.judge(df.limit(0)).count() == 0 and Q.keep_good(df.limit(0)).columns == df.columns


def test_adaptive_fences(spark):
    good = " ".join(f"word{i * 7 % 90}x{i}" for i in range(80))
    junk = " ".join(f"word{i}#$%" for i in range(80))
    long = " ".join(f"wordwordwordword{i}" for i in range(80))
    rows = [(i, good + f" {i}", "en", "a") for i in range(300)] + [(1000 + i, long + f" {i}", "de", "b") for i in range(300)] + [(2000, junk, "en", "a"), (2001, long, "en", "a"), (2002, long, "de", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    bad = {r.doc_id for r in Q.judge(df).where("not kept").collect()}
    assert bad == {2000, 2001}  # long words are usual in the other language, also in its small source
    assert {r.doc_id for r in Q.keep_good(df).collect()} == {r[0] for r in rows} - bad


def test_same_result_for_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = (sorted((r.doc_id, r.kept) for r in Q.judge(d).collect()) for d in (docs.repartition(7), docs.coalesce(1)))
    assert a == b


def test_outliers_below_the_fixed_limits(spark):
    """Repeats and duplicate lines that are rare in a group fail there; where they are usual, they pass."""
    good = " ".join(f"word{i * 7 % 90}x{i}" for i in range(80))
    repeats = " ".join(f"word{i}x{i}" for i in range(10, 70)) + (" " + " ".join(f"again{i}xx" for i in range(10))) * 2  # 20 of 80 words
    doubled = "\n".join([" ".join(f"line{k}x{i}w" for i in range(12)) for k in range(12)] + ["onelines"] * 4)  # 3 of 16 lines, few words
    rows = [(i, good + f" {i}", "en", "a") for i in range(300)] + [(1000, repeats, "en", "a"), (1001, doubled, "en", "a")]
    rows += [(2000 + i, repeats + f" {i}", "en", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in Q.judge(df).where("not kept").collect()} == {1000, 1001}


def quantile(values, p):
    """The exact quantile, moved to the end of its bin."""
    v = sorted(values)[max(0, math.ceil(p * len(values)) - 1)]
    return Q.GROWTH ** (math.ceil(math.log(v) / math.log(Q.GROWTH)) - (p < 0.5)) if v > 0 else 0.0


def brute_kept(rows, prior):
    """doc -> kept by sorted values of the group, its language and the corpus. rows: (doc_id, text, lang, source)."""
    names = list(Q.MEASURES)
    measured = {}
    for d, t, lang, source in rows:
        n, chars, symbols, dup, repeat = brute(t)
        lines = sum(bool(WORD.search(x)) for x in (t or "").split("\n"))
        measured[d] = (lang, source, n, dict(zip(names, (symbols / max(chars, 1), dup / max(lines, 1), repeat / max(n, 1), chars / max(n, 1)))), n < 50 or 100 * repeat > 50 * n)
    with_words = [m for m in measured.values() if not m[4]]
    fences, out = {}, {}
    for d, (lang, source, _, own, failed) in measured.items():
        if (lang, source) not in fences:
            groups = [m for m in with_words if m[:2] == (lang, source)], [m for m in with_words if m[0] == lang], with_words
            limit = {}
            for name, (two_sided, level) in Q.MEASURES.items():
                if not groups[0]:
                    continue
                q = []
                for p in Q.LEVELS:
                    drawn = quantile([m[3][name] for m in groups[2]], p)
                    for g in (groups[1], groups[0]):
                        drawn = (len(g) * quantile([m[3][name] for m in g], p) + prior * drawn) / (len(g) + prior)
                    q.append(drawn)
                most = max(q[2] + Q.REACH * (q[3] - q[2]) if q[3] > q[2] * (1 + 1e-9) else q[Q.LEVELS.index(level)], q[2] * Q.GROWTH**Q.REACH)
                least = min(q[2] - Q.REACH * (q[2] - q[1]) if q[1] < q[2] * (1 - 1e-9) else q[0], q[2] / Q.GROWTH**Q.REACH)
                limit[name] = (least if two_sided else -math.inf, most)
            fences[lang, source] = limit
        out[d] = not failed and all(a <= own[k] <= b for k, (a, b) in fences[lang, source].items())
    return out


def test_kept_against_sorted_values(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").dropDuplicates(["doc_id"])
    rows = [tuple(r) for r in docs.collect()] + [(-1, "", "xx", None), (-2, None, None, None), (-3, " ".join(f"word{i}" for i in range(60)), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for prior in (1, 25, 1000):
        got = {r.doc_id: r.kept for r in Q.judge(df.repartition(3), prior).collect()}
        want = brute_kept(rows, prior)
        assert got == want and 0 < sum(want.values()) < len(want)


def test_sources_decide_beside_their_language(spark):
    """A source of few documents already moves its own fences; no fence is the same for two unlike sources."""
    text = lambda k, n: " ".join("w" * (k + i % 3) + str(i) for i in range(n))
    rows = [(i, text(4 + i % 2, 60 + i), "en", "a") for i in range(200)] + [(1000 + i, text(9 + i % 2, 60 + i), "en", "b") for i in range(12)]
    counts = Q.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    f = {r.source: r for r in Q.fences(counts).collect()}
    assert f["b"].word_length_most > f["a"].word_length_most + 0.5 and f["a"].word_length_least < 5 < 7 < f["a"].word_length_most


def test_values_at_a_fence_stay(spark):
    """Values that are all equal stand at both fences."""
    rows = [(i, " ".join(f"abcd{k:03d}" for k in range(60)), "en", "a") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r.kept for r in Q.judge(df).collect())


def test_very_long_text(spark):
    text = "\n".join(" ".join(f"w{i}x{j}" for j in range(100)) for i in range(4000))
    got = Q.judge(spark.createDataFrame([(1, text, "en", "a")], "doc_id long, text string, lang string, source string")).first()
    assert (got.n_words, got.n_dup_lines, got.n_repeat_words) == (400_000, 0, 0)
