import hashlib
import random

import numpy as np
import pytest

from tarnspark.llm import substrings as S


def brute(rows):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256) by a dictionary of all windows."""
    raws = {d: (t or "").encode() for d, t in rows}
    seen, out = set(), {}
    for d in sorted(raws):
        raw, gone = raws[d], bytearray(len(raws[d]))
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(spark, rows, **options):
    got = S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got}


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array(seed):
    r = np.random.default_rng(seed)
    for n in (0, 1, 2, 3, 4, 5, 7, 50, 300):
        t = r.integers(0, 2 + seed, n).astype(np.uint8)
        if seed == 5:
            t[:] = 7
        assert S.suffix_array(t).tolist() == sorted(range(n), key=lambda i: t[i:].tolist())


def fixture():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = [text(60) for _ in range(6)]
    rows = []
    for d in range(60):
        b = r.choice(base)
        cut = sorted(r.sample(range(len(b)), 2))
        rows.append((d * 3, r.choice([b, text(20) + b[cut[0] : cut[1]] + text(5), text(30), b[: cut[1]] + "X" + b[cut[1] :], b[cut[0] :] + b[: cut[1]], text(3) + base[0][10:130] + text(3)])))
    rows += [(1000, "a" * 500), (1001, "ab" * 200), (1002, None), (1003, ""), (1004, "x" * 99), (1005, "a" * 100), (4, base[0] + base[0])]
    return rows


def test_matches_brute_force(spark):
    rows = fixture()
    assert run(spark, rows) == brute(rows)


def test_hot_grams_give_the_same_result(spark):
    rows = fixture()
    assert run(spark, rows, hot=3) == brute(rows)


def test_small_table_whole(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows) == brute(rows)


def test_nulls_repeats_and_empty(spark):
    long = "".join(hashlib.md5(bytes([i])).hexdigest() for i in range(10))[:300]
    rows = [(None, long), (1, long), (1, long), (2, long), (2, long + "?"), (3, long)]
    got = S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (1, 0), (1, 0), (2, 300), (2, 300), (3, 300)]
    assert S.dedup_substrings(spark.createDataFrame([], "doc_id long, text string, runs int, kept int")).count() == 0


def places(rows):
    """n_removed of each row: texts of one doc_id follow each other by digest, equal ones are one place, rows without an id are none."""
    keys = sorted({(d, hashlib.sha256((t or "").encode()).hexdigest(), t or "") for d, t in rows if d is not None})
    cut = brute([(i, k[2]) for i, k in enumerate(keys)])
    of = {(k[0], k[2]): cut[i] for i, k in enumerate(keys)}
    none = lambda t: (len((t or "").encode()), 0, 0, hashlib.sha256((t or "").encode()).hexdigest())
    return sorted(((d, of[d, t or ""] if d is not None else none(t)) for d, t in rows), key=repr)


@pytest.mark.parametrize("hot", [3, 200_000])
def test_shared_ids_match_brute_force(spark, hot):
    """The texts of a doc_id count as earlier copies and lose bytes themselves."""
    r = random.Random(11)
    rows = [(r.randrange(12) if r.random() < 0.9 else None, t) for _, t in fixture() for _ in range(r.randrange(1, 3))]
    got = S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), hot).collect()
    assert sorted(((x.doc_id, (x.n_bytes, x.n_removed, len(x.spans), hashlib.sha256(bytes(x.kept)).hexdigest())) for x in got), key=repr) == places(rows)


def test_two_texts_of_the_first_id(spark):
    a, b = ("".join(hashlib.md5(f"{k}{i}".encode()).hexdigest() for i in range(14))[:419] for k in "ab")
    got = S.dedup_substrings(spark.createDataFrame([(1, a), (1, b), (2, a), (3, a)], "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.n_removed) for x in got) == [(1, 0), (1, 0), (2, 419), (3, 419)]


def test_pieces_of_a_text_pick_alike(monkeypatch):
    """Every window has the pick that it has without a border; pieces meet without a gap."""
    r = np.random.default_rng(7)
    raw = r.integers(97, 101, 5000).astype(np.uint8)

    def picks(piece):
        monkeypatch.setattr(S, "PIECE", piece)
        gram, _, lo, hi = S.anchors_of(raw, S.Rolling())
        return {p: g for g, a, z in zip(gram.tolist(), lo.tolist(), hi.tolist(), strict=True) for p in range(a, z + 1)}

    whole = picks(8_000_000)
    assert sorted(whole) == list(range(len(raw) - S.WINDOW + 1))
    assert all(picks(piece) == whole for piece in (1, 333, 1000, 4901))


def test_text_beyond_one_piece(spark):
    r = random.Random(5)
    passage = "".join(r.choice("abcdefgh") for _ in range(300))
    filler = np.random.default_rng(1).integers(97, 123, S.PIECE + 400_000).astype(np.uint8).tobytes().decode()
    long = filler[: S.PIECE - 150] + passage + filler[S.PIECE - 150 :]
    got = {x.doc_id: x.n_removed for x in S.dedup_substrings(spark.createDataFrame([(1, passage), (2, long), (3, "z" + passage)], "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 300, 3: 300}
