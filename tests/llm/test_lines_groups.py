"""Large groups under a key: every pair that the gate lets pass counts."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa

from tarnspark.llm import lines as L


def versions(n, words, changed, seed=21):
    r = random.Random(seed)
    base = [f"word{chr(97 + i % 26)}{chr(97 + i * 7 % 26)}" for i in range(words)]
    out = []
    for d in range(n):
        w = list(base)
        for i in r.sample(range(words), changed):
            w[i] = "".join(chr(97 + r.randrange(26)) for _ in range(6))
        out.append(" ".join(w))
    return out


def groups_of_all_pairs(lines):
    """The least number of each line's group, where all pairs under a key that pass the gate and are similar are connected."""
    at, keys, sims = L._keys([x.encode() for x in lines])
    by = defaultdict(dict)
    for i, k, s in zip(at.tolist(), keys.tolist(), sims.tolist(), strict=True):
        by[k][i] = s
    pairs = sorted({p for g in by.values() for p in combinations(sorted(g), 2) if (g[p[0]] ^ g[p[1]]).bit_count() <= L.GATE})
    parent = list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), ok in zip(pairs, L.similar([(lines[a], lines[b]) for a, b in pairs]), strict=True):
        if ok:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return [find(i) for i in range(len(lines))], max(map(len, by.values()))


def test_large_groups_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(L, "PART", 40, raising=False)  # groups are dealt to squares
    lines = versions(300, 30, 5) + versions(250, 40, 6, 22)
    want, largest = groups_of_all_pairs(lines)
    assert largest > 4 * L.WINDOW
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id for r in L.dedup_lines(docs).collect() if r.removed}
    assert got == {i for i, g in enumerate(want) if g != i}


def test_squares_give_each_pair_of_components_once():
    r = np.random.default_rng(7)
    n, parts = 700, 3
    code, comp, part = np.arange(n), r.integers(0, 9, n), r.integers(0, parts, n)
    sim, size = r.integers(0, 2**64, n, np.uint64) & np.uint64(0xFFFFFFFFF), r.integers(100, 130, n).astype(np.int16)
    rows = [(0, i, j, k) for i in range(parts) for j in range(i, parts) for k in range(n) if part[k] in (i, j)] + [(1, 0, 0, k) for k in range(40) if part[k] == 0]
    key, i, j, at = (np.array(c) for c in zip(*rows, strict=True))
    columns = {"key": key, "i": i.astype(np.int32), "j": j.astype(np.int32), "part": part[at].astype(np.int32), "comp": comp[at], "sim": sim[at].view(np.int64), "code": code[at], "size": size[at]}
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))
    got = []
    for b in L._cross(iter([whole.slice(x, 150) for x in range(0, len(at), 150)])):
        got += zip(b["x"].to_pylist(), b["y"].to_pylist(), strict=True)
    near = [(a, b) for a, b in combinations(range(n), 2) if comp[a] != comp[b] and int(sim[a] ^ sim[b]).bit_count() <= L.GATE and abs(int(size[a]) - int(size[b])) <= L.STEPS]
    again = [(a, b) for a, b in near if b < 40 and part[a] == part[b] == 0]
    assert sorted(got) == sorted(near + again) and len(near) > 1000


def test_lengths_of_similar_lines_are_few_steps_apart():
    size = lambda n: int(np.floor(np.log(n) / np.log(L.STEP)))
    assert all(size(n) - size(n - int(n * (1 - L.SIMILARITY) + 1e-9)) <= L.STEPS for n in [*range(5, 5000), 10**6, 10**7 + 1])


def test_distances_above_the_band_are_left_early():
    r = random.Random(9)
    pairs = []
    for i in range(120):
        a = "".join(r.choice("abcdef") for _ in range(900))
        b = a if i % 3 else "".join(r.choice("abcdef") for _ in range(900))
        for _ in range(40):
            k = r.randrange(900)
            b = b[:k] + "z" + b[k + 1 :]
        pairs.append(tuple(np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b)))
    true = [L.long_distance(x.tolist(), y.tolist()) for x, y in pairs]
    for band in (20, 60, 180, 900):
        assert all(d == w if w <= band else d > band for d, w in zip(L.distances(pairs, band).tolist(), true, strict=True))
        assert all((L.long_distance(x.tolist(), y.tolist(), band) <= band) == (w <= band) for (x, y), w in zip(pairs[:20], true, strict=False))


def test_each_pair_has_its_own_bound():
    rng = np.random.default_rng(8)
    pairs = []
    for n in rng.integers(1, 700, 400).tolist():
        x = rng.integers(97, 103, n)
        y = np.concatenate([rng.integers(97, 103, rng.integers(0, 40)), np.where(rng.random(n) < rng.choice([0.02, 0.2, 0.9]), rng.integers(97, 103, n), x)])
        pairs.append((x, y))
    true = [L.long_distance(x.tolist(), y.tolist()) for x, y in pairs]
    bounds = [max(0, t + int(rng.integers(-30, 30))) for t in true]
    for few in (0, 10):
        L_few, L.FEW = L.FEW, few
        try:
            got = L.distances(pairs, bounds).tolist()
        finally:
            L.FEW = L_few
        assert all(d == t if t <= b else d > b for d, t, b in zip(got, true, bounds, strict=True))
    assert all((L.long_distance(x.tolist(), y.tolist(), b) <= b) == (t <= b) for (x, y), t, b in zip(pairs, true, bounds, strict=True))
