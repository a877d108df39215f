"""Lines are compared where they meet in squares, and words that follow one another settle most similar pairs."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa

from tarnspark.llm import lines as L


def texts(n, words, changed, seed):
    r = random.Random(seed)
    base = [f"word{chr(97 + i % 26)}{chr(97 + i * 7 % 26)}" for i in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for i in r.sample(range(words), changed):
            w[i] = "".join(chr(97 + r.randrange(26)) for _ in range(r.randrange(1, 9)))
        out.append(" ".join(w))
    return out


def groups(n, pairs):
    parent = list(range(n))
    for a, b in pairs:
        a, b = sorted((parent[a], parent[b]))
        parent = [a if p == b else p for p in parent]
    return parent


def test_links_of_squares_connect_what_all_pairs_connect():
    lines = texts(50, 30, 5, 1) + texts(50, 30, 8, 2) + texts(20, 12, 2, 3)
    n, r = len(lines), np.random.default_rng(4)
    near = [p for p in combinations(range(n), 2) if L.similar([(lines[p[0]], lines[p[1]])])[0]]
    sim = r.integers(0, 2**8, n).astype(np.uint64)  # all within the gate
    keys = [[7, 3] if i < 40 else [7] for i in range(n)]
    rows = [(3, i) for i in range(40)] + [(7, i) for i in range(n)]
    key, at = (np.array(c) for c in zip(*rows, strict=True))
    zero = np.zeros(len(at), np.int32)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (key, zero, zero, zero, at, sim[at].view(np.int64), at, zero.astype(np.int16))] + [pa.array([keys[i] for i in at], pa.list_(pa.int64())), pa.array([lines[i] for i in at])],
        ["key", "i", "j", "part", "comp", "sim", "code", "size", "keys", "text"],
    )
    got = [p for b in L._cross(iter([batch.slice(x, 35) for x in range(0, len(at), 35)]), linked=True) for p in zip(b["x"].to_pylist(), b["y"].to_pylist(), strict=True)]
    assert set(got) <= set(near) and len(got) == len(set(got))
    assert groups(n, got) == groups(n, near) and len(set(groups(n, near))) < n and len(got) < len(near)


def test_a_pair_is_compared_under_the_least_key_it_shares():
    shared = L._keys_of(pa.array([[5, 9, 2], [9, 5], [9]], pa.list_(pa.int64())))
    a, b = np.array([0, 0, 1]), np.array([1, 2, 2])
    for key, want in ((9, [False, True, True]), (5, [True, True, True])):
        assert L._first_met(shared, np.full(3, key), a, b).tolist() == want


def test_aligned_words_never_pass_what_differs_more():
    r, passed = random.Random(5), 0
    for _ in range(300):
        a, b = texts(2, r.randrange(3, 60), 2, r.random())
        w = b.split(" ")
        for _ in range(r.randrange(0, 12)):
            k = r.randrange(len(w))
            w[k:k] = r.choice([[], ["more"], w[:2]])
            w.pop(r.randrange(len(w))) if len(w) > 1 else None
        b = " ".join(w)
        x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32).tolist() for t in sorted((a, b), key=len))
        true = L.long_distance(x, y)
        for most in (0, true - 1, true, 2 * true, 4 * true):
            ok = L.aligned(a, b, most)
            assert not ok or true <= most
            passed += ok
    assert passed > 100
    assert L.aligned("a b c", "a b c", 0) and not L.aligned("a", "b", 0)


def test_long_distances_in_runs_of_columns():
    r = np.random.default_rng(6)
    for n, edits in ((700, 60), (2500, 300), (2500, 900)):
        x = r.integers(0, 5, n)
        y = x.copy()
        for k in r.integers(0, n, edits).tolist():
            y = np.delete(y, k % len(y)) if k % 3 else np.insert(y, k % len(y), 7)
        x, y = sorted((x.tolist(), y.tolist()), key=len)
        row = np.arange(len(y) + 1)
        for i, c in enumerate(x):
            new = np.minimum(row[1:] + 1, row[:-1] + (np.array(y) != c))
            new = np.r_[i + 1, new] - np.arange(len(y) + 1)
            row = np.minimum.accumulate(new) + np.arange(len(y) + 1)
        true = int(row[-1])
        assert L.long_distance(x, y) == L.long_distance(y, x) == true
        for most in (true - 50, true - 1, true, true + 1, true + 200):
            got = L.long_distance(x, y, most)
            assert got == true if true <= most else got > most
