"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks and MinHash bands, edit similarity, one occurrence kept a group.

Lines are lower-cased, digits become 0 and other signs blanks. Equal normalised lines are folded first. Each distinct line has one SimHash of
64 bits over words and neighbour pairs, and meets others under keys of two kinds:

* the ``BLOCKS`` blocks of its SimHash: two hashes that differ in fewer bits than there are blocks agree on one;
* ``BANDS`` bands of ``PICKS`` MinHash values of its words of more than three bytes, repeated ones by number, and for lines of up to ``FEW_WORDS`` words what is left without each one of their words, which
  finds any change of one word. Blocks alone find few pairs of edit similarity 0.8 (README gives the measured share).

All lines under a key meet. Pairs within ``GATE`` bits (those that differ in one word, whatever their bits) whose lengths allow it are verified by the edit similarity of the normalised lines
(1 - distance / longer length >= ``SIMILARITY``) in two rounds: first those with the next line by SimHash and, in groups of over ``WINDOW`` + 1 lines, with the first one, then all other pairs.
Pairs whose lines are connected already are left out, which gives the groups that verifying all would give. The second round deals a group to squares of ``PART`` lines by ``PART``, so that no task
holds a group, and compares lines where they meet: a text is sent to a square once, not with each of its pairs. A group whose lines stay apart costs the square of its size in comparisons.
The first occurrence (least doc_id, then line number) of each group is kept. Which lines share a key is by chance: README gives the measured recall.

Lines with fewer than ``LEAST_WORDS`` words are always kept. Defined cases: null and empty texts have one blank line; rows without a
doc_id keep every line, since nothing orders them; rows with one doc_id count their lines as one place each, so repeated rows don't remove each other; of
several texts under one doc_id all lines are verified; ties go to the least doc_id and line number; a very long line is compared whole; an empty table gives none; other columns, of whatever name, aren't read.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnspark.llm.common import drop, materialize, new_path
from tarnspark.llm.components import components
from tarnspark.llm.words import FOLD_DIGITS, mix, utf8

SIMILARITY, LEAST_WORDS, GATE, BLOCKS = 0.8, 3, 17, 2
BANDS, PICKS, FEW_WORDS, WINDOW = 6, 3, 12, 15
#: Lines of more code points than this are first aligned by their words, of which so many are passed over at once; further ones are looked up.
ALIGNED, AHEAD, FAR = 150, 12, 200
#: Fewer pairs than this for each 64 rows of their band are compared one by one.
FEW = 10
#: So many pairs are compared at once even if their lengths differ more.
TOGETHER = 256
#: Rows of keys that a task of the search gets, and those of one key that it holds at once.
TASK_ROWS, HELD_ROWS = 2_500_000, 1_000_000
#: Lines of a large group that meet as many others in one piece of work, and how many of them at once; groups of up to ``SMALL`` lines meet together with others.
PART, SLICE, SMALL = 512, 256, 32
#: Pairs that are compared before those that got connected are left out, and those that wait for it at most.
TURN, TOO_MANY = 4096, 1_000_000
#: A line's length is sent as its logarithm to the base of ``STEP``; similar lines differ by so many steps at most.
STEP = 1.02
STEPS = int(np.log(1 / SIMILARITY) / np.log(STEP)) + 1
#: Bits of the filter by which texts of lines are fetched.
FILTER_BITS = 26
_MULTIPLIERS = mix(np.arange(BANDS * PICKS, dtype=np.uint64), 78) | np.uint64(1)
_ALL = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))
_BYTES = mix(np.arange(256, dtype=np.uint64), 79)
#: A byte's bits spread over the eight bytes of a number.
_LANES = np.array([sum(1 << 8 * b for b in range(8) if i >> b & 1) for i in range(256)], np.uint64)
#: What is left of a number behind each eighth of its bits: shifts by which the rows below are counted.
_EIGHTHS = np.arange(8, 72, 8, dtype=np.uint64)[:, None]


#: As the other signs become blanks, line breaks stay.
_FOLD = FOLD_DIGITS[:10] + b"\n" + FOLD_DIGITS[11:]


def normalise(line: bytes) -> bytes:
    return b" ".join(line.translate(FOLD_DIGITS).split())


def judged(text: str | None) -> list[tuple[int, bytes]]:
    """(number, normalised line) of the lines of a text that have ``LEAST_WORDS`` words."""
    raw = utf8(text).translate(_FOLD)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    out = []
    for i, line in enumerate(raw.split(b"\n")):
        line = line.strip(b" ")
        if line.count(b" ") >= LEAST_WORDS - 1:
            out.append((i, line))
    return out


def _lines(batches):
    for b in batches:
        docs, number, ids = [], [], []
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            found = judged(text)
            docs += [doc_id] * len(found)
            number += [i for i, _ in found]
            ids += [xxhash.xxh3_128_digest(x) for _, x in found]
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(number, pa.int32()), pa.array(ids, pa.binary())], ["doc_id", "line", "id"])


def _votes(features: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many features of each line have each of the 64 bits set: bytes are counted in lanes, up to 255 features at a time."""
    parts = -(-lengths // 255)
    owner = np.repeat(np.arange(len(lengths)), parts)
    first = np.cumsum(parts) - parts
    at = starts[owner] + 255 * (np.arange(len(owner)) - first[owner])
    out = np.empty((len(lengths), 64), np.int32)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[(features >> np.uint64(8 * byte) & np.uint64(255)).astype(np.uint8)], at)
        out[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int32), first, axis=0)
    return out


def simhashes(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The SimHash of each line, over its words and neighbour pairs; ``words`` are the hashes of all lines end to end."""
    if not len(lengths):
        return np.empty(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        pairs = mix(words * np.uint64(3) + np.r_[words[1:], words[:1]], 12)
    pairs[starts + lengths - 1] = 0  # no pair over the end of a line, and no vote for any bit
    ones = _votes(mix(words, 11), starts, lengths) + _votes(pairs, starts, lengths)
    return np.packbits(2 * ones > (2 * lengths - 1)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _numbered(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The words mixed with their occurrence numbers in their line."""
    with np.errstate(over="ignore"):
        own = mix(words + np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths) * _MULTIPLIERS[0], 6)
    order = np.argsort(own, kind="stable")
    again = np.flatnonzero(own[order][1:] == own[order][:-1]) + 1
    if not len(again):
        return words
    first = np.ones(len(words), bool)
    first[again] = False
    number = np.arange(len(words)) - np.maximum.accumulate(np.where(first, np.arange(len(words)), 0))
    out = words.copy()
    out[order[again]] = mix(words[order[again]] + number[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 5)
    return out


@lru_cache(1)
def _powers(millions: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.full(millions * 1_000_000, x, np.uint64)) for x in (_ODD, _ODD_INVERSE))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, length in bytes, whether it ends a line) of each word of normalised lines that all end in a line break: differences
    of running sums of each byte's value times a power of an odd number."""
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.r_[0, ends[:-1] + 1]
    with np.errstate(over="ignore"):
        up, down = _powers(-(-len(raw) // 1_000_000))
        up, down = up[: len(raw)], down[: len(raw)]
        sums = np.r_[np.uint64(0), np.cumsum(_BYTES[raw] * up)]
        return mix((sums[ends] - sums[starts]) * down[starts], 8), ends - starts, raw[ends] == 10


def band_keys(words: np.ndarray, lengths: np.ndarray, long: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` keys for each line, by the words that are long; by all words of a line that has under ``PICKS`` long ones."""
    long = long | np.repeat(np.add.reduceat(long, np.cumsum(lengths) - lengths, dtype=np.int64) < PICKS, lengths)
    lengths = np.add.reduceat(long, np.cumsum(lengths) - lengths, dtype=np.int64)
    words, starts = _numbered(words[long], lengths), np.cumsum(lengths) - lengths
    out = np.zeros((BANDS, len(lengths)), np.uint64)
    with np.errstate(over="ignore"):
        for i, m in enumerate(_MULTIPLIERS):
            out[i // PICKS] = mix(out[i // PICKS] * np.uint64(31) + np.minimum.reduceat(words * m, starts), 4)
        return mix(out.T + np.arange(BANDS, dtype=np.uint64), 9)


def _keys(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in ``lines``, keys, SimHashes) of the rows of keys. Keys of lines less a word have no SimHash, so that the gate lets them pass."""
    words, size, last = word_hashes(np.frombuffer(b"\n".join([*lines, b""]), np.uint8))
    stops = np.flatnonzero(last) + 1
    lengths = np.diff(np.r_[0, stops])
    sims = simhashes(words, lengths)
    width = 64 // BLOCKS
    blocks = np.stack([mix(sims >> np.uint64(width * i) & np.uint64(2**width - 1), 31 + i) for i in range(BLOCKS)], 1)
    keys = np.concatenate([band_keys(words, lengths, size > 3), blocks], 1)
    which, less = [], []
    for i in np.flatnonzero(lengths <= FEW_WORDS).tolist():
        ws = lines[i].split(b" ")
        less.append(xxhash.xxh3_64_intdigest(lines[i]))
        less += [xxhash.xxh3_64_intdigest(b" ".join(ws[:j] + ws[j + 1 :])) for j in range(len(ws))]
        which += [i] * (len(ws) + 1)
    less = mix(np.array(less, np.uint64), 23)
    at = np.concatenate([np.repeat(np.arange(len(lines)), keys.shape[1]), np.array(which, np.int64)])
    return at, np.concatenate([keys.ravel(), less]), np.r_[np.repeat(sims, keys.shape[1]), np.zeros(len(less), np.uint64)]


def _codes(ids: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in ids), ">i8").astype(np.int64)


def _key_rows(batches):
    seen = set()

    def rows(lines, ids):
        at, keys, sims = _keys(lines)
        size = np.array([len(x.decode("utf-8", "replace")) for x in lines])
        size = np.floor(np.log(size) / np.log(STEP)).astype(np.int16)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (keys.view(np.int64), sims.view(np.int64), _codes(ids)[at], size[at])], ["key", "sim", "code", "size"])

    for b in batches:
        lines, ids, held = [], [], 0
        for text in b.column("text").to_pylist():
            for _, line in judged(text):
                own = xxhash.xxh3_128_digest(line)
                if own in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(own)
                lines.append(line)
                ids.append(own)
                held += len(line)
                if held > 500_000:
                    yield rows(lines, ids)
                    lines, ids, held = [], [], 0
        if lines:
            yield rows(lines, ids)


def _fresh(key: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.r_[True, (key[1:] != key[:-1]) | (code[1:] != code[:-1])]  # a line comes once from each task that read it


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first row and the size of each group, and whether a row's group is large."""
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    size = np.diff(np.r_[first, len(key)])
    return first, size, np.repeat(size, size) > WINDOW + 1


def meet(key: np.ndarray, sim: np.ndarray, code: np.ndarray, length: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of pairs that pass the gate, and whether they are of the first round: all of small groups, of large ones those with the
    first line and a neighbour; rows come sorted by key and SimHash."""
    fresh = _fresh(key, code)
    key, sim, code = key[fresh], sim[fresh], code[fresh]
    length = np.zeros(len(key), np.int16) if length is None else length[fresh]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def near(a, b, early):
        ok = (np.bitwise_count(sim[a] ^ sim[b]) <= GATE) & (code[a] != code[b]) & (np.abs(length[a] - length[b]) <= STEPS)
        found.append((np.minimum(code[a[ok]], code[b[ok]]), np.maximum(code[a[ok]], code[b[ok]]), np.full(ok.sum(), early)))

    first, size, is_large = _groups(key)
    at = np.flatnonzero(key[1:] == key[:-1])
    near(at, at + 1, True)
    large = np.flatnonzero(is_large)
    near(np.repeat(first, size)[large], large, True)
    small = np.flatnonzero(~is_large)
    for gap in range(2, WINDOW + 1):
        at = np.flatnonzero(key[small][gap:] == key[small][:-gap])
        near(small[at], small[at + gap], False)
    x, y, early = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((~early, y, x))
    x, y, early = x[order], y[order], early[order]
    once = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(x) else np.empty(0, bool)
    return x[once], y[once], early[once]


def _meet(batches, members=False):
    """The pairs of ``meet`` or, with ``members``, those of the first round and the rows of large groups and of lines with other pairs: code as x, SimHash as y, no value of early. Rows come sorted by key."""
    held, size = [], 0

    def take(rest: bool):
        """The pairs of all groups that are held but the last, which may go on; a group of ``HELD_ROWS`` is cut, with its first row and ``WINDOW`` others kept."""
        nonlocal held, size
        table = pa.Table.from_batches(held)
        key, sim, code = table.column("key").to_numpy(), table.column("sim").to_numpy().view(np.uint64), table.column("code").to_numpy()
        length = table.column("size").to_numpy() if members else np.zeros(len(key), np.int16)
        stop = len(key) if rest else int(np.searchsorted(key, key[-1]))
        keep = stop if stop else len(key) - WINDOW
        held = [] if rest else table.slice(keep).to_batches() if stop else [*table.slice(0, 1).to_batches(), *table.slice(keep).to_batches()]
        size = sum(b.num_rows for b in held)
        key = key[: stop or len(key)]
        same = key[1:] == key[:-1]
        on = np.flatnonzero(np.r_[False, same] | np.r_[same, False])  # a line alone under a key meets none
        on = on[np.lexsort((code[on], sim[on], key[on]))]
        key, sim, code, length = key[on], sim[on], code[on], length[on]
        if not members:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in meet(key, sim, code, length)], ["x", "y", "early"])
        x, y, early = meet(key, sim, code, length)
        pairs = pa.table([pa.array(c[early]) for c in (x, y, early)], ["x", "y", "early"])
        on = np.flatnonzero(_fresh(key, code))
        _, many, is_large = _groups(key[on])
        on = on[is_large | (np.repeat(many, many) > 2) & np.isin(code[on], np.r_[x[~early], y[~early]])]
        rows = pa.table([pa.array(c[on]) for c in (code, sim.view(np.int64), key, length)], ["x", "y", "key", "size"])
        return pa.concat_tables([pairs, rows], promote_options="default").select(["x", "y", "early", "key", "size"]).combine_chunks()

    def batch(found):
        return [found] if not members else found.to_batches()

    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.num_rows
            if size >= HELD_ROWS:
                yield from batch(take(False))
    if held:
        yield from batch(take(True))


def candidates(docs: DataFrame, distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (x, y) of line codes of the first round; key, code, sim and size of the lines that meet others too. Both read one written table."""
    rows = distinct.count() * (BANDS + BLOCKS + 1)
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    keyed = docs.where("doc_id is not null").select("text").mapInArrow(_key_rows, "key long, sim long, code long, size short")
    met = keyed.repartition(n, "key").sortWithinPartitions("key").mapInArrow(partial(_meet, members=True), "x long, y long, early boolean, key long, size short")
    met = materialize(met, "met")
    pairs = materialize(met.where("early is not null").select("x", "y").distinct(), "line_pairs")
    members = materialize(met.where("early is null").select("key", F.col("x").alias("code"), F.col("y").alias("sim"), "size"), "members")
    drop(met)
    return pairs, members


def _within(starts: np.ndarray, stops: np.ndarray, across: np.ndarray, part: np.ndarray, passes):
    """Places of the pairs of the squares from ``starts`` to ``stops`` that pass; ``across``: those of two parts only."""
    size = stops - starts
    small = np.flatnonzero(np.repeat(size <= SMALL, size))
    ends = np.repeat(stops, size)
    for gap in range(1, min(SMALL, int(size.max()))):
        a = small[small + gap < ends[small]]
        b = a + gap
        a, b = a[ok := passes(a, b) & ((part[a] != part[b]) | ~across[a])], b[ok]
        yield a, b
    for first, stop in zip(starts[size > SMALL].tolist(), stops[size > SMALL].tolist(), strict=True):
        whole = np.arange(first, stop)
        left, right = (whole[part[whole] == part[first]], whole[part[whole] != part[first]]) if across[first] else (whole, whole)
        for at in range(0, len(left), SLICE):
            a, b = np.nonzero(passes(left[at : at + SLICE, None], right))
            a, b = left[at + a], right[b]
            yield (a, b) if across[first] else (a[a < b], b[a < b])


def _keys_of(lists) -> np.ndarray:
    """A row of the keys of each list, filled up with the largest number."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(size), int(size.max())), np.iinfo(np.int64).max)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy()
    return out


def _first_met(shared: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether no lesser key than theirs is shared by the rows of each pair."""
    out = np.ones(len(a), bool)
    for at in range(0, len(a), TURN):
        x, y = a[at : at + TURN], b[at : at + TURN]
        again = (shared[x][:, :, None] == shared[y][:, None, :]).any(axis=2) & (shared[x] < key[x, None])
        out[at : at + TURN] = ~again.any(axis=1)
    return out


def _cross(batches, linked=False):
    """Codes (x, y) of the pairs of each square that pass the gate and are of different components; rows come sorted by square. With ``linked``, those of similar
    lines alone: the nearest of each component are compared first, and pairs that are connected by then are left out."""
    held = None

    def squares(table):
        key, i, j, part, comp, sim, code, size = (table.column(c).to_numpy() for c in ("key", "i", "j", "part", "comp", "sim", "code", "size"))
        sim = sim.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        label = np.unique(comp, return_inverse=True)[1]
        root = np.arange(label.max() + 1)

        def passes(a, b):
            return (np.bitwise_count(sim[a] ^ sim[b]) <= GATE) & (np.abs(size[a] - size[b]) <= STEPS) & (root[label[a]] != root[label[b]])

        def join(a, b):
            for p, q in zip(label[a].tolist(), label[b].tolist(), strict=True):
                while root[p] != p:
                    root[p] = p = root[root[p]]
                while root[q] != q:
                    root[q] = q = root[root[q]]
                root[max(p, q)] = min(p, q)
            while (root != root[root]).any():
                root[:] = root[root]

        def links(a, b):
            x, y = np.minimum(code[a], code[b]), np.maximum(code[a], code[b])
            order = np.lexsort((y, x))
            x, y = x[order], y[order]
            order = order[np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]]  # lines meet under several keys
            a, b = a[order], b[order]
            order = np.argsort(np.bitwise_count(sim[a] ^ sim[b]), kind="stable")
            a, b = a[order], b[order]
            rows = np.unique(np.r_[a, b])
            texts = dict(zip(rows.tolist(), table.column("text").take(pa.array(rows)).to_pylist(), strict=True))
            now = np.zeros(len(a), bool)
            now[np.unique(label[a], return_index=True)[1]] = True
            while len(a):
                nearest = bool(now.any())
                now[: 0 if nearest else TURN] = True
                ok = np.flatnonzero(now)[similar([(texts[p], texts[q]) for p, q in zip(a[now].tolist(), b[now].tolist(), strict=True)], nearest)]
                yield a[ok], b[ok]
                join(a[ok], b[ok])
                rest = ~now & (root[label[a]] != root[label[b]])
                a, b, now = a[rest], b[rest], np.zeros(np.count_nonzero(rest), bool)

        def batch(a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(code[a], code[b])), pa.array(np.maximum(code[a], code[b]))], ["x", "y"])

        found = _within(starts, np.r_[starts[1:], len(key)], i != j, part, passes)
        if not linked:
            yield from (batch(a, b) for a, b in found)
            return
        shared = _keys_of(table.column("keys").combine_chunks())
        waiting, count = [], 0
        for a, b in found:
            first = _first_met(shared, key, a, b)
            pair = a[first], b[first]
            waiting.append(pair)
            count += len(pair[0])
            if count >= TOO_MANY:
                yield from (batch(a, b) for a, b in links(*(np.concatenate(c) for c in zip(*waiting, strict=True))))
                waiting, count = [], 0
        if count:
            yield from (batch(a, b) for a, b in links(*(np.concatenate(c) for c in zip(*waiting, strict=True))))

    for b in batches:
        if b.num_rows:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            ends = [held.column(c)[-1].as_py() for c in ("key", "i", "j")]
            last = np.logical_and.reduce([held.column(c).to_numpy() == x for c, x in zip(("key", "i", "j"), ends, strict=True)])
            stop = int(np.argmax(last))
            if stop:
                yield from squares(held.slice(0, stop))
                held = held.slice(stop)
    if held is not None:
        yield from squares(held)


def cross_links(members: DataFrame, comps: DataFrame, own: DataFrame) -> DataFrame:
    """Links (a, b) of codes of similar lines in one group that pass the gate and are of different components (code, comp), as far as they are needed to connect them. A group is
    dealt to parts, and each two parts meet in a square of their own, to which each of their lines sends its text once."""
    rows = members.join(comps, "code", "left").withColumn("comp", F.coalesce("comp", "code"))
    rows = materialize(rows, "labelled")
    apart = rows.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("n")).where("least < most")
    dealt = rows.join(apart.select("key", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "key").withColumn("part", F.pmod(F.xxhash64("code"), "parts").cast("int"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the keys under which a line meets others by the same hash: two lines are compared under the least that they share
    dealt = dealt.repartition(n, "code").withColumn("keys", F.collect_set("key").over(Window.partitionBy("code", "sim")))
    dealt = dealt.join(own.select("code", "text"), "code").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "comp", "sim", "code", "size", "keys", "text")
    found = dealt.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(partial(_cross, linked=True), "x long, y long")
    found = materialize(found.select(F.col("x").alias("a"), F.col("y").alias("b")), "line_links")
    drop(rows)
    return found


def trimmed(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    """The code points of two texts without their equal ends, the shorter one first."""
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    short = min(len(x), len(y))
    differ = np.flatnonzero(x[:short] != y[:short])
    head = int(differ[0]) if len(differ) else short
    x, y = x[head:], y[head:]
    short = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - short :][::-1] != y[len(y) - short :][::-1])
    foot = int(differ[0]) if len(differ) else short
    x, y = x[: len(x) - foot], y[: len(y) - foot]
    return (x, y) if len(x) <= len(y) else (y, x)


def distances(pairs: list[tuple[np.ndarray, np.ndarray]], most: int | list[int]) -> np.ndarray:
    """Edit distances of pairs (shorter, longer) of code points that are at most ``most``, for others some number above it: columns of bits of all pairs at once,
    64 rows in a number. A path of so few edits stays within half of them from the diagonals of its ends, and only these rows are worked on; a pair is left as soon as
    all its rows of a column lie above its bound."""
    m, t = (np.array([len(p[i]) for p in pairs]) for i in (0, 1))
    falling = np.argsort(-t, kind="stable")  # so the pairs that a column belongs to stand first
    given, pairs, own, m, t, most = pairs, [pairs[i] for i in falling.tolist()], falling, m[falling], t[falling], np.broadcast_to(most, len(pairs))[falling]
    out = np.empty(len(pairs), np.int64)
    out[own] = np.maximum(t, most + 1)
    n = len(pairs)
    flat = np.concatenate([c for p in pairs for c in p])
    seen = np.zeros(int(flat.max()) + 1, np.int64)
    seen[flat] = 1
    kinds = int(seen.sum())
    codes = (np.cumsum(seen) - 1)[flat]
    size = np.stack([m, t], 1).ravel()
    first = np.repeat(np.arange(2 * n) % 2 == 0, size)
    blocks = -(-int(m.max()) // 64)
    rows = np.full((n, 64 * blocks), kinds)  # a kind of its own behind the end
    rows[np.arange(64 * blocks) < m[:, None]] = codes[first]
    place = np.zeros((blocks, kinds + 1, n), np.uint64)
    for i in range(64):
        place[np.arange(blocks), rows[:, i::64], np.arange(n)[:, None]] |= np.uint64(1 << i)
    columns = np.full((n, int(t[0])), kinds)
    columns[np.arange(int(t[0])) < t[:, None]] = codes[~first]
    columns = np.ascontiguousarray(columns.T)

    above, below = ((most + t - m) // 2).max(), ((most - t + m) // 2).max()
    up, down = np.full((blocks, n), _ALL), np.zeros((blocks, n), np.uint64)
    bottom = np.zeros((blocks, n), np.int64)  # the distance in the last row of each block
    soon = (most - (t - m)).min()  # the diagonal costs no more than its columns
    begun, at, places = 0, np.arange(n), place.reshape(blocks, -1)
    a, b, c, across, more, less = np.empty((6, n), np.uint64)
    top = np.full(n, 63, np.uint64)
    here, ends = n, np.searchsorted(-t, -np.arange(int(t[0])), side="left")  # pairs that have a column j
    for j in range(int(t[0])):
        here = int(ends[j])
        if not here:
            break
        start, stop = max(0, j - above) // 64, min(blocks, (j + below) // 64 + 1)
        for k in range(begun, stop):
            up[k, :here], down[k, :here] = _ALL, 0
            bottom[k, :here] = (bottom[k - 1, :here] if k else j) + 64
        begun = stop
        kind = columns[j, :here] * len(own) + at[:here]
        x, y, z, w, p, q = a[:here], b[:here], c[:here], across[:here], more[:here], less[:here]
        p.fill(1)
        q.fill(0)
        for k in range(start, stop):
            v, u, same = up[k, :here], down[k, :here], places[k].take(kind)
            np.bitwise_or(same, u, out=w)
            same |= q
            np.bitwise_and(same, v, out=x)
            x += v
            x ^= v
            x |= same
            np.bitwise_or(x, v, out=y)
            np.invert(y, out=y)
            y |= u
            x &= v
            np.right_shift(y, top[:here], out=z)
            y += y
            y |= p
            p[:] = z
            np.right_shift(x, top[:here], out=z)
            x += x
            x |= q
            q[:] = z
            np.bitwise_and(y, w, out=u)
            np.bitwise_or(y, w, out=v)
            np.invert(v, out=v)
            v |= x
            step = bottom[k, :here]
            step += p.view(np.int64)
            step -= q.view(np.int64)
        if j % 32 == 31 and j >= soon and stop > start:
            # neighbouring rows differ by at most one, so rows eight apart bound what is between; what is left costs the difference of its lengths at least
            x, y = up[start:stop, None, :here], down[start:stop, None, :here]
            points = (bottom[start:stop, None, :here] - np.bitwise_count(x >> _EIGHTHS) + np.bitwise_count(y >> _EIGHTHS)).reshape(-1, here)
            head = points[:1] - np.bitwise_count(up[start, :here] & np.uint64(255)) + np.bitwise_count(down[start, :here] & np.uint64(255))
            points = np.concatenate([head, points])
            ahead = (t - m)[:here] - (j + 1) + np.arange(64 * start, 64 * stop + 1, 8)[:, None]
            least = (points[:-1] + points[1:] - 8) // 2 + np.maximum(0, np.maximum(ahead[:-1], -ahead[1:]))
            stay = np.r_[least.min(axis=0) <= most[:here], np.ones(len(own) - here, bool)]
            if not stay.any():
                return out
            if stay.sum() < 0.8 * len(own):
                stay = np.flatnonzero(stay)
                own, m, t, most = own[stay], m[stay], t[stay], most[stay]
                if len(own) * int(t[0]) < FEW * (stop - start) * (int(t[0]) - j):
                    out[own] = [long_distance(*(c.tolist() for c in given[i]), bound) for i, bound in zip(own.tolist(), most.tolist(), strict=True)]
                    return out
                place, up, down, bottom, columns = place[:, :, stay], up[:, stay], down[:, stay], bottom[:, stay], columns[:, stay]
                places, at, ends = place.reshape(blocks, -1), at[: len(own)], np.searchsorted(-t, -np.arange(len(columns)), side="left")
            still = slice(0, int(np.count_nonzero(t > j + 1)) or None)
            above, below = ((most + t - m)[still] // 2).max(), ((most - t + m)[still] // 2).max()
    every = np.arange(len(own))
    last, rows = (m - 1) // 64, ((m - 1) % 64 + 1).astype(np.uint64)
    beyond = np.where(rows == 64, np.uint64(0), _ALL << (rows % np.uint64(64)))
    found = bottom[last, every] - np.bitwise_count(up[last, every] & beyond).astype(np.int64) + np.bitwise_count(down[last, every] & beyond)
    out[own] = np.where(t - m <= most, found, np.maximum(t, most + 1))
    return out


def long_distance(x: list[int], y: list[int], most: int | None = None) -> int:
    """The edit distance of one pair, the shorter text first, or some number above ``most`` if it is more: columns of bits in numbers of any length, for pairs of which few stand
    together. Columns are worked on in runs, each on the rows that a path of so few edits can pass."""
    m, t = len(x), len(y)
    if m > t:
        return long_distance(y, x, most)
    most = t if most is None else most
    if t - m > most:
        return t
    place: dict[int, int] = {}
    for i, c in enumerate(x):
        place[c] = place.get(c, 0) | 1 << i
    above, below, step = (most + t - m) // 2, (most - t + m) // 2, max(256, most // 4)
    up = down = begin = end = distance = 0  # rows from begin to end, and the distance in the last of them
    for at in range(0, t, step):
        until = min(t, at + step)
        skip, begin = max(0, at - above) - begin, max(0, at - above)
        more, old, end = min(m, until + below) - end, end, min(m, until + below)
        up, down, distance = up >> skip | (1 << more) - 1 << old - begin, down >> skip, distance + more
        full, top = (1 << end - begin) - 1, 1 << end - begin - 1
        window = {c: v >> begin & full for c, v in place.items()}
        for c in y[at:until]:
            same = window.get(c, 0)
            across = same | down
            diagonal = (((same & up) + up) ^ up) | across
            over, under = down | ~(diagonal | up) & full, up & diagonal
            distance += bool(over & top) - bool(under & top)
            over, under = (over << 1 | 1) & full, under << 1 & full
            up, down = under | ~(across | over) & full, over & across
        if until > most - t + m:
            # rows of the column eight apart bound those between; what is left costs the difference of its lengths at least
            bits = [np.bitwise_count(np.frombuffer(v.to_bytes(-(-(end - begin) // 8), "little"), np.uint8)).astype(np.int64) for v in (up, down)]
            values = np.r_[0, np.cumsum(bits[0] - bits[1])]
            values += distance - values[-1]
            left = t - until - m + np.minimum(np.arange(begin, end + 8, 8)[: len(values)], end)
            if ((values[:-1] + values[1:] - 8) // 2 + np.maximum(0, np.maximum(left[:-1], -left[1:])) > most).all():
                return most + 1
    return distance if distance <= most else max(distance, most + 1)


def aligned(a: str, b: str, most: int) -> bool:
    """Whether the words that follow one another in both texts show a path of at most ``most`` edits, where a run of other words costs its longer side. False tells nothing."""
    x, y = [*a.split(" "), "", ""], [*b.split(" "), "", ""]
    i, j, spent, n, m = 0, 0, 0, len(x) - 2, len(y) - 2
    while i < n or j < m:
        if x[i] == y[j]:
            i += 1
            j += 1
            continue
        for s in range(1, AHEAD + 1):
            for d in range(max(0, s - m + j), min(s, n - i) + 1):
                if x[i + d] == y[j + s - d] and x[i + d + 1] == y[j + s - d + 1]:
                    break
            else:
                continue
            break
        else:
            near = {}
            for e in range(min(FAR, m - j) - 1, -1, -1):
                near[y[j + e], y[j + e + 1]] = e
            s, d = min(((d + near[p], d) for d in range(min(FAR, n - i)) if (p := (x[i + d], x[i + d + 1])) in near), default=(0, 0))
            if not s:
                return False
        spent += max(d + sum(map(len, x[i : i + d])), s - d + sum(map(len, y[j : j + s - d])))
        i += d
        j += s - d
        if spent > most or spent > most * (0.3 + 2 * i / n):  # above, or far from what similar lines have here
            return False
    return True


def similar(pairs: list[tuple[str, str]], align: bool = True) -> np.ndarray:
    """Whether the edit similarity of each pair of texts is at least ``SIMILARITY``. Pairs that are mostly not similar are faster without being aligned first."""
    out = np.zeros(len(pairs), bool)
    rest = []
    for i, (a, b) in enumerate(pairs):
        most = int(max(len(a), len(b)) * (1 - SIMILARITY) + 1e-9)
        if abs(len(a) - len(b)) <= most:
            if align and len(a) > ALIGNED and aligned(a, b, most):
                out[i] = True
                continue
            x, y = trimmed(a, b)
            if len(y) <= most:
                out[i] = True
            elif len(x):
                rest.append((len(y), i, most, x, y))
    rest.sort(key=lambda r: (r[2] // 64, r[0], r[1]))
    at = 0
    while at < len(rest):  # pairs of bands of about one width together
        size = max(1, min(2048, 2_000_000 // (rest[at][0] + 64)))
        while size > 1 and (rest[min(at + size, len(rest)) - 1][0] > (1.5 if size > TOGETHER else 3) * rest[at][0] + 64 or rest[min(at + size, len(rest)) - 1][2] // 64 > (rest[at][2] // 64) * (1 if size > TOGETHER else 1.5)):
            size = size // 2
        part = rest[at : at + size]
        at += size
        if len(part) < FEW * (part[-1][2] // 64 + 1):
            found = [long_distance(r[3].tolist(), r[4].tolist(), r[2]) for r in part]
        else:
            found = distances([r[3:] for r in part], [r[2] for r in part]).tolist()
        for r, d in zip(part, found, strict=True):
            out[r[1]] = d <= r[2]
    return out


def _similar(batches):
    for b in batches:
        keep = similar(list(zip(b.column("text_x").to_pylist(), b.column("text_y").to_pylist(), strict=True)))
        yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y")], ["a", "b"]).filter(pa.array(keep))


def line_texts(codes: DataFrame, docs: DataFrame) -> DataFrame:
    """id, code and normalised text of the lines with these codes; of several with one code, one. What a task sends is chosen by a table of bits of
    fixed size, so that few texts of other lines are shuffled."""
    spark, mask = docs.sparkSession, 2**FILTER_BITS - 1
    codes = materialize(codes.distinct(), "need")
    words = codes.select(F.expr(f"cast(shiftright(code & {mask}, 6) as int)").alias("word"), F.expr("shiftleft(1L, cast(code & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(2 ** (FILTER_BITS - 6), np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(bits)

    def fetch(batches):
        bits = shared.value.view(np.uint64)
        for b in batches:
            lines = [line for text in b.column("text").to_pylist() for _, line in judged(text)]
            ids = [xxhash.xxh3_128_digest(x) for x in lines]
            code = _codes(ids)
            want = np.flatnonzero(bits[(code & mask) >> 6] >> (code & 63).astype(np.uint64) & np.uint64(1)).tolist()
            texts = pa.array([lines[i].decode("utf-8", "replace") for i in want], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(code[want]), pa.array([ids[i] for i in want], pa.binary()), texts], ["code", "id", "text"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.where("doc_id is not null").select("text").mapInArrow(fetch, "code long, id binary, text string").repartition(n, "code")
    found = found.join(codes.hint("merge"), "code", "left_semi").dropDuplicates(["code"])
    # in buckets, so that the joins with pairs and squares don't shuffle all texts again
    path = new_path(spark, "line_texts")
    name = path.rpartition("/")[2].replace("-", "_")
    found.write.bucketBy(n, "code").sortBy("code").format("parquet").option("compression", "zstd").option("path", path).saveAsTable(name)
    drop(codes)
    own = spark.table(name)
    own._tarn_path, own._tarn_table = path, name
    return own


def verify(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """The pairs (a, b) of codes whose normalised lines are similar, of pairs (x, y) of codes; ``own`` has the lines' texts."""
    left, right = (own.select(F.col("code").alias(c), F.col("text").alias(f"text_{c}")) for c in "xy")
    near = F.abs(F.length("text_x") - F.length("text_y")) <= F.floor(F.greatest(F.length("text_x"), F.length("text_y")) * (1 - SIMILARITY) + 1e-9)
    # the distance is the costly step: a fixed number of partitions keeps it from being merged into few tasks by its bytes
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = pairs.select("x", "y").join(left, "x").repartition(n, "y").join(right, "y").where(near).select("x", "y", "text_x", "text_y")
    return materialize(both.mapInArrow(_similar, "a long, b long"), "line_links")


def connect(pairs: DataFrame, members: DataFrame, own: DataFrame) -> DataFrame:
    """code and comp of the lines that similar ones are known of, by the two rounds."""
    links = verify(pairs, own)
    nodes = components(links)
    comps = nodes.withColumnRenamed("id", "code")
    more = cross_links(members, comps, own)
    last = components(more.unionByName(nodes.select(F.col("id").alias("a"), F.col("comp").alias("b"))))
    for df in (links, nodes, more):
        drop(df)
    out = last.withColumnRenamed("id", "code")
    out._tarn_path = last._tarn_path
    return out


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (those that are judged) and removed, the sorted numbers of the lines that go, for every document."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = materialize(slim.where("doc_id is not null").mapInArrow(_lines, "doc_id long, line int, id binary"), "lines")
    # a number that orders as (doc_id, line): a struct's least is found by sorting, a number's by hashing
    found = found.withColumn("place", F.expr("cast(doc_id as decimal(20, 0)) * 2147483648BD + line"))
    distinct = materialize(found.groupBy("id").agg(F.min("place").alias("first"), F.count("*").alias("n")), "distinct")
    pairs, members = candidates(slim, distinct)
    codes = pairs.select(F.explode(F.array("x", "y")).alias("code")).unionByName(members.select("code"))
    own = line_texts(codes, slim)
    by_code = connect(pairs, members, own)
    comps = materialize(own.select("id", "code").join(by_code, "code").select("id", "comp"), "line_comps")
    docs.sparkSession.sql(f"drop table {own._tarn_table}")
    for df in (pairs, members, own, by_code):
        drop(df)
    groups = distinct.join(comps, "id").select("id", "first", "comp")
    best = groups.groupBy("comp").agg(F.min("first").alias("keep"))
    alone = distinct.where("n > 1").join(comps, "id", "left_anti").select("id", F.col("first").alias("keep"))
    repeated = groups.join(best, "comp").select("id", "keep").unionByName(alone)
    gone = found.join(repeated, "id").where(F.col("place") != F.col("keep"))
    gone = gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    counts = found.groupBy("doc_id").agg(F.size(F.collect_set("line")).alias("n_lines"))  # one partial set a document, as its lines come from one task
    ids = slim.select("doc_id").join(counts, "doc_id", "left").join(gone, "doc_id", "left")
    return ids.select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("removed", F.expr("cast(array() as array<int>)")).alias("removed"))


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines taken out of the texts."""
    gone = dedup_lines(docs).where("doc_id is not null and size(removed) > 0").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("_id"), "removed")
    names = docs.columns
    joined = docs.alias("d").join(gone.alias("g"), F.col("d.doc_id") == F.col("g._id"), "left")
    text = F.array_join(F.filter(F.split(F.col("d.text"), "\n", -1), lambda x, i: ~F.array_contains(F.col("g.removed"), i)), "\n")
    return joined.select(*[F.when(F.col("g._id").isNull(), F.col("d.text")).otherwise(text).alias(c) if c == "text" else F.col(f"d.`{c}`") for c in names])
