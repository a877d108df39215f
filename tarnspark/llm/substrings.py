"""Suffix-array dedup: remove every byte covered by a ``WINDOW``-byte string that also starts earlier.

The comparison of suffixes is spread over the cluster by content and each part is sorted by the difference-cover algorithm (``suffix_array``:
name sampled triples, recurse on the names, merge the other suffixes), after which equal prefixes are adjacent. ``difference_cover`` is the same algorithm with every sort, naming
and merge as tables, for whole texts; README gives the disk that it takes, which is why this operator sorts what is left after step 2 instead.

1. ``anchors``: each window of ``WINDOW`` bytes picks the least hashed ``GRAM``-byte string within it, so equal windows pick equal strings at equal
   offsets. A run of windows with one pick is one anchor row: about 3 rows for 100 bytes, each with a hash of the text its windows span.
2. ``collapse``: anchors with the same pick and the same span are equal windows, and all but the first are removed. This is done
   in each task before the shuffle and again after it, so a text that a third of all documents hold is one row for each task.
3. Picks that are left with several spans: their spans (at most 168 bytes) are gathered by pick, suffix-sorted, and the window starts whose 100-byte prefix equals
   that of an earlier window are removed.
   Picks with more than ``HOT`` rows are judged window by window on a 128-bit hash in an aggregate instead, with the same result,
   so that no task holds them all.
4. The removed runs of a document meet its text again, in which they are merged and cut.

Defined cases: null and empty texts have no bytes; rows without a doc_id are returned whole and no place; rows of one doc_id and one text count as one place, so
repeated rows don't remove each other and are cut alike; different texts of one doc_id follow each other in the order of their digests; a very long text is
read in pieces; an empty table gives none; other columns, of whatever name, stay out. A place is a doc_id with the number of its text there (0 for nearly all) and an
offset, both in one long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnspark.llm.common import drop, lookup, materialize, with_docs
from tarnspark.llm.words import mix, utf8

WINDOW, GRAM, HOT, PIECE = 100, 32, 200_000, 8_000_000
#: Anchors that a task of the comparison gets.
TASK_ANCHORS = 2_000_000
#: An offset is the low 32 bits of a place, the number of the text the high ones.
_SUB, _OFFSET = 32, 0xFFFFFFFF
_PLACE = ("doc_id", "sub")
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_ANCHOR = "gram long, span long, doc_id long, lo long, hi long, dup boolean"
_NAMES = ["gram", "span", "doc_id", "lo", "hi", "dup"]


class Rolling:
    """Hashes of substrings from prefix sums of b[j] * base**j modulo 2**64."""

    def __init__(self):
        self.up = self.down = None
        self.n = 0

    def grow(self, n: int) -> None:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            with np.errstate(over="ignore"):
                self.up = [np.cumprod(np.r_[np.uint64(1), np.full(self.n, b, np.uint64)]) for b in _BASES]
                self.down = [np.cumprod(np.r_[np.uint64(1), np.full(self.n, pow(b, -1, 1 << 64), np.uint64)]) for b in _BASES]

    def sums(self, raw: np.ndarray, which: int) -> np.ndarray:
        self.grow(len(raw) + 1)
        with np.errstate(over="ignore"):
            return np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[which][: len(raw)])]

    def of(self, sums: np.ndarray, lo, hi, which: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((sums[hi] - sums[lo]) * self.down[which][lo], which)


def window_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    m, k = key, 1
    while 2 * k <= width:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return np.minimum(m[: len(key) - width + 1], m[width - k :]) if width > k else m


def anchors_of(raw: np.ndarray, rolling: Rolling) -> tuple[np.ndarray, ...]:
    """gram hash, span hash, first and last window start of each anchor of a text."""
    parts = []
    for begin in range(0, max(0, len(raw) - WINDOW + 1), PIECE):
        piece = raw[begin : begin + PIECE + WINDOW - 1]
        first, second = rolling.sums(piece, 0), rolling.sums(piece, 1)
        n = len(piece) - GRAM + 1
        with np.errstate(over="ignore"):
            key = mix((first[GRAM:] - first[:n]) * rolling.down[0][:n], 0)
        low = (key & ~np.uint64(0xFFFFFF)) | (np.uint64(0xFFFFFF) - np.arange(n, dtype=np.uint64))
        pick = 0xFFFFFF - (window_min(low, WINDOW - GRAM + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        lo = np.flatnonzero(np.r_[True, pick[1:] != pick[:-1]])
        hi = np.r_[lo[1:], len(pick)] - 1
        with np.errstate(over="ignore"):
            span = mix(rolling.of(second, lo, hi + WINDOW, 1) + (pick[lo] - lo).astype(np.uint64) * np.uint64(1 << 20) + (hi - lo).astype(np.uint64), 9)
        parts.append((key[pick[lo]].view(np.int64), span.view(np.int64), lo + begin, hi + begin))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def collapse(gram: np.ndarray, span: np.ndarray, doc: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by gram, span and place; and which rows, in that order, repeat an earlier place's span."""
    order = np.lexsort((lo, doc, span, gram))
    g, s, d, p = gram[order], span[order], doc[order], lo[order]
    fresh = np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])] if len(g) else np.empty(0, bool)
    head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(g) else np.empty(0, np.int64)
    return order, (d != d[head]) | (p != p[head])


def _anchor_rows(batches, flush: int = 24_000_000):
    rolling, held, size = Rolling(), [], 0

    def rows():
        gram, span, lo, hi, doc = (np.concatenate(x) for x in zip(*held, strict=True))
        order, dup = collapse(gram, span, doc, lo)
        cells = [gram[order], span[order], doc[order], lo[order], hi[order], dup]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cells], _NAMES)

    for b in batches:
        for doc_id, sub, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "sub", "text")), strict=True):
            raw = np.frombuffer(utf8(text), np.uint8)
            if len(raw) >= WINDOW:
                gram, span, lo, hi = anchors_of(raw, rolling)
                held.append((gram, span, lo + (sub << _SUB), hi + (sub << _SUB), np.full(len(gram), doc_id, np.int64)))
                size += len(raw)
                if size >= flush:
                    yield rows()
                    held, size = [], 0
    if held:
        yield rows()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes of an array of numbers in order, by the difference cover {1, 2} modulo 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.r_[np.unique(text, return_inverse=True)[1].astype(np.int64) + 1, 0, 0, 0]
    sample = np.r_[np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)]  # the sample ends with a triple of padding where it must
    half = len(np.arange(1, n + (n % 3 == 1), 3))
    top = int(t.max()) + 1
    triples = (t[sample] * top + t[sample + 1]) * top + t[sample + 2] if top < 2_000_000 else np.unique(np.stack([t[sample], t[sample + 1], t[sample + 2]], 1), axis=0, return_inverse=True)[1].ravel()
    names = np.unique(triples, return_inverse=True)[1].astype(np.int64) + 1
    if len(sample) and names.max() < len(sample):
        order = suffix_array(names)
    else:
        order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    rank[n:] = 0
    sorted12 = sample[order]
    sorted12 = sorted12[sorted12 < n]
    zero = np.arange(0, n, 3)
    zero = zero[np.lexsort((rank[zero + 1], t[zero]))]
    # how many sampled suffixes precede each other one: those at 1 mod 3 compare by one symbol and a rank, those at 2 mod 3 by two
    big = n + 4
    one, two = sorted12[sorted12 % 3 == 1], sorted12[sorted12 % 3 == 2]
    before = np.searchsorted(t[one] * big + rank[one + 1], t[zero] * big + rank[zero + 1])
    if top * top < (1 << 62) // big:
        key = lambda i: (t[i] * top + t[i + 1]) * big + rank[i + 2]
        before = before + np.searchsorted(key(two), key(zero))
    else:
        both = np.r_[two, zero]
        place = np.lexsort((np.r_[np.ones(len(two)), np.zeros(len(zero))], rank[both + 2], t[both + 1], t[both]))
        less = np.cumsum(place < len(two))
        counts = np.empty(len(both), np.int64)
        counts[place] = less
        before = before + counts[len(two) :]
    out = np.empty(n, np.int64)
    at = before + np.arange(len(zero))
    out[at] = zero
    rest = np.ones(n, bool)
    rest[at] = False
    out[rest] = sorted12
    return out


def repeated_starts(spans: list[bytes], doc: np.ndarray, lo: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each span, which of its ``starts`` first positions begin a window that also begins at an earlier place."""
    raw = np.frombuffer(b"".join(spans), np.uint8)
    length = np.array([len(s) for s in spans])
    begin = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(spans)), length)
    offset = np.arange(len(raw)) - begin[owner]
    order = suffix_array(raw)
    order = order[offset[order] < starts[owner[order]]]  # window starts alone
    view = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)
    same = np.empty(max(0, len(order) - 1), bool)
    for i in range(0, len(same), 50_000):
        part = order[i : i + 50_001]
        same[i : i + 50_000] = (view[part[1:]] == view[part[:-1]]).all(axis=1)
    group = np.cumsum(np.r_[True, ~same]) - 1 if len(order) else np.empty(0, np.int64)
    place_doc, place = doc[owner[order]], lo[owner[order]] + offset[order]
    by = np.lexsort((place, place_doc, group))
    fresh = np.r_[True, group[by][1:] != group[by][:-1]] if len(by) else np.empty(0, bool)
    head = by[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(by) else by
    later = (place_doc[by] != place_doc[head]) | (place[by] != place[head])
    hit = np.zeros(len(raw), bool)
    hit[order[by[later]]] = True
    return [hit[b : b + k] for b, k in zip(begin, starts, strict=True)]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[0, mask.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _by_gram(batches):
    """One shuffled partition of anchors: what repeats an earlier span (dup), and what is left of grams with several spans."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    gram, span, doc, lo, hi = (table.column(c).to_numpy() for c in _NAMES[:5])
    order, dup = collapse(gram, span, doc, lo)
    g, s = gram[order], span[order]
    fresh = np.r_[True, g[1:] != g[:-1]]
    group = np.cumsum(fresh) - 1
    new = np.r_[True, fresh[1:] | (s[1:] != s[:-1])]
    several = np.bincount(group, weights=new)[group] > 1
    keep = dup | (several & new)
    cells = [g[keep], s[keep], doc[order][keep], lo[order][keep], hi[order][keep], dup[keep]]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cells], _NAMES)


def _cut_spans(batches):
    for b in batches:
        out = [[], [], [], [], []]
        for doc_id, text, want in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("want").to_pylist(), strict=True):
            raw = utf8(text)
            for w in want:
                for cell, x in zip(out, (w["gram"], doc_id, w["lo"], w["hi"] - w["lo"] + 1, raw[w["lo"] & _OFFSET : (w["hi"] & _OFFSET) + WINDOW]), strict=True):
                    cell.append(x)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["gram", "doc_id", "lo", "starts", "bytes"])


def _sort_spans(batches, block: int = 1_000_000):
    """Suffix-sorts the spans of a partition, which come in order of gram, in blocks of whole grams."""
    held: list[tuple] = []
    size = 0

    def judged():
        _, doc, lo, starts, spans = zip(*held, strict=True)
        lo_a = np.array(lo, np.int64)
        hits = repeated_starts(list(spans), np.array(doc, np.int64), lo_a, np.array(starts, np.int64))
        out = [[], [], []]
        for d, p, mask in zip(doc, lo, hits, strict=True):
            for x, y in zip(*_runs(mask), strict=True):
                for cell, v in zip(out, (d, p + int(x), p + int(y)), strict=True):
                    cell.append(v)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["doc_id", "lo", "hi"])

    for b in batches:
        for row in zip(*[b.column(c).to_pylist() for c in ("gram", "doc_id", "lo", "starts", "bytes")], strict=True):
            if size >= block and row[0] != held[-1][0]:
                yield judged()
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield judged()


def _window_rows(batches):
    rolling = Rolling()
    for b in batches:
        out = [[], [], [], []]
        for doc_id, text, want in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("want").to_pylist(), strict=True):
            raw = np.frombuffer(utf8(text), np.uint8)
            sums = [rolling.sums(raw, k) for k in (0, 1)]
            place = np.concatenate([np.arange(w["lo"], w["hi"] + 1) for w in want])
            at = place & _OFFSET
            for cell, x in zip(out, (np.full(len(at), doc_id), place, *[rolling.of(sums[k], at, at + WINDOW, k).view(np.int64) for k in (0, 1)]), strict=True):
                cell.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["doc_id", "lo", "w0", "w1"])


def _with_texts(want: DataFrame, slim: DataFrame) -> DataFrame:
    return with_docs(slim, want, _PLACE).select("doc_id", "text", "want")


def _wanted(rows: DataFrame) -> DataFrame:
    """doc_id, sub and want, the rows (gram, lo, hi) of the text."""
    return materialize(rows.groupBy("doc_id", F.shiftright("lo", _SUB).alias("sub")).agg(F.collect_list(F.struct("gram", "lo", "hi")).alias("want")), "want")


def repeated_runs(slim: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, lo, hi: runs of window starts (places) that repeat an earlier window. ``slim``: doc_id, sub, text."""
    spark = slim.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    found = materialize(slim.mapInArrow(_anchor_rows, _ANCHOR), "anchors")
    live = found.where("not dup")
    parts = max(parts, -(-live.count() // TASK_ANCHORS))
    # a sample decides which way a gram is judged, not the result
    step = max(1, hot // 1000)
    often = live.where(F.pmod(F.xxhash64("doc_id", "lo"), F.lit(step)) == 0).groupBy("gram").count().where(F.col("count") * step > hot).select("gram")
    often = materialize(often, "often")
    rare = live.join(lookup(often), "gram", "left_anti")
    judged = materialize(rare.repartition(parts, "gram").mapInArrow(_by_gram, _ANCHOR), "judged")
    wanted = [_wanted(judged.where("not dup"))]
    spans = _with_texts(wanted[0], slim).mapInArrow(_cut_spans, "gram long, doc_id long, lo long, starts int, bytes binary")
    sorted_runs = spans.repartition(parts, "gram").sortWithinPartitions("gram").mapInArrow(_sort_spans, "doc_id long, lo long, hi long")
    runs = sorted_runs.unionByName(judged.where("dup").select("doc_id", "lo", "hi")).unionByName(found.where("dup").select("doc_id", "lo", "hi"))
    many = live.join(lookup(often), "gram", "left_semi")
    if many.limit(1).count():
        wanted.append(_wanted(many))
        windows = materialize(_with_texts(wanted[1], slim).mapInArrow(_window_rows, "doc_id long, lo long, w0 long, w1 long"), "windows")
        wanted.append(windows)
        first = windows.groupBy("w0", "w1").agg(F.min(F.struct("doc_id", "lo")).alias("first"), F.count("*").alias("n")).where("n > 1").select("w0", "w1", "first")
        again = windows.join(first, ["w0", "w1"]).where(F.struct("doc_id", "lo") != F.col("first"))
        runs = runs.unionByName(again.select("doc_id", "lo", F.col("lo").alias("hi")))
    runs = materialize(runs, "runs")
    for table in (found, judged, often, *wanted):
        drop(table)
    return runs


def merged(runs: list[dict], n: int) -> list[tuple[int, int]]:
    """Removed byte ranges, as (begin, end), of runs of window starts."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"] + WINDOW) for r in runs):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, min(b, n)) for a, b in out]


def _apply(batches):
    for b in batches:
        kept, spans = [], []
        for text, runs in zip(b.column("text").to_pylist(), b.column("runs").to_pylist(), strict=True):
            raw = utf8(text)
            gone = merged(runs, len(raw))
            ends = [0, *[e for _, e in gone]]
            kept.append(b"".join(raw[a:z] for a, z in zip(ends, [*[x for x, _ in gone], len(raw)], strict=True)))
            spans.append([{"begin": x, "end": y} for x, y in gone])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))], ["doc_id", "kept", "spans"])


def _numbered(slim: DataFrame) -> DataFrame:
    """doc_id, sub, text of the rows with a doc_id: sub numbers the different texts of a doc_id from 0. Only the ids are read to find those with several rows."""
    again = materialize(slim.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    rows = slim.where("doc_id is not null")
    if again.isEmpty():
        drop(again)
        return rows.select("doc_id", F.lit(0).cast("long").alias("sub"), "text")
    again = lookup(again)
    several = rows.join(again, "doc_id", "left_semi").withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    each = several.select("doc_id", "digest").distinct()
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("digest")) - 1
    each = each.select("doc_id", "digest", number.cast("long").alias("sub"))
    return rows.join(again, "doc_id", "left_anti").select("doc_id", F.lit(0).cast("long").alias("sub"), "text").unionByName(several.join(each, ["doc_id", "digest"]).select("doc_id", "sub", "text"))


def dedup_substrings(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, kept (binary) and spans (array of begin, end) of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    usable = _numbered(slim)
    found = repeated_runs(usable, hot)
    offset = lambda c: F.col(c).bitwiseAND(_OFFSET).cast("int").alias(c)
    runs = found.groupBy("doc_id", F.shiftright("lo", _SUB).alias("sub")).agg(F.collect_list(F.struct(offset("lo"), offset("hi"))).alias("runs"))
    runs = materialize(runs, "doc_runs")
    drop(found)
    cut = with_docs(usable, runs, _PLACE).select("doc_id", "text", "runs").mapInArrow(_apply, "doc_id long, kept binary, spans array<struct<begin:int,end:int>>")
    whole = usable.join(lookup(runs.select(*_PLACE)), list(_PLACE), "left_anti").select("doc_id", "text").unionByName(slim.where("doc_id is null"))
    whole = whole.select("doc_id", F.col("text").cast("binary").alias("kept"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["begin"]))
    return cut.unionByName(whole).select("doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"), "kept", "spans")
