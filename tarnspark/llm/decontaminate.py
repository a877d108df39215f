"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores the postings of all training words: each task folds its documents into shards of about
``SHARD_WORDS`` words, one row a shard with its documents, its sorted terms (64-bit word hashes) and each
term's positions. A shard is whole for its documents, so queries need no shuffle and a hot term, source or
passage lies spread over all shards. ``search`` counts the test terms over all shards, then intersects, in each shard and
for each window of the test set, the offset-adjusted position lists from the window's rarest term on; with slop 0
the result are exact phrases, else proximity matches (every term within ``slop`` words of its place). Test items are a table of chunks of at most ``CHUNK_WORDS`` words, each
with the windows that start in it, dealt into blocks of about ``BLOCK_WORDS`` words by a hash. One block at a time, of a counted size, is broadcast as numbers; its hits are written before the next.

Defined cases: null and empty texts have no words and are never hit, null or wordless items have no window; items without an id are
ignored, ids of any type are taken as text; null doc_ids and repeated rows are documents of their own; a very
long text is a shard of its own size, whole; empty tables work on either side; other columns, of whatever name, stay out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnspark.llm.common import drop, materialize
from tarnspark.llm.words import Hashes, fold_words

WINDOW, SHARD_WORDS, BLOCK_WORDS, CHUNK_WORDS = 13, 1_000_000, 500_000, 50_000
_INDEX = "shard string, doc_ids array<bigint>, lengths binary, terms binary, counts binary, positions binary"


def _shard(name: str, ids: list, rows: list[np.ndarray], gap: int) -> pa.RecordBatch:
    lengths = np.array([len(r) for r in rows], np.uint32)
    starts = np.cumsum(lengths.astype(np.int64) + gap) - (lengths + np.int64(gap))
    words = np.concatenate(rows)
    place = (np.arange(len(words)) + np.repeat(starts - (np.cumsum(lengths, dtype=np.int64) - lengths), lengths)).astype(np.uint32)
    order = np.argsort(words, kind="stable")
    words = words[order]
    first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.empty(0, np.int64)
    counts = np.diff(np.r_[first, len(words)]).astype(np.uint32)
    cells = [[name], [ids], [lengths.tobytes()], [words[first].tobytes()], [counts.tobytes()], [place[order].tobytes()]]
    kinds = [pa.string(), pa.list_(pa.int64()), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], ["shard", "doc_ids", "lengths", "terms", "counts", "positions"])


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    def run(batches):
        from pyspark import TaskContext

        part, cache, n = TaskContext.get().partitionId(), Hashes(), 0
        ids, rows, held = [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = cache.of(fold_words(text))
                ids.append(doc_id)
                rows.append(w)
                held += len(w) + 1
                if held >= shard_words:
                    yield _shard(f"{part}-{n}", ids, rows, 1)
                    ids, rows, held, n = [], [], 0, n + 1
        if ids:
            yield _shard(f"{part}-{n}", ids, rows, 1)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, _INDEX)


def _binary(batch, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in batch.column(name).to_pylist()]


def windows_of(chunks: list[tuple[str, np.ndarray]], width: int = WINDOW) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes laid end to end, names of items, and of each window: the place of its item's name, its start, its length)."""
    names: dict[str, int] = {}
    size = np.array([len(w) for _, w in chunks], np.int64)
    length = np.minimum(size, width)
    count = size - length + 1
    first = np.repeat(np.cumsum(size) - size, count)
    start = first + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    owner = np.repeat(np.array([names.setdefault(i, len(names)) for i, _ in chunks], np.int64), count)
    return np.concatenate([w for _, w in chunks]), list(names), owner, start, np.repeat(length, count)


def count_terms(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Postings of each of the sorted ``terms`` over all shards: as many rows come back as there are test terms."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        total = np.zeros(len(terms), np.int64)
        for b in batches:
            for have, counts in zip(_binary(b, "terms", np.uint64), _binary(b, "counts", np.uint32), strict=True):
                if len(have):
                    at = np.minimum(np.searchsorted(have, shared.value), len(have) - 1)
                    total += np.where(have[at] == shared.value, counts[at], 0)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["k", "n"])

    out = np.zeros(len(terms), np.int64)
    rows = index.select("terms", "counts").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out[rows.column("k").to_numpy()] = rows.column("n").to_numpy()
    shared.unpersist()
    return out


def _intersect(keys: np.ndarray, have: np.ndarray, ends: np.ndarray, doc_first: np.ndarray, lengths: np.ndarray, query, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, position of its first word) of all matches in one shard. ``keys``: term number << 32 | position, sorted."""
    flat, start, length, order = query
    term = np.minimum(np.searchsorted(have, flat), len(have) - 1)
    known = have[term] == flat
    missing = np.r_[0, np.cumsum(~known)]
    alive = np.flatnonzero(missing[start + length] == missing[start])
    found_w, found_p = [], []
    size = ends[term] - np.r_[0, ends][term]
    for chunk in np.array_split(alive, max(1, -(-int(size[start[alive] + order[alive, 0]].sum()) // 2_000_000))) if len(alive) else []:
        rare = start[chunk] + order[chunk, 0]
        n = size[rare]
        window = np.repeat(chunk, n)
        index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[term[rare]] - n, n)
        begin = (keys[index] & np.uint64(0xFFFFFFFF)).astype(np.int64) - order[window, 0]
        doc = np.searchsorted(doc_first, (begin + order[window, 0]), side="right") - 1
        low, high = doc_first[doc], doc_first[doc] + lengths[doc] - 1
        for step in range(1, order.shape[1]):
            left = step < length[window]
            off = order[window, step]
            want = term[start[window] + np.where(left, off, 0)].astype(np.int64) << 32
            near, far = np.maximum(begin + off - slop, low), np.minimum(begin + off + slop, high)
            at = np.searchsorted(keys, (want + near).astype(np.uint64))
            hit = np.where(at < len(keys), keys[np.minimum(at, len(keys) - 1)], np.uint64(0)).astype(np.int64)
            ok = ~left | ((near <= far) & (hit >= want + near) & (hit <= want + far))
            window, begin, low, high = window[ok], begin[ok], low[ok], high[ok]
            if not len(window):
                break
        found_w.append(window)
        found_p.append(begin)
    return np.concatenate(found_w or [np.empty(0, np.int64)]), np.concatenate(found_p or [np.empty(0, np.int64)])


def search(index: DataFrame, chunks: list[tuple[str, np.ndarray]], width: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row for each document with a match of one block of items: shard, ord (its place in the shard), doc_id, spans
    (begin and end of the runs of covered words) and item_ids. The rows are written."""
    flat, names, owner, start, length = windows_of(chunks, width)
    terms, at = np.unique(flat, return_inverse=True)
    frequency = count_terms(index, terms)[at]
    within = np.arange(width) < length[:, None]
    order = np.argsort(np.where(within, frequency[np.minimum(start[:, None] + np.arange(width), len(flat) - 1)], np.iinfo(np.int64).max), axis=1, kind="stable")
    order = np.where(within, order, 0)  # offsets of a window's words, rarest first
    shared = index.sparkSession.sparkContext.broadcast((flat, names, owner, start, length, order))

    def run(batches):
        flat, names, owner, start, length, order = shared.value
        for b in batches:
            cells = [_binary(b, "lengths", np.uint32), _binary(b, "terms", np.uint64), _binary(b, "counts", np.uint32), _binary(b, "positions", np.uint32)]
            for shard, doc_ids, lengths, have, counts, places in zip(b.column("shard").to_pylist(), b.column("doc_ids").to_pylist(), *cells, strict=True):
                if not len(have) or not len(start):
                    continue
                lengths = lengths.astype(np.int64)
                doc_first = np.cumsum(lengths + 1) - (lengths + 1)
                ends = np.cumsum(counts, dtype=np.int64)
                keys = (np.repeat(np.arange(len(have), dtype=np.uint64), counts) << np.uint64(32)) | places
                w, p = _intersect(keys, have, ends, doc_first, lengths, (flat, start, length, order), slop)
                if not len(w):
                    continue
                doc = np.searchsorted(doc_first, p + order[w, 0], side="right") - 1
                rows = []
                for d in np.unique(doc):
                    mine = doc == d
                    cover = np.zeros(lengths[d] + 1, np.int64)
                    np.add.at(cover, np.clip(p[mine] - doc_first[d], 0, lengths[d]), 1)
                    np.add.at(cover, np.clip(p[mine] + length[w[mine]] - doc_first[d], 0, lengths[d]), -1)
                    on = np.diff(np.r_[0, (np.cumsum(cover)[:-1] > 0).astype(np.int8), 0])
                    spans = [{"b": int(x), "e": int(y)} for x, y in zip(np.flatnonzero(on == 1), np.flatnonzero(on == -1), strict=True)]
                    rows.append((shard, int(d), doc_ids[d], spans, [names[i] for i in np.unique(owner[w[mine]])]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _HIT_KINDS, strict=True)], ["shard", "ord", "doc_id", "spans", "item_ids"])

    found = materialize(index.select("shard", "doc_ids", "lengths", "terms", "counts", "positions").mapInArrow(run, _HITS), "hits")
    shared.unpersist()
    return found


_HITS = "shard string, ord int, doc_id bigint, spans array<struct<b:int,e:int>>, item_ids array<string>"
_HIT_KINDS = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())])), pa.list_(pa.string())]


def _documents(index: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for shard, ids, lengths in zip(b.column("shard").to_pylist(), b.column("doc_ids").to_pylist(), _binary(b, "lengths", np.uint32), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(ids)), pa.array(range(len(ids)), pa.int32()), pa.array(ids, pa.int64()), pa.array(lengths.astype(np.int64))], ["shard", "ord", "doc_id", "n_words"])

    return index.select("shard", "doc_ids", "lengths").mapInArrow(run, "shard string, ord int, doc_id long, n_words long")


def item_chunks(items: DataFrame, width: int = WINDOW, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """item_id, chunk, n and words (hashes end to end): pieces of the items that overlap so that each window is in one."""

    def run(batches):
        cache = Hashes()
        for b in batches:
            rows = [[], [], [], []]
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = cache.of(fold_words(text))
                for i, s in enumerate(range(0, max(len(w) - width + 1, min(1, len(w))), chunk_words)):
                    part = w[s : s + chunk_words + width - 1]
                    for held, x in zip(rows, (item, i, len(part), part.tobytes()), strict=True):
                        held.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["item_id", "chunk", "n", "words"])

    slim = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    return slim.mapInArrow(run, "item_id string, chunk int, n long, words binary")


def blocks(items: DataFrame, block_words: int = BLOCK_WORDS):
    """The chunks of the items, (item_id, word hashes), in lists of at most four times ``block_words`` words (or one chunk). One block is on the driver at a time."""
    chunks = materialize(item_chunks(items), "items")
    size = chunks.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    n, most = -(-(size.n or 0) // block_words), 0
    while n:
        block = F.pmod(F.xxhash64("item_id", "chunk"), F.lit(n))
        most = chunks.groupBy(block.alias("block")).agg(F.sum("n").alias("n")).agg(F.max("n").alias("n")).first().n
        if most <= max(4 * block_words, size.most) or n > 4 * size.n:  # equal chunks of one name share a block
            break
        n *= 2
    for i in range(n):
        rows = chunks.where(block == i).select("item_id", "words").toArrow()
        if rows.num_rows:
            yield [(item, np.frombuffer(w, np.uint64)) for item, w in zip(rows.column("item_id").to_pylist(), rows.column("words").to_pylist(), strict=True)]
    drop(chunks)


def contamination(docs: DataFrame, items: DataFrame, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, spans and item_ids of every document."""
    index = materialize(build_index(docs), "index")
    hits = None
    for block in blocks(items):
        found = search(index, block, WINDOW, slop)
        hits = found if hits is None else hits.unionByName(found)
    every = _documents(index)
    if hits is None:
        return every.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.expr("cast(array() as array<struct<b:int,e:int>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("item_ids"))
    hits = hits.groupBy("shard", "ord").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    out = every.join(hits, ["shard", "ord"], "left")
    n_hit = F.expr("aggregate(spans, named_struct('upto', 0, 'n', 0L), (s, x) -> named_struct('upto', greatest(s.upto, x.e), 'n', s.n + greatest(0, x.e - greatest(s.upto, x.b))), s -> s.n)")
    return out.select("doc_id", "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"), F.coalesce("spans", F.expr("cast(array() as array<struct<b:int,e:int>>)")).alias("spans"), F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"))


def is_contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with all their columns. A doc_id goes if one of its rows is contaminated;
    documents without an id can't be named by a verdict and go."""
    bad = contamination(docs, items).where(is_contaminated()).select("doc_id").distinct()
    return docs.where("doc_id is not null").join(bad, "doc_id", "left_anti")
