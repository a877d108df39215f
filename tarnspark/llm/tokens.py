"""Token-ID output: independent zstandard frames with a trailing seek table and per-frame checksums.

A shard file is a run of independent zstandard frames (each the little-endian uint32 ids of whole
documents, at least ``FRAME_IDS`` ids unless it is the last), then a directory of the documents in a skippable
frame, then the public seekable-format seek table (compressed size, size and low 32 bits of XXH64 of each frame) in a
skippable frame at the end of the file. Any zstandard reader decodes the whole file; ``Shard`` fetches only the
frames that hold the documents asked for, and checks their checksums.

Documents are range-partitioned by doc_id and sorted inside a task, which streams its shard to a file of its own
in the shared folder and renames it when it is whole: a task that runs again, or twice, makes the same file, and the first that is whole stays. What tasks
that were lost left behind is deleted at the end.
The files are then read back by tasks of their own.

Encoding is cached, for all tasks of a worker, by the parts between blanks: the byte-level pre-tokenizer never joins characters across a
blank that is followed by a visible character, and merges stay inside pre-tokens, so the ids of a part never depend on its neighbours. Each new part is encoded by the tokenizer. Texts with
other blanks are split into pre-tokens first; those with a special token's string, or with characters that this
splitter might treat otherwise than the tokenizer, are encoded whole, and so is every text if the vocabulary isn't a plain byte-level one.

Defined cases: null and empty texts are the end id alone; a null doc_id sorts first and is kept null; repeated rows
are each written, next to each other; a very long text is one document of a frame; an empty table writes no shard and gives no row; other
columns, of whatever name, stay out.
"""

from __future__ import annotations

import functools
import io
import json
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnspark.llm.common import new_path

END_ID, FRAME_IDS, LEVEL = 2, 65_536, 1
#: Fixed values of the zstandard format and its seekable extension.
SKIPPABLE, SEEK_MAGIC, DIRECTORY_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x184D2A51, 0x8F92EAB1
_ENTRY = np.dtype([("doc_id", "<i8"), ("known", "<u1"), ("frame", "<u4"), ("at", "<u4"), ("n", "<u4")])
#: The byte-level pre-tokeniser's split in terms of the standard library's classes ...
_SPLIT = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: ... which differ for numbers that aren't decimal digits and for separators: texts with other characters than these take the tokenizer itself.
_PLAIN = re.compile("[\\t\\n\\r -~\\xa0-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\\u02ff\\u2010-\\u2027\\u2030-\\u205e]*")
_WORD_MARK = "<|"
#: Letters, then signs.
_TAILED = re.compile(r"([^\W\d_]+)((?:[^\s\w]|_)+)")
#: A blank before another white-space character.
_DOUBLE = ("  ", " \n", " \t", " \r", " \xa0")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes texts part by part. ``known``: part -> its ids as little-endian uint32 bytes; a part that stands behind a blank is kept without it.
    When it is full it becomes ``old``, from which parts that are met again come back."""

    def __init__(self, path: str, limit: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.known, self.old = Tokenizer.from_file(path), limit, {}, {}
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        split = made.get("pre_tokenizer") or {}
        #: Whether an id begins with a blank; the byte-level alphabet writes one as the letter U+0120.
        ids = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(ids.values(), default=0) + 1, bool)
        self.blank[[i for t, i in ids.items() if t.startswith("\u0120")]] = True
        self.by_parts = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and made.get("normalizer") is None

    def whole(self, texts: list[str]) -> list[bytes]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in found]

    def _words(self, words: list[str], at_once: int = 5_000) -> list[bytes]:
        """The ids of words of letters, each behind a blank, as one text: a word is one pre-token, so its ids go from one id that begins with a blank to the next."""
        out: list[bytes] = []
        for i in range(0, len(words), at_once):
            part = words[i : i + at_once]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self.blank[ids])
            if len(starts) == len(part) and starts[0] == 0:
                raw, ends = ids.tobytes(), (4 * np.r_[starts, len(ids)]).tolist()
                out += [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            else:
                out += self.whole([" " + p for p in part])
        return out

    def _learn(self, new: set[str]) -> None:
        """Encodes new parts. A word with signs behind it is two pre-tokens, so it takes the ids of both."""
        words = [p for p in new if p.isalpha()]
        others = new.difference(words)
        joined = {p: m for p in others if (m := _TAILED.fullmatch(p))}
        rest = [p for p in others if p not in joined]
        words += {m[1] for m in joined.values()}.difference(self.known, new)
        rest += {"\0" + m[2] for m in joined.values()}.difference(self.known, new)
        if self.old:
            kept = {p: x for ps in (words, rest) for p in ps if (x := self.old.get(p)) is not None}
            self.known.update(kept)
            words, rest = ([p for p in ps if p not in kept] for ps in (words, rest))
        self.known.update(zip(words, self._words(words), strict=True))
        self.known.update(zip(rest, self.whole([p[1:] if p[0] == "\0" else " " + p for p in rest]), strict=True))
        for p, m in joined.items():
            self.known[p] = self.known[m[1]] + self.known["\0" + m[2]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. New parts of all the texts are encoded in one call."""
        parts: list[list[str]] = []
        odd: list[str] = []
        for x in texts:
            if not self.by_parts or _WORD_MARK in x or _PLAIN.fullmatch(x) is None:
                parts.append([])
                odd.append(x)
            elif x.endswith(" ") or any(pair in x for pair in _DOUBLE):
                # pre-tokens that begin with a blank are kept as others are, the rest under a mark of their own
                parts.append([p[1:] if p[0] == " " and len(p) > 1 else "\0" + p for p in _SPLIT.findall(x)])
            else:
                first, *rest = x.split(" ")
                parts.append([*(["\0" + first] if first else []), *rest])
        if len(self.known) > self.limit:
            self.old, self.known = self.known, {}
        self._learn(set().union(*parts).difference(self.known))
        plain = iter(self.whole(odd)) if odd else iter(())
        marks = iter(odd)
        held = next(marks, None)
        out = []
        for x, p in zip(texts, parts, strict=True):
            if not p and held is x:
                out.append(next(plain))
                held = next(marks, None)
            else:
                out.append(b"".join(map(self.known.__getitem__, p)))
        return out


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each worker process: its parts serve the tasks that follow."""
    return Encoder(path)


def _groups(texts: list[str], most: int = 500_000):
    """(first, end) of runs of texts with about ``most`` characters together."""
    first = held = 0
    for i, x in enumerate(texts):
        held += len(x)
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class Writer:
    """Writes one shard to a binary file."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.out, self.frame_ids = out, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held, self.n, self.frames, self.entries = [], 0, [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.entries.append((doc_id or 0, doc_id is not None, len(self.frames), self.n, len(ids) // 4))
        self.held.append(ids)
        self.n += len(ids) // 4
        if self.n >= self.frame_ids:
            self._flush()

    def _flush(self) -> None:
        raw = b"".join(self.held)
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.n = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        self.out.write(_skippable(DIRECTORY_MAGIC, np.array(self.entries, _ENTRY).tobytes()))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.out.write(_skippable(SEEK_MAGIC, table + struct.pack("<IBI", len(self.frames), 0x80, FOOTER_MAGIC)))


class Shard:
    """Random access to a shard file by document."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, io.SEEK_END)
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != FOOTER_MAGIC or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        size = 8 + 12 * n + 9
        file.seek(end - size)
        body = file.read(size)
        self.frames = np.frombuffer(body, np.dtype([("packed", "<u4"), ("raw", "<u4"), ("sum", "<u4")]), n, 8)
        self.starts = np.concatenate([[0], np.cumsum(self.frames["packed"].astype(np.int64))])
        file.seek(int(self.starts[-1]))
        magic, length = struct.unpack("<II", file.read(8))
        if magic != DIRECTORY_MAGIC:
            raise ValueError("no directory")
        self.entries = np.frombuffer(file.read(length), _ENTRY)
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        self.file.seek(int(self.starts[k]))
        raw = self.zstd.decompress(self.file.read(int(self.frames["packed"][k])), max_output_size=int(self.frames["raw"][k]))
        if len(raw) != self.frames["raw"][k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames["sum"][k]:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def documents(self, entries=None):
        """(doc_id, ids as bytes) of the given directory entries, all by default."""
        held, raw = -1, b""
        for doc_id, known, k, at, n in (self.entries if entries is None else entries).tolist():
            if k != held:
                held, raw = k, self.frame(k)
            yield (doc_id if known else None), raw[4 * at : 4 * (at + n)]

    def read(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every row with this doc_id; only their frames are fetched."""
        mine = self.entries[(self.entries["doc_id"] == doc_id) & (self.entries["known"] == 1)]
        return [np.frombuffer(x, "<u4") for _, x in self.documents(mine)]


def _filesystem(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def _is_file(fs, path: str) -> bool:
    return fs.get_file_info(path).type == pafs.FileType.File


def _settle(fs, own: str, final: str) -> None:
    """Give a whole file its name, unless another run of the task has done so: not every store replaces a file by a rename."""
    if not _is_file(fs, final):
        try:
            fs.move(own, final)
            return
        except OSError:
            if not _is_file(fs, final):
                raise
    fs.delete_file(own)


def _sweep(uri: str) -> None:
    """Delete what lost tasks have left."""
    fs, folder = _filesystem(uri)
    for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        if f.path.endswith(".tmp"):
            fs.delete_file(f.path)


def write_shards(docs: DataFrame, uri: str, vocabulary: str, shards: int | None = None) -> DataFrame:
    """Write ``docs`` below ``uri`` and return shard, n_docs, n_ids and path of each file, in ascending doc_id order."""

    def run(batches):
        from pyspark import TaskContext

        shard, ids_of, writer, total = TaskContext.get().partitionId(), encoder(vocabulary).encode, None, 0
        fs, folder = _filesystem(uri)
        final = f"{folder}/shard-{shard:06d}.zst"
        own = f"{final}.{uuid.uuid4().hex}.tmp"
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            doc_ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for first, last in _groups(texts):
                if writer is None:
                    fs.create_dir(folder, recursive=True)
                    out = fs.open_output_stream(own)
                    writer = Writer(out)
                for doc_id, ids in zip(doc_ids[first:last], ids_of(texts[first:last]), strict=True):
                    ids += end
                    total += len(ids) // 4
                    writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            out.close()
            _settle(fs, own, final)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(writer.entries)], pa.int64()), pa.array([total], pa.int64()), pa.array([final])], ["shard", "n_docs", "n_ids", "path"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = shards or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism)
    ordered = slim.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return ordered.mapInArrow(run, "shard int, n_docs long, n_ids long, path string")


def read_shards(files: DataFrame, uri: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone. ``files``: shard, n_ids, path."""

    def run(batches):
        fs, _ = _filesystem(uri)
        for b in batches:
            for start, path in zip(b.column("start").to_pylist(), b.column("path").to_pylist(), strict=True):
                rows = []
                with fs.open_input_file(path) as file:
                    for doc_id, raw in Shard(file).documents():
                        rows.append((doc_id, start, len(raw) // 4, zlib.crc32(raw)))
                        start += len(raw) // 4
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a row a file, so this one window is over as many rows as there were tasks
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long")).select("start", "path")
    return placed.repartition(max(1, files.count()), "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize(docs: DataFrame, vocabulary: str | None = None, uri: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` and read them back."""
    spark: SparkSession = docs.sparkSession
    uri = uri or new_path(spark, "tokens")
    files = write_shards(docs, uri, vocabulary or tokenizer_path())
    listing = spark.createDataFrame(files.collect(), "shard int, n_docs long, n_ids long, path string")  # one row a file
    _sweep(uri)
    return read_shards(listing, uri)
