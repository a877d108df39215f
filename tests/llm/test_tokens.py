import io
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnspark.llm import tokens as K

PARTS = [" ", "  ", "\n", " \n", "\t", "a", "é", "The", "'s", "'", "'t", "12", ".", "##", "_", "²", "\xa0", "<|endoftext|>", "日", "\x1c", "x" * 30, "\r\n", "", "\0", "😀"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(K.tokenizer_path())


def texts(n=3000):
    r = random.Random(2)
    return ["".join(r.choice(PARTS) for _ in range(r.randrange(12))) for _ in range(n)]


def test_encoder_matches_tokenizer(tok):
    t = texts()
    e = K.Encoder(K.tokenizer_path(), limit=50)
    got = [x for a, b in K._groups(t, 200) for x in e.encode(t[a:b])]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tok.encode(x, add_special_tokens=False).ids for x in t]


def test_query_against_brute_force(spark, tok):
    rows = [(i * 37 % 1009, t) for i, t in enumerate(texts(300))] + [(None, "null id"), (5000, None), (5001, ""), (7, "again"), (7, "again"), (6000, "long text " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"start": F.lit("?"), "shard": F.lit(1), "path": F.lit("?")})
    got = [tuple(r) for r in K.tokenize(docs).collect()]
    want, start = [], 0
    ids = lambda t: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    assert sorted(s for _, s, _, _ in got)[0] == 0
    by_id = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in by_id:
        x = ids(t)
        want.append((d, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    order = lambda rs: sorted(rs, key=lambda r: r[1])
    # rows of one doc_id may stand in either order, so their starts are checked by the running sum
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in want)
    ends = order(got)
    assert all(a[1] + a[2] == b[1] for a, b in zip(ends, ends[1:], strict=False)) and [r[0] for r in ends] == [d for d, _ in by_id]
    assert K.tokenize(docs.limit(0)).count() == 0


def test_file_format_random_access():
    buf = io.BytesIO()
    w = K.Writer(buf, frame_ids=100)
    docs = [(i, np.arange(i, i + i % 60, dtype="<u4")) for i in range(200)]
    for d, x in docs:
        w.add(d, x.tobytes())
    w.add(None, b"\1\0\0\0")
    w.close()
    s = K.Shard(io.BytesIO(buf.getvalue()))
    assert len(s.frames) > 10 and [d for d, _ in s.documents()] == [*range(200), None]
    asked = []
    frame = s.frame
    s.frame = lambda k: (asked.append(k), frame(k))[1]
    assert s.read(150)[0].tolist() == docs[150][1].tolist() and len(asked) == 1 and s.read(999) == []
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(buf.getvalue()), read_across_frames=True).read()
    assert whole == b"".join(x.tobytes() for _, x in docs) + b"\1\0\0\0"
    bad = bytearray(buf.getvalue())
    bad[20] ^= 255
    with pytest.raises(Exception):
        list(K.Shard(io.BytesIO(bytes(bad))).documents())


def test_a_task_that_runs_again_keeps_the_whole_file(tmp_path):
    import pyarrow.fs as pafs

    fs, final = pafs.LocalFileSystem(), f"{tmp_path}/shard.zst"
    for own in ("a", "b"):
        (tmp_path / own).write_bytes(own.encode())
        K._settle(fs, f"{tmp_path}/{own}", final)
    (tmp_path / "c.tmp").write_bytes(b"lost")
    K._sweep(f"file://{tmp_path}")
    assert sorted(x.name for x in tmp_path.iterdir()) == ["shard.zst"] and (tmp_path / "shard.zst").read_bytes() == b"a"


def test_other_vocabularies_are_encoded_whole(tmp_path):
    import json

    made = json.load(open(K.tokenizer_path(), encoding="utf-8"))
    made["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "lower.json").write_text(json.dumps(made))
    e = K.Encoder(str(tmp_path / "lower.json"))
    texts = ["The Cat's  HAT", "x"]
    assert not e.by_parts and K.Encoder(K.tokenizer_path()).by_parts
    assert e.encode(texts) == e.whole(texts)
