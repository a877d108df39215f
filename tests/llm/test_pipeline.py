import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from test_decontaminate import brute as contamination_brute
from test_near_dup import brute as near_dup_brute
from tokenizers import Tokenizer

import corpus_pipeline as C
from tarnspark.llm import mixing, quality, tokens

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in C.STAGES:
        out = stage(spark, kept[-1], SF)
        out.write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
        if name != "tokens":
            assert out.columns == docs.columns
    sizes = [d.count() for d in kept]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[4] == sizes[5]
    assert kept[3].join(docs, ["doc_id", "text"], "left_anti").count() == 0
    t = Tokenizer.from_file(tokens.tokenizer_path())
    want, start = [], 0
    for r in kept[4].orderBy("doc_id").select("doc_id", "text").collect():
        x = np.array([*t.encode(r.text, add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    assert sorted(map(tuple, kept[5].select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(want)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_each_stage_against_brute_force(spark):
    """Nulls in every column, repeated rows, empty texts and columns with clashing names, a stage at a time."""
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").limit(120).collect()]
    long = next(t for _, t, *_ in base if len(t.split()) > 120)
    rows = [*base, base[3], (900, long, None, None), (901, long + " tail", "en", None), (902, None, "en", "x"), (903, "", None, "x"), (None, long, "en", "x"), (904, long, "en", "x"), (904, long, "en", "x")]
    extra = ["id", "key", "n", "size", "kept", "comp", "shard", "copies", "_n", "_copies"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({c: F.lit(c) for c in extra})
    plain = lambda df: [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]

    good = C.quality_stage(spark, docs, SF)
    named = [r for r in rows if r[0] is not None]
    verdict = {r.doc_id: r.kept for r in quality.judge(docs).collect() if r.doc_id is not None}
    assert sorted(plain(good), key=repr) == sorted((r for r in named if verdict[r[0]]), key=repr) and good.columns == docs.columns

    one = C.near_dup_stage(spark, docs, SF)
    classes = near_dup_brute([(d, t) for d, t, *_ in dict.fromkeys(named)])
    assert sorted(r[0] for r in plain(one)) == sorted({c for c in classes.values()}) and one.columns == docs.columns

    clean = C.decontaminate_stage(spark, docs, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in contamination_brute([(d, t) for d, t, *_ in rows], items) if r[5]}
    assert sorted(plain(clean), key=repr) == sorted((r for r in named if repr(r[0]) not in bad), key=repr) and clean.columns == docs.columns

    mixed = C.mixing_stage(spark, docs, SF)
    copies = {(r.doc_id, r.source, r["size"]): r.copies for r in mixing.plan(docs.where("doc_id is not null")).collect()}
    want = [r for r in named for _ in range(copies[(r[0], r[3], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")))])]
    assert sorted(plain(mixed), key=repr) == sorted(want, key=repr) and mixed.columns == docs.columns
    assert C.tokens_stage(spark, docs, SF).count() == len(rows)
