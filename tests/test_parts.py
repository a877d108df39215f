"""Small cases of operators that no registered query covers."""

import json

import pytest
from pyspark.sql import functions as F

from tarnspark.functions import reviews as R
from tarnspark.functions import rules
from tarnspark.functions import text as X
from tarnspark.functions import urls as U
from tarnspark.operators import merge, progress, resolve, work_units
from tarnspark.plans import extractors
from tarnspark.sources import readers, writers
from tarnspark.streaming import claims


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(spark, f, inputs, schema="s string"):
    df = spark.createDataFrame([(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)], f"i int, {schema}")
    return [r.v for r in df.select("i", f(*[F.col(c) for c in df.columns[1:]]).alias("v")).orderBy("i").collect()]


def test_urls(spark):
    assert values(spark, U.without_query, ["http://a/b?c?d", "x", None]) == ["http://a/b", "x", None]
    assert values(spark, U.without_fragment, ["http://a/b#c", "x"]) == ["http://a/b", "x"]
    assert values(spark, lambda b: U.contact_url(b, F.lit("/contact")), ["https://A.com:80/x?y"]) == ["https://A.com:80/contact"]
    assert values(spark, U.listing_profile, ["/us/al/town/profile/plumber/acme?x=1", "/US/GA/a-b/profile/c/d", "/de/x", None]) == ["https://www.bbb.org/us/al/town/profile/plumber/acme", "https://www.bbb.org/US/GA/a-b/profile/c/d", None, None]
    assert values(spark, lambda n: U.listing_search_url(n, F.lit("St. X"), F.lit("AL")), ["A & B"]) == ["https://www.bbb.org/search?find_text=A+%26+B&find_loc=St.+X%2C+AL"]
    got = values(spark, lambda a: U.match_parameters(F.lit("n" * 70), a, F.lit("c" * 50), F.lit("ALAB")), ["1 Main St, Town", None])
    assert got[0].asDict() == {"name": "n" * 64, "address1": "1 Main St", "city": "c" * 40, "state": "ALA"} and got[1].address1 == ""


def test_waits_and_caps(spark):
    assert values(spark, lambda a: X.backoff(a), [1, 2, 4, 9], "a int") == [3.0, 6.0, 24.0, 30.0]
    assert values(spark, lambda a: X.cooldown(a), [0, 1, 2, 5], "a int") == [0.0, 120.0, 240.0, 300.0]
    many = [("a", 1.0, "d", str(i)) for i in range(101)]
    assert [len(x) for x in values(spark, R.first_reviews, [(many,), (many[:100],), ([],)], f"r {R.REVIEWS}")] == [100, 100, 0]
    cards = [("", 1.0, "d", None), ("A", None, None, ""), (None, None, None, "t")]
    assert [r.author for r in values(spark, R.card_reviews, [(cards,)], f"r {R.REVIEWS}")[0]] == ["A", None]


def test_best_name(spark):
    df = spark.createDataFrame([(" ", None, "Yelp Co"), ("Maps Co", "BBB Co", ""), ("", "BBB Co", "Yelp Co")], "google_maps string, bbb string, yelp string")
    assert [r.v for r in df.select(progress.best_name({c: F.col(c) for c in df.columns}).alias("v")).collect()] == ["Yelp Co", "Maps Co", "BBB Co"]


def test_needs_filling(spark):
    full = {f: "x" for f in rules.FILL_FIELDS}
    df = spark.createDataFrame([{"website_url": "u", **full}, {"website_url": "u", **full, "address": "  "}, {"website_url": " ", **full, "address": ""}])
    assert [r.v for r in df.select(merge.needs_filling().alias("v")).collect()] == [False, True, False]


def test_states_and_slices(spark):
    t = spark.createDataFrame([(0, "AL"), (1, "GA"), (2, None), (3, "AL"), (4, None)], "row_idx int, state string")
    assert [tuple(r) for r in progress.state_counts(t, "state").collect()] == [(None, 2), ("AL", 2), ("GA", 1)]
    assert rows(progress.row_range(t, 3, 10).select("row_idx")) == [(3,), (4,)] and progress.row_range(t, 9, 2).count() == 0
    targets = spark.createDataFrame([(1, ["yelp"]), (77, ["bbb"])], "row_idx int, sites array<string>")
    assert rows(progress.retry_rows(t, targets)) == [(1, "GA", ["yelp"])]


def test_status_reset_and_completion(spark):
    latest = spark.createDataFrame([(1, "a", "error", 3), (1, "b", "done", 1)], "row_idx int, site_id string, status string, attempts long")
    assert rows(progress.reset(latest, latest.where("status = 'error'"))) == [(1, "a", "pending", 3), (1, "b", "done", 1)]
    state = spark.createDataFrame([(1, None), (2, True), (3, False)], "row_idx int, row_complete boolean")
    assert rows(progress.mark_complete(state, latest)) == [(1, True), (2, True), (3, False)]


def test_shuffle_repeats(spark):
    units = spark.range(100).select(F.col("id").cast("string").alias("keyword"), F.lit("x").alias("location"))
    order = lambda seed: [r.keyword for r in work_units.shuffled(units, seed).collect()]
    assert order(1) == order(1) != order(2) and sorted(order(1)) == sorted(str(i) for i in range(100)) != order(1)


def test_left_lookup_of_reviews(spark):
    m = spark.createDataFrame([("k1", 1), ("k2", 2)], "match_key string, b int")
    b = spark.createDataFrame([(1, "A"), (2, "B")], "b int, name string")
    nested = spark.createDataFrame([(1, [("a", 1.0, "d", "t")])], f"b int, reviews {R.REVIEWS}")
    got = {r.match_key: len(r.reviews) for r in resolve.match_table(m, b, nested, "match_key", "b", R.REVIEWS).collect()}
    assert got == {"k1": 1, "k2": 0}


def test_first_valid_page(spark):
    df = spark.createDataFrame([("s", 1, "404"), ("s", 2, "ok"), ("s", 3, "ok"), ("t", 1, "404")], "site string, rank int, html string")
    assert rows(readers.first_valid(df, "site", "rank", F.col("html") == "ok")) == [("s", 2, "ok")]


def test_row_numbers_follow_the_file(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("v"), F.concat(F.lit('a "q"\nb '), F.col("id")).alias("w")).coalesce(1).write.option("header", True).option("escape", '"').csv(f"{tmp_path}/x")
    got = readers.with_row_idx(readers.csv(spark, f"{tmp_path}/x"))
    assert got.columns == ["row_idx", "v", "w"] and all(r.row_idx == int(r.v) for r in got.collect())
    parts = readers.with_row_idx(spark.range(100).repartition(7).select("id"))
    assert sorted(r.row_idx for r in parts.collect()) == list(range(100)) and "Python" not in parts._jdf.queryExecution().executedPlan().toString()
    assert readers.with_row_idx(spark.range(0)).count() == 0


def test_seed_in_latin_1(spark, tmp_path):
    (tmp_path / "seed.csv").write_bytes("keywords,locations\nküche,Zürich\n".encode("latin-1"))
    assert rows(readers.seed(spark, str(tmp_path / "seed.csv"))) == [(0, "küche", "Zürich")]


def test_append_review_rows(spark, tmp_path):
    schema = "row_idx int, n string, " + ", ".join(f"{s}_rating double" + (f", {s}_reviews {R.REVIEWS}" if has else "") for s, has, *_ in rules.SITES)
    row = [7, "x"]
    for s, has, *_ in rules.SITES:
        row += [4.5 if s == "bbb" else None] + ([[("A", None, "d", "t")] if s == "yelp" else None] if has else [])
    df = spark.createDataFrame([tuple(row)], schema)
    writers.append_reviews(df, f"{tmp_path}/o", ["n"])
    writers.append_reviews(df, f"{tmp_path}/o", ["n"])
    got = readers.csv(spark, f"{tmp_path}/o").collect()
    assert len(got) == 2 and got[0].bbb_rating == "4.5" and got[0].yelp_rating == "" and got[0].angi_reviews == "" and json.loads(got[0].yelp_reviews)[0]["author"] == "A"


def test_update_rows_tells_what_it_replaced(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(merge.update_rows(old, new, "k", ["v"])) == [(1, "a", 1, False), (2, None, 2, True)]


def test_answers(spark):
    got = values(spark, lambda c: R.answer_fields(c, ["a", "b"]), ['```json\n{"a": "x", "c": 1}\n```', '{"b": 2}', "no", "[1]", None])
    assert [(g.a, g.b, g.parsed) for g in got] == [("x", "", True), ("", "2", True), ("", "", False), ("", "", False), ("", "", False)]


def test_structured_data_edges(spark):
    page = '<script type="application/ld+json">{}</script>'
    cases = [
        ('{"@type":"Organization","review":"none","aggregateRating":[1]}', (None, 0)),
        ('[{"@type":"Organization","aggregateRating":{"ratingValue":1}},{"@type":"LocalBusiness","aggregateRating":{"ratingValue":3.14159}}]', (3.14, 0)),
        ('{"@type":"X"}\n{"@type":"LocalBusiness","review":[{"author":null,"reviewBody":"","description":"d"}]}', (None, 1)),
        ('{"@type":"LocalBusiness","aggregateRating":{"ratingValue":"many"},"review":[' + ",".join(['{"author":"a"}'] * 120) + "]}", (None, 100)),
        ('{"@graph":{"@type":"LocalBusiness"}}', (None, 0)),
        ('{"@type":"LocalBusiness"}\n{bad}', (None, 0)),
        ("7", (None, 0)),
    ]
    got = values(spark, R.page_reviews, [page.format(c) for c, _ in cases])
    assert [(g.rating, len(g.reviews)) for g in got] == [w for _, w in cases]
    assert got[2].reviews[0].asDict() == {"author": "", "rating": None, "date": "", "text": "d"}


def test_logo_order(spark):
    page = "<title>T</title><img class='logo' src='/own.png'>" + "".join(f"<p>A long paragraph of text number {i}</p>" for i in range(9))
    sites = spark.createDataFrame([("http://u1/a", page, "", "")], "url string, homepage_html string, contact_html string, logo_url string")

    def model(batches):
        import pyarrow as pa

        for b in batches:
            cells = [pa.array(["x"] * b.num_rows)] * len(extractors.FIELDS)
            yield pa.RecordBatch.from_arrays([b.column("content_key"), *cells, pa.array(["model.png"] * b.num_rows)], ["content_key", *extractors.FIELDS, "logo_url"])

    assert [r.logo_url for r in extractors.extract(sites).collect()] == ["http://u1/own.png"]
    assert [r.logo_url for r in extractors.extract(sites, model).collect()] == ["model.png"]
    key = spark.createDataFrame([(None,)], "k string").select(F.lit("").alias("k"))
    from tarnspark.functions import pages

    body = sites.select(pages.combine_texts(pages.html_to_text(F.col("homepage_html")), F.lit(None)).alias("b"))
    cache = body.select(X.content_hash(F.col("b")).alias("content_key"), *[F.lit("c").alias(f) for f in extractors.FIELDS], F.lit("model.png").alias("logo_url"))
    assert [(r.logo_url, r.business_name) for r in extractors.extract(sites, model, cache).collect()] == [("http://u1/own.png", "c")] and key.count() == 1


def test_stream_resets_and_replays(spark, tmp_path):
    drop, out, check = f"{tmp_path}/drop", f"{tmp_path}/out", f"{tmp_path}/check"
    schema = "key string, status string, ts timestamp, seq long"
    log = lambda *r: spark.createDataFrame([(k, s, None, i) for k, s, i in r], schema).withColumn("ts", F.timestamp_seconds(F.col("seq")))
    log(("a", "error", 1), ("a", "error", 2), ("b", "done", 1)).write.parquet(f"{drop}/1")
    stream = lambda: claims.track(claims.read_drops(spark, f"{drop}/*", log(("x", "y", 1)).schema))
    claims.run_available(stream(), out, check, "update", claims.epoch_writer(out))
    claims.reset_rows(spark.createDataFrame([("a",)], "key string"), F.timestamp_seconds(F.lit(9)), F.lit(9).cast("long")).write.parquet(f"{drop}/2")
    claims.run_available(stream(), out, check, "update", claims.epoch_writer(out))
    got = spark.read.schema(claims.STATUS).parquet(out).select("key", "status", "attempts", "seq")
    assert rows(got) == [("a", "error", 2, 2), ("a", "pending", 2, 9), ("b", "done", 1, 1)]
    claims.epoch_writer(out)(got.limit(0), 1)
    assert spark.read.schema(claims.STATUS).parquet(out).count() == 2  # the second epoch was replaced


def test_standing_query(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "k string, n int").write.parquet(f"{tmp_path}/drop/1")
    stream = claims.read_drops(spark, f"{tmp_path}/drop/*", spark.createDataFrame([], "k string, n int").schema)
    query = claims.run_every(claims.claim(stream, ["k"]), f"{tmp_path}/out", f"{tmp_path}/check", "1 seconds")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_relational_options(spark):
    try:
        readers.relational(spark, "jdbc:none://x", "t", "row_idx", 0, 9, 2)
    except Exception as e:
        assert "driver" in str(e).lower()
    else:
        pytest.fail("no driver can be there")


def test_snapshots_of_rows(spark):
    latest = spark.createDataFrame([(1, "a", "done", 2), (1, "b", None, 1), (2, "a", "error", 3)], "row_idx int, site_id string, status string, attempts long")
    kept = progress.snapshot(latest, latest.where("status = 'done'"))
    assert [(r.row_idx, dict(r.sites), r.row_complete) for r in kept.orderBy("row_idx").collect()] == [(1, {"a": ("done", 2), "b": (None, 1)}, True), (2, {"a": ("error", 3)}, False)]
    assert rows(progress.from_snapshot(kept)) == rows(latest) and progress.snapshot(latest.limit(0), latest).count() == 0


def test_a_real_database(spark):
    """Rows written to and read from an embedded database, in ranges of the key, with the filter pushed down."""
    url, driver = "jdbc:derby:memory:tarn;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.range(100).select(F.col("id").cast("int").alias("row_idx"), F.concat(F.lit("n"), "id").alias("name"))
    df.repartition(2).write.format("jdbc").options(url=url, dbtable="leads", driver=driver).save()
    got = readers.relational(spark, url, "leads", "row_idx", 0, 100, 4, driver=driver)
    assert got.rdd.getNumPartitions() == 4 and rows(got) == rows(df)
    some = got.where("row_idx < 5").select("name")
    assert rows(some) == [(f"n{i}",) for i in range(5)] and "PushedFilters: [*IsNotNull(row_idx), *LessThan(row_idx,5)]" in some._jdf.queryExecution().executedPlan().toString().replace("ROW_IDX", "row_idx")
