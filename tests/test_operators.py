import gzip
import random

import pytest
from pyspark.sql import functions as F

from tarnspark.functions import reviews as R
from tarnspark.functions import rules
from tarnspark.operators import keyed, merge, progress, resolve, work_units
from tarnspark.plans import extractors
from tarnspark.sources import readers, writers
from tarnspark.streaming import claims


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_top_n_cap_and_ties(spark):
    df = spark.createDataFrame([(1, f"2024-01-{i % 9 + 1:02d}" if i % 5 else None, i) for i in range(101)] + [(2, None, 0)], "k int, d string, n int")
    best = keyed.first_by(df, ["k"], [F.desc_nulls_last("d"), F.asc("n")], 100, rank="r")
    got = [r.n for r in best.where("k = 1").orderBy("r").collect()]
    want = sorted(range(101), key=lambda i: (i % 5 == 0, -(i % 9) if i % 5 else 0, i))[:100]
    assert got == want and best.where("k = 2").count() == 1
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_work_units(spark):
    seed = spark.createDataFrame([(" a ", "x"), ("", "y"), ("a", "x"), ("b||c", " ")], "keywords string, locations string")
    k, place = work_units.seed_lists(readers.with_row_idx(seed), "row_idx")
    assert rows(k) == [("a", 0), ("b||c", 3)] and rows(place) == [("x", 0), ("y", 1)]
    units = work_units.work_units(k.select("keyword"), place.select("location"), 2)
    assert units.count() == 8 and work_units.work_units(k.select("keyword"), place.select("location"), 2, units).count() == 0
    log = spark.createDataFrame([("a", "x", 0, "failed", 1), ("a", "x", 0, "completed", 2), ("a", "y", 0, "failed", 3)], "keyword string, location string, page int, status string, seq int")
    assert rows(work_units.failed_units(log)) == [("a", "y", 0)]
    tries = spark.createDataFrame([("p", True, 0)] * 3 + [("q", True, 0), ("q", False, 2)], "page string, blocked boolean, urls int")
    assert [(r.page, r.status) for r in work_units.page_status(tries).orderBy("page").collect()] == [("p", "blocked"), ("q", "ok")]


def brute_match(left, right, threshold=0.7, stop=frozenset(rules.STOP_TOKENS)):
    out = {}
    for i, s, c, n in left:
        if not n:
            continue
        same = [(j, m) for j, t, d, m in right if (t, d) == (s, c) and m and t and d]
        hit = [j for j, m in same if m == n]
        if hit:
            out[i] = (min(hit), 1.0)
            continue
        a, best = set(n.split()), None
        for j, m in sorted(same):
            b = set(m.split())
            score = len(a & b) / len(a | b) if (a & b) - stop else 0.0
            if score >= threshold and (best is None or score > best[1] + 1e-12):
                best = (j, score)
        if best:
            out[i] = best
    return out


def test_match_against_brute_force(spark):
    r = random.Random(5)
    words = ["acme", "bob", "cool", "hvac", "air", "heating", "north", "zed", "quick", "fix"]

    def table(n, seed):
        r.seed(seed)
        return [(i, r.choice(["AL", "GA", ""]), r.choice(["a", "b"]), " ".join(r.sample(words, r.randrange(0, 6)))) for i in range(n)]

    left, right = table(120, 1), table(160, 2)
    schema = "id long, state_key string, city_slug string, name_norm string"
    split = F.filter(F.split("name_norm", " "), lambda x: x != "")
    a = spark.createDataFrame(left, schema).withColumn("name_tokens", split)
    b = spark.createDataFrame(right, schema).withColumn("name_tokens", split).withColumn("ord", F.col("id")).withColumnRenamed("id", "other")
    got = {x.id: (x.other, pytest.approx(x.score)) for x in resolve.match(a, b, "id", "other", "ord").collect()}
    assert got == brute_match(left, right)


def test_score_cases(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "a"]), (["hvac", "a"], ["hvac", "b"]), ([], ["a"]), (list("abcdefg"), list("abcdefghij"))], "a array<string>, b array<string>")
    got = [(r.s, r.t, r.p) for r in df.select(resolve.score(F.col("a"), F.col("b")).alias("s"), resolve.score(F.col("b"), F.col("a")).alias("t"), resolve.plain_score(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [(1.0, 1.0, 1.0), (0.0, 0.0, pytest.approx(1 / 3)), (0.0, 0.0, 0.0), (0.7, 0.7, 0.7)]


def test_match_keys_and_fallbacks(spark):
    keyed_rows = resolve.with_keys(spark.createDataFrame([("205 Heating & Cooling LLC", "Birmingham", "al")], "n string, c string, s string"), "n", "c", "s")
    r = keyed_rows.collect()[0]
    assert (r.state_key, r.city_slug, r.name_norm) == ("AL", "birmingham", "205 heating cooling")
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    one, two = spark.createDataFrame([(1, None, "a"), (2, 4.0, "b")], "k int, v double, w string"), spark.createDataFrame([(1, 3.0, "c"), (2, 2.0, "d")], "k int, v double, w string")
    assert rows(resolve.fallback(base, [one, two], "k", "v", ["v", "w"])) == [(1, 1, 3.0, "c"), (2, 0, 4.0, "b"), (3, None, None, None)]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, n string, v double")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, n string")
    out = merge.upsert(old, new, "k", ["n", "v"])
    assert rows(out) == [(1, "a", 1.0), (2, "B", None), (3, "C", None)]
    assert rows(merge.upsert(out, new, "k", ["n", "v"])) == rows(out)
    part = spark.createDataFrame([(1, True, "x", False, 9.0), (2, False, "y", False, 9.0), (4, False, "z", True, 9.0)], "k int, f boolean, n string, g boolean, v double")
    groups = {"f": ["n"], "g": ["v"]}
    want = [(1, "x", 1.0), (2, "b", 2.0), (4, None, 9.0)]
    assert rows(merge.partial_upsert(old, part, "k", groups)) == want
    assert rows(merge.partial_upsert(old, part, "k", groups, insert=False)) == want[:2]
    holes = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "c", 3)], "k int, n string, o int")
    names = spark.createDataFrame([(1, "A"), (2, ""), (3, "C")], "k int, n string")
    assert rows(merge.fill_empty(holes.na.fill("", []), names, "k", "n").na.fill("?", ["n"])) == [(1, "A", 1), (2, "", 2), (3, "c", 3)]
    with pytest.raises(Exception, match="duplicate key"):
        merge.assert_unique(old.union(old), "k").collect()
    stamped = merge.upsert(old.withColumns({"created_at": F.lit("t0"), "updated_at": F.lit("t0")}), new, "k", ["n", "v"], F.lit("t1"))
    assert rows(stamped.select("k", "created_at", "updated_at")) == [(1, "t0", "t0"), (2, "t0", "t1"), (3, "t1", "t1")]


def test_conservative_merge_never_clobbers(spark):
    old = spark.createDataFrame([(1, "x", "  ", None), (2, "", "y", "z")], "k int, a string, b string, c string")
    new = spark.createDataFrame([(1, "X", " n ", ""), (2, None, "Y", "Z")], "k int, a string, b string, c string")
    out = merge.conservative_merge(old, new, "k", ["a", "b", "c"])
    assert rows(out) == [(1, "x", "n", "", ["b"]), (2, "", "y", "z", [])]
    assert rows(merge.conservative_merge(out.drop("filled"), new, "k", ["a", "b", "c"]).drop("filled")) == rows(out.drop("filled"))


def test_progress(spark):
    log = spark.createDataFrame([(1, "yelp", "blocked", 1, 1), (1, "yelp", "done", 2, 2), (2, "bbb", "error", 1, 3), (2, "yelp", "odd", 1, 4)], "row_idx int, site_id string, status string, ts int, seq int")
    grid = progress.status_grid(spark.createDataFrame([(1,), (2,), (3,)], "row_idx int"), progress.site_dimension(spark).select("site_ord", "site_id"), progress.latest_status(log))
    pivot = progress.status_pivot(grid).collect()
    assert all(sum(r[s] for s in progress.STATUSES) == 3 for r in pivot) and grid.where("site_id = 'yelp' and row_idx = 1").collect()[0].attempts == 2
    assert rows(progress.retry_targets(grid)) == [(2, ["bbb"])]
    complete = spark.createDataFrame([(2,)], "row_idx int")
    assert rows(progress.retry_targets(grid, True, complete)) == [(2, ["google_maps", "yelp", "bbb", "angi", "homeadvisor"])]
    assert progress.pending_work(grid, complete).count() == 4 + 5
    seen = []
    assert progress.retry_passes(lambda: grid if len(seen) < 2 else grid.where("false"), lambda t: seen.append(t.count())) == 2 and seen == [1, 1]
    tries = spark.createDataFrame([(1, "blocked", 1, 1), (1, "done", 2, 2), (1, "error", 3, 3), (2, "error", 1, 4), (2, "blocked", 2, 5), (3, "blocked", 1, 6), (3, "error", 2, 7)], "k int, status string, ts int, seq int")
    assert rows(progress.after_retries(tries, ["k"])) == [(1, "done"), (2, "blocked"), (3, "error")]


def test_classify(spark):
    cases = [(True, False, None, False, True, None, None, 0, "blocked"), (False, False, "", False, True, None, None, 0, "not_found"), (False, True, "u", False, True, None, 5.0, 1, "error"), (False, False, "u", True, True, None, 5.0, 1, "error"), (False, False, "u", False, False, None, None, 0, "blocked"), (False, False, "u", False, True, "blocked", 5.0, 1, "blocked"), (False, False, "u", False, True, None, None, 0, "not_found"), (False, False, "u", False, True, None, None, 2, "done"), (False, False, "u", False, True, "x", 1.0, None, "done")]
    df = spark.createDataFrame(cases, "h boolean, se boolean, u string, ce boolean, d boolean, g string, r double, n int, want string")
    got = df.select("want", progress.classify(*[F.col(c) for c in ("h", "se", "u", "ce", "d", "g", "r", "n")]).alias("s")).collect()
    assert [r.s for r in got] == [r.want for r in got]


def test_csv_round_trip_and_export(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 'q"q', ""), ("é,", "x", None)], "n string, v string, e string")
    writers.write_csv(df, f"{tmp_path}/c")
    assert rows(readers.csv(spark, f"{tmp_path}/c")) == [("a\nb", 'q"q', ""), ("é,", "x", "")]
    t = spark.createDataFrame([(2, "b", None, []), (1, "a", 4.5, [("A", None, "d", "t")])], f"row_idx int, business_name string, yelp_rating float, yelp_reviews {R.REVIEWS}")
    out = writers.export(t, ["_row_idx", "business_name", "yelp_rating", "yelp_reviews"])
    assert [r._row_idx for r in out.collect()] == ["1", "2"]
    writers.write_csv(out, f"{tmp_path}/x", single=True)
    back = readers.import_reviews(readers.csv(spark, f"{tmp_path}/x"), ["business_name"], ["yelp_rating"], ["yelp_reviews"])
    assert rows(back) == rows(t) and rows(readers.written_rows(readers.csv(spark, f"{tmp_path}/x"))) == [(1,), (2,)]
    assert writers.export_headers(["n"])[:5] == ["_row_idx", "n", "google_maps_rating", "google_maps_reviews", "yelp_rating"] and "bbb_reviews" not in writers.export_headers([])
    leads = spark.createDataFrame([("k", "l", 0)], "keyword string, location string, google_page int").select("*", *[F.lit(None).cast("string").alias(c.split()[0]) for c in readers.LEAD.split(", ")[3:]])
    writers.append_leads(leads, f"{tmp_path}/leads")
    writers.append_leads(leads, f"{tmp_path}/leads")
    assert [r.google_page for r in readers.csv(spark, f"{tmp_path}/leads").collect()] == ["1", "1"]


def test_json_lines_state_and_replace(spark, tmp_path):
    with gzip.open(tmp_path / "r.json.gz", "wt") as f:
        f.write('{"business_id":"a","stars":5,"date":"d","text":"t"}\n\nbad\n')
    assert readers.first_available(spark, [f"{tmp_path}/no.json", f"{tmp_path}/r.json.gz"], readers.REVIEW).count() == 1
    assert readers.first_available(spark, [f"{tmp_path}/no"], readers.REVIEW).count() == 0
    path = f"{tmp_path}/state"
    assert readers.state(spark, path, "k int").count() == 0
    writers.replace_parquet(spark.createDataFrame([(1,)], "k int"), path)
    writers.replace_parquet(readers.state(spark, path, "k int").union(spark.createDataFrame([(2,)], "k int")), path)
    assert rows(readers.state(spark, path, "k int")) == [(1,), (2,)]
    old = spark.createDataFrame([(["1", "2"], ["u"])], "completed_combos array<string>, processed_urls array<string>")
    assert rows(readers.migrate_progress(old)) == [("url", "u")]


def test_extract_once_by_content(spark):
    page = "<title>T</title><h1>Acme</h1>" + "".join(f"<p>A long paragraph of text number {i}</p>" for i in range(9)) + "<a href='mailto:Me@Acme.org'>x</a> 205-555-0100"
    sites = spark.createDataFrame([("u1", page, "", "l"), ("u2", page, None, None), ("u3", "<p>tiny</p>", "", "")], "url string, homepage_html string, contact_html string, logo_url string")
    got = {r.website_url: (r.contact_email, r.contact_phone, r.logo_url) for r in extractors.extract(sites).collect()}
    assert got == {"u1": ("me@acme.org", "205-555-0100", "l"), "u2": ("me@acme.org", "205-555-0100", "")}


def test_parsers(spark):
    landed = spark.createDataFrame([(1, "bbb", '<b class="bpr-letter-grade">B+<'), (1, "angi", '<i class="RatingsLockup_ratingNumber__x">4.8<'), (1, "homeadvisor", '"ratingValue": "4.567"'), (1, "yelp", '{"rating": 3.5, "reviews": [{"user": {"name": " N "}, "rating": 5, "time_created": "2024-01-02 03:04", "text": "t"}]}'), (1, "other", "x")], "row_idx int, site_id string, html string")
    got = {r.site_id: r for r in extractors.parse_pages(landed).collect()}
    assert {k: r.rating for k, r in got.items()} == {"bbb": 4.1, "angi": 4.8, "homeadvisor": 4.57, "yelp": 3.5, "other": None}
    assert got["yelp"].reviews[0].asDict() == {"author": "N", "rating": 5.0, "date": "2024-01-02", "text": "t"}


def test_stream_restart_claims_nothing_twice(spark, tmp_path):
    drop, out, check = f"{tmp_path}/drop", f"{tmp_path}/out", f"{tmp_path}/check"
    spark.createDataFrame([("a.com", 1), ("b.com", 2), ("a.com", 3)], "domain string, n int").write.parquet(f"{drop}/1")
    stream = lambda: claims.claim(claims.read_drops(spark, f"{drop}/*", spark.createDataFrame([], "domain string, n int").schema), ["domain"])
    claims.run_available(stream(), out, check)
    spark.createDataFrame([("b.com", 4), ("c.com", 5)], "domain string, n int").write.parquet(f"{drop}/2")
    claims.run_available(stream(), out, check)
    assert sorted(r.domain for r in spark.read.parquet(out).collect()) == ["a.com", "b.com", "c.com"]


def test_plans(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_suppkey = 1").select("l_quantity")
    plan = li._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,1)]" in plan and "l_shipdate" not in plan
