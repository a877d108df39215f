"""Table-driven cases of the scalar functions; expectations are written by hand."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tarnspark.functions import pages as P
from tarnspark.functions import reviews as R
from tarnspark.functions import text as X
from tarnspark.functions import urls as U


def values(spark, f, inputs, schema="x string"):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, " + schema)
    return [r.y for r in df.select("i", f(*[F.col(c) for c in df.columns[1:]]).alias("y")).orderBy("i").collect()]


CASES = {
    "domain": (U.domain, {"https://www.Acme.com/x": "acme.com", "HTTP://user@Host.com:8080/": "user@host.com:8080", "acme.com/x": "", "//host/x": "host", "": "", None: "", "http://a b.com/": "a b.com", "http://a_b.com?q": "a_b.com", "http://bücher.de#f": "bücher.de", "http://www.www.x.com": "www.x.com"}),
    "domain_of": (U.domain_of, {"acme.com/x": "acme.com", "www.acme.com": "acme.com", "": "", None: "", "https://A.b/": "a.b"}),
    "apex": (U.apex, {"https://www.acmehvac.com/": "acmehvac", "airpros-energy.net": "airpros-energy", "sub.example.co.uk": "example", "": "", "localhost": "localhost", "co.uk": "co"}),
    "clean": (U.clean_url, {"HTTPS://WWW.A.com/p/q;x=1?z#f": "https://WWW.A.com/p/q", "http://a.com": "http://a.com", "http://a.com/a;b/c": "http://a.com/a;b/c"}),
    "excluded": (U.excluded, {"https://x.com/": True, "https://abcx.com/": False, "https://sub.x.com/": True, "https://a.gov/": True, "https://a.co/": True, "https://a.com/": False, "https://a.com/es/": True, "https://a.com/essen/": False, None: True, "https://a.de/": True}),
    "result": (U.result_link, {"http://a.com": True, "/x": False, "https://www.google.com/a": False, None: False}),
    "quote_plus": (U.quote_plus, {"a b&c": "a+b%26c", "~*/+%": "~%2A%2F%2B%25", "é": "%C3%A9"}),
    "quote": (U.quote, {"a b/c~*": "a%20b/c~%2A"}),
    "uule": (U.uule, {"New York, NY": "w+CAIQICIMTmV3IFlvcmssIE5Z", "é" * 40: "w+CAIQICIQ" + "w6nDqcOp" * 13 + "w6k="}),
    "reviews_link": (U.reviews_link, {"http://m/data=abc?x": "http://m/data=abc!9m1!1b1?x", "http://m/data=abc!9m1!1b1": "http://m/data=abc!9m1!1b1", "http://m/": "http://m/"}),
    "slug": (X.slug, {"Los Ángeles!": "los-ángeles", "  St. Paul_x ": "st-paul-x", None: "", "--": ""}),
    "normalize": (X.normalize_name, {"Dunn's HVAC & Plumbing Services, Co. LLC": "dunn s hvac plumbing", "The Company Inc.": "", None: "", "A\\B: (C)": "a b c", "Café & Co": "café"}),
    "search_name": (X.search_name, {"Smith & Sons, LLC.": "Smith and Sons", "Inc Co Corp": "", "Bob's": "Bob s"}),
    "key": (lambda c: X.match_key(F.lit("ga"), F.lit("Fort Worth"), c), {"ARS / Rescue Rooter": "GA|fort-worth|ars / rescue rooter"}),
    "clean_text": (X.clean_text, {" a\0b\r\nc \t d ": "ab c d", None: ""}),
    "truncate": (lambda c: X.truncate(c, 3), {"abc": "abc", "abcd": "abc…", "ab😀d": "ab😀…", None: None}),
    "entities": (X.decode_entities, {"&amp;quot; &#39;": "\" '"}),
    "hash": (X.content_hash, {"é": hashlib.md5("é".encode()).hexdigest()}),
    "grade": (X.grade, {"A+": 5.0, "A": 4.7, "A-": 4.4, "B+": 4.1, "B": 3.8, "B-": 3.5, "C+": 3.2, "C": 2.9, "C-": 2.6, "D+": 2.3, "D": 2.0, "D-": 1.7, "F": 1.0, "E": None, None: None}),
    "first_rating": (X.first_rating, {"10/5": None, "0 stars": None, "4.5 out of 5": 4.5, "9 stars, 3 Stars": 3.0, "2★": 2.0, "5 starship": None, None: None}),
    "element_rating": (X.element_rating, {" 4.7 (12)": 4.7, "4.7 " + "x" * 27: None, "4.7 " + "x" * 26: 4.7, "0.4": None, "": None, None: None}),
    "star_label": (X.star_label, {"Rated 4 of 5": 4, "none": None}),
    "contact": (P.valid_contact_page, {"x" * 501: True, "x" * 500: False, "Not Found" + "x" * 600: False, "x" * 500 + "404": True, None: False}),
    "junk": (P.junk, {"x" * 149: True, "x" * 150: False, " " * 9 + "x" * 149: True, "x" * 150 + "IT WORKS!": True, None: True}),
    "fetch_blocked": (P.fetch_blocked, {"x" * 4999: True, "x" * 5000: False, "Ray ID x" + "x" * 6000: False, "Ray ID cloudflare" + "x" * 6000: True, "x" * 7000 + '"errorCode":"HTTP ERROR 403"': True, None: True}),
    "no_reviews": (P.no_reviews, {"No Reviews Yet": True, "x" * 30000 + "no reviews yet": False, None: False}),
    "emails": (P.emails, {"MAILTO:Foo@Bar.org foo@bar.org x@example.com": ["foo@bar.org"], " ".join(f"{c}@q.org" for c in "gfedcba"): [f"{c}@q.org" for c in "abcde"], "none": []}),
    "phones": (P.phones, {"tel:+1-205-555-0100": ["205-555-0100"], "(205) 555-0100 or 205.555.0101": ["(205) 555-0100", "205.555.0101"], "12055550100": []}),
    "logo": (P.logo_source, {"<img alt='x' src='/a/Logo.png'>": "/a/Logo.png", '<img class="site-logo" src="b.png">': "b.png", '<img alt="Our LOGO" src="c.png">': "c.png", '<img id="logo" src="d.png">': "d.png", "<p>": ""}),
    "grade_of_page": (R.listing_grade, {'<b class="bpr-letter-grade" x>A-<': "A-", '<b class="bpr-header-rating">F<': "F", "x": None}),
    "name_of_page": (R.listing_name, {'<span id="businessName">\n A &amp; B  Co </span>': "A & B Co", '<b id="businessName">About</b>': None, "x": None}),
    "fence": (R.fenced_json, {'```json\n{"a": 1}\n```': '{"a": 1}', '{"a": 1}': '{"a": 1}'}),
    "links": (R.links, {'<a href="https://a.com/x"><a href="https://duckduckgo.com/y"><a href="/l/?uddg=%2F%2Fb.com%2Fc%2B&r=1"><a href="https://a.com/x">': ["https://a.com/x", "https://b.com/c+"]}),
}


@pytest.mark.parametrize("name", CASES)
def test_scalar(spark, name):
    f, cases = CASES[name]
    assert values(spark, f, list(cases)) == list(cases.values())


def test_html_to_text(spark):
    many = "".join(f"<p>paragraph number {i:02d}</p>" for i in range(25))
    page = f'<title> T </title><meta name="description" content="D"><script>"</p>"</script><h2>H<b>x</b></h2><p>short para text<p>long enough paragraph <b>bold</b><address>1 St<br>City</address><footer>a <i>b</i></footer>{many}'
    got = values(spark, P.html_to_text, [page, None, ""])
    lines = got[0].split("\n")
    assert lines[:4] == ["TITLE: T", "META: D", "Hx", "long enough paragraphbold"]
    assert lines[-2:] == ["ADDRESS: 1 St City", "FOOTER: a b"]
    assert sum(x.startswith("paragraph number") for x in lines) == 18
    assert got[1:] == ["", ""]


def test_join_url(spark):
    assert values(spark, U.join_url, [("http://a.com/b/c", "../l.png"), ("http://a.com", "http://x/y"), ("http://a.com", None)], "b string, u string") == ["http://a.com/l.png", "http://x/y", None]


LD = '<script type="application/ld+json">{}</script>'


def test_structured_data(spark):
    business = '{"@type":"LocalBusiness","aggregateRating":{"ratingValue":"4.5"},"review":[{"author":{"name":" A "},"reviewRating":{"ratingValue":"5"},"reviewBody":"x &amp; y ","datePublished":"2024-01-01"},{"author":"B","description":"d"},7]}'
    inputs = [LD.format(business), LD.format(f"[{business}]"), LD.format('{"@graph":[{"@type":"Person"},' + business + "]}"), LD.format('{"@type":"Person"}\n' + business), LD.format("{bad"), None, LD.format('{"@type":["HVACBusiness","LocalBusiness"],"review":{"author":"S","reviewBody":"one"}}')]
    got = values(spark, R.page_reviews, inputs)
    want = [{"author": "A", "rating": 5.0, "date": "2024-01-01", "text": "x & y"}, {"author": "B", "rating": None, "date": "", "text": "d"}]
    for g in got[:4]:
        assert g.rating == 4.5 and [r.asDict() for r in g.reviews] == want
    assert all(g.rating is None and g.reviews == [] for g in got[4:6])
    assert got[6].rating is None and got[6].reviews[0].author == "S"


def test_cells(spark):
    got = values(spark, R.from_cell, ["[]", "", None, "bad", '[{"author":"é","rating":"4.5","date":"d","text":"t"},{"author":"b","rating":null}]', '{"a":1}'])
    assert [len(g) for g in got][:4] == [0, 0, 0, 0] and got[4][0].rating == 4.5 and got[4][1].rating is None
    df = spark.createDataFrame([([("é" * 201, None, "d", "a\r\nb")],), (None,)], f"r {R.REVIEWS}")
    cells = [r.c for r in df.select(R.to_cell(F.col("r")).alias("c")).collect()]
    assert cells[1] == "" and '"rating":null' in cells[0] and "é" * 200 + "…" in cells[0] and "a b" in cells[0]
