"""Cards and search links of hand-made pages, from SQL and from DataFrames."""

from pyspark.sql import functions as F

from tarnspark.functions import cards

TRUST = """<html><script>var a = '<div data-testid="service-review-card-v2">';</script>
<div data-testid="service-review-card-v2"><span data-consumer-name-typography="true"> Ann <b>B.</b> </span><img alt="Rated 4 out of 5 stars"><time datetime="2024-01-02T03:04">Jan 2</time><p data-service-review-text-typography>Good &amp; fast<br>job</p></div>
<div data-testid="service-review-card-v2"><div data-service-review-rating="3.5"></div><time> Feb </time></div>
<section data-testid="service-review-card-v2"><span data-consumer-name-typography>C<div data-service-review-rating="2"></section>"""
HOUZZ = """<article class="big review"><i class=reviewer-name>D</i><span aria-label="4.5 stars"></span><span class=date> May 1 </span><p>first<p>second</article>
<div class="xReviewItemx"><p class="description">text only</p><b class="rating">Rated 3</b></div><div itemprop="review"></div><div class="review">no card</div>"""


def test_cards():
    assert list(cards.cards_of(TRUST, "trustpilot")) == [(0, "Ann B.", 4.0, "2024-01-02T03:04", "Good & fastjob"), (2, "C", 2.0, "", "")]
    assert list(cards.cards_of(HOUZZ, "houzz")) == [(0, "D", 4.5, "May 1", "firstsecond"), (1, "", 3.0, "", "text only")]
    for html, site in ((None, "houzz"), ("", "houzz"), (TRUST, None), (TRUST, "other"), ("<div class=pro-review", "houzz"), ("</div><p>", "houzz")):
        assert list(cards.cards_of(html, site)) == []


def test_from_sql_and_dataframes(spark):
    pages = spark.createDataFrame([(1, TRUST, "trustpilot"), (2, HOUZZ, "houzz"), (3, None, "houzz"), (4, "<p>", "none")], "id int, html string, site string")
    cards.register(spark)
    pages.createOrReplaceTempView("card_pages")
    sql = spark.sql("SELECT id, c.* FROM card_pages, LATERAL review_cards(html, site) c").collect()
    frame = cards.review_cards(pages, "html", F.col("site").outer()).select("id", "place", "author", "rating", "date", "text").collect()
    assert sorted(map(tuple, sql)) == sorted(map(tuple, frame)) == [(1, 0, "Ann B.", 4.0, "2024-01-02T03:04", "Good & fastjob"), (1, 2, "C", 2.0, "", ""), (2, 0, "D", 4.5, "May 1", "firstsecond"), (2, 1, "", 3.0, "", "text only")]


SEARCH = """<a href="http://out.com/">out</a><div id="search"><div id="rso">
<div><a href="http://one.com/x?q=1"><h3>t</h3></a><a href="https://www.google.com/maps"><h3>g</h3></a></div>
<a data-ved=1 href="/local">l</a><a jsname href="http://five.com/">5</a><a href="http://six.com/#f">6</a>
</div><p><a href="http://two.com/"><h3>t</h3></a></p><div class="g"><a href="http://three.com/"><div><h3>t</h3></div></a></div>
<a href="http://four.com/"><cite>four.com</cite></a><a href="http://seven.com/">7</a><a><h3>no link</h3></a><a href="http://one.com/x"><cite>nodot</cite></a></div>"""


def test_kinds_of_links():
    found = [(k, h) for k, _, h in sorted(cards.links_of(SEARCH))]
    assert [h for k, h in found if k == 1] == ["http://one.com/x?q=1", "https://www.google.com/maps"]
    assert [h for k, h in found if k == 2] == ["http://one.com/x?q=1", "https://www.google.com/maps", "http://two.com/", "http://three.com/"]
    assert {k: [h for j, h in found if j == k] for k in (3, 4, 5)} == {3: ["http://three.com/"], 4: ["http://four.com/"], 5: ["/local", "http://five.com/"]}
    assert [h for k, h in found if k == 6] == ["http://one.com/x?q=1", "http://five.com/", "http://six.com/#f"]
    assert "http://out.com/" not in [h for _, h in found] and ("7", "http://seven.com/") in [(str(k), h) for k, h in found]


def test_results_are_distinct_and_in_order(spark):
    df = spark.createDataFrame([(1, SEARCH), (2, None), (3, "")], "id int, html string")
    got = [(r.id, r.url) for r in cards.search_results(df, "id", "html").orderBy("id", "rank").collect()]
    assert got == [(1, f"http://{n}.com/{'x' if n == 'one' else ''}") for n in ("one", "two", "three", "four", "five", "six", "seven")]
