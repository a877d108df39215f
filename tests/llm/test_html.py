import random
import time
from collections import Counter

from pyspark.sql import functions as F

from tarnspark.llm import html as H

PAGES = [
    ("<article><h1>T &amp; x</h1><p><b>One.<br><p>Two\n three&nbsp;four</article><footer>&copy; f</footer>", "T & x\n\nOne.\n\nTwo three four"),
    ("<body><nav><ul><li>m</ul></nav><main><p>a<p>b<div class='comments'><p>c</div></main><aside>s</aside>", "a\n\nb"),
    ("<html><head><title>t</title></head><body><div id=menu>m</div><h1>H</h1>x<script>var a='</p>'</script><style>p{}</style> y<form><p>f</form><!-- c --></body>", "H\n\nx y"),
    ("<article>a<section class='article-header'>t</section><p>b<article class='comment'>c</article><aside>q</aside>d</article>e", "a\n\nb\n\nd\n\ne"),
    ("<div class='cookie-notice'>n<div>m</div></div><p>left &lt;b&gt; &#233; &am</p><div class='ad'>ad</div>", "left <b> é &am"),
    ("plain text", "plain text"), (None, ""), ("", ""), ("<p", ""), ("<p>x<!-- never closed <p>y", "x"), ("<p>a</p><script>open", "a"), ("<div role='navigation'>r</div><p>k", "k"), ("<p class='download'>ads are fine</p>", "ads are fine"),
    ("<table><tr><td>1<td>2</table><ul><li>a<li>b</ul>", "1\n\n2\n\na\n\nb"),
]


def test_pages(spark):
    rows = [(i, f"http://h{i}/", p) for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>null"), (0, "http://h0/", PAGES[0][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("?"), "host": F.lit("?"), "part": F.lit(1), "n": F.lit(2)})
    got = H.main_texts(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == ("null" if r.page_id is None else PAGES[r.page_id][1]), (r, PAGES[r.page_id or 0][0])
    assert H.main_texts(df.limit(0)).count() == 0


def brute_cover(streams, run, pages):
    where = {}
    for i, s in enumerate(streams):
        for p in range(len(s) - run + 1):
            where.setdefault(tuple(s[p : p + run]), set()).add(i)
    out = []
    for s in streams:
        on = [False] * len(s)
        for p in range(len(s) - run + 1):
            if len(where[tuple(s[p : p + run])]) >= pages:
                on[p : p + run] = [True] * run
        out.append(on)
    return out


def brute_texts(pages, run, least):
    """page -> text by counting all windows of a host in a dictionary. pages: (id, host, html)."""
    out = {}
    for host in {h for _, h, _ in pages}:
        mine = [(i, H.blocks(x)) for i, h, x in pages if h == host]
        whole = Counter(t for _, b in mine for t in {" ".join(t.split()) for k, t in b if k != H.CONTENT})
        streams = [[w for w, _ in H.stream([k for k, _ in b], [t for _, t in b])] for _, b in mine]
        for (i, b), on in zip(mine, brute_cover(streams, run, least), strict=True):
            keep, at = [], 0
            for k, t in b:
                n = 0 if k == H.CONTENT else len(t.split())
                again = n and (2 * sum(on[at : at + n]) >= n or n < run and whole[" ".join(t.split())] >= least)
                at += n
                if k == H.CONTENT or k == H.BODY and not again:
                    keep.append(t)
            out[i] = "\n\n".join(keep)
    return out


def test_host_suffix_array_against_counting(spark):
    """A host of 700 pages, more than any one task sorts together; notices on few and on many pages, in and out of dropped parts."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    notices, pages = [say(r.randrange(8, 14)) for _ in range(30)], []
    for i in range(700):
        parts = [f"<div>{r.choice(notices[: 1 + i % 30])}</div>", f"<div>{say(r.randrange(1, 20))} page {i}</div>", f"<footer>{r.choice(notices)}</footer>"]
        parts.append(f"<article>{say(10)} text {i}</article>" if i % 2 else "")
        r.shuffle(parts)
        pages.append((i, "http://one/" if i % 50 else f"http://h{i % 3}/", "".join(parts)))
    got = {x.page_id: x.text for x in H.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(7)).collect()}
    want = brute_texts([(i, u, x) for i, u, x in pages], H.RUN, H.PAGES)
    assert got == want
    assert any("\n\n" in want[i] for i in range(1, 700, 2)) and any(notices[0] not in t for t in want.values())


def test_boilerplate_without_markup(spark):
    rows = [(i, "http://one/", f"<div>Home News About Contact Shop Cart Login Help</div><div>body of page {i} has its own words {i * 7}</div><div>All rights reserved by one company in the city of nowhere</div>") for i in range(40)]
    got = {r.page_id: r.text for r in H.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"body of page {i} has its own words {i * 7}" for i in range(40)}


def test_repeated_articles_stay(spark):
    rows = [(i, "http://one/", "<article><p>the very same article stands on all of these pages today</article>") for i in range(5)]
    assert all(r.text.startswith("the very") for r in H.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())


OMITTED = [
    ('<p class="ad">buy<p>text', "text"),
    ('<ul><li class="menu-item">a<li class="menu-item">b</ul><article>main text</article>', "main text"),
    ('<div><span class="ad">x</div><p>text', "text"),
    ('<dl><dt class="ad">x<dd>text</dl><table><tr><td class="ad">y<td>cell</table>', "text\n\ncell"),
    ('<div class="page no-sidebar"><article>whole</article></div>', "whole"),
    ('<article class="post comments-open"><p>whole</article>', "whole"),
    ('<article>one</article><div class="related"><article>teaser</article></div>', "one"),
    ('<div><article><p>a</div>b</article>', "a\n\nb"),
]


def test_omitted_end_tags_and_layout_names():
    for page, want in OMITTED:
        assert H.assemble([k for k, _ in H.blocks(page)], [t for _, t in H.blocks(page)], None) == want, page


INLINE = [
    ("<p>see <span class='widget'>inline</span> word</p>", "see inline word"),
    ("<p>see <span class='ad'>buy</span> word</p>", "see word"),
    ("<p>a <b class='share'>b</b> c <ins class='ads'>x<p>d", "a b c\n\nd"),
    ("<p>a <ins class='ads'>x</ins><p>d", "a\n\nd"),
    ("<article><p class='share'>s<p>real one<p class='ad'>buy<p>real two</article>", "s\n\nreal one\n\nreal two"),
    ("<article><p>1 <b <i>2</i></article>", "1 2"),
    ("<p>x<![CDATA[ < raw &amp; ]]>y", "x < raw &amp; y"),
]


NAMES = [
    ('<article><p data-id="share">real text</p><p>two</p></article>', "real text\n\ntwo"),
    ('<article><div data-role="search">real</div></article>', "real"),
    ("<article><div title='a class=menu item'>real</div></article>", "real"),
    ('<article><p class="side-effects">a</p><p id=alert-rules>b</p><div class="notice-period">c</div><h2 id="related">Related work</h2></article>', "a\n\nb\n\nc\n\nRelated work"),
    ("<main><p>long main text</p><article><p>teaser</p></article></main>", "long main text\n\nteaser"),
    ("<div CLASS='x site-header'>h</div><div id=post_comments>c</div><div class=share-buttons>s</div><div ROLE=Banner>b</div><div id = 'sidebar'>s</div><p>text", "text"),
    ("<div class>a</div><div class=>b</div><div =menu>c</div><div id='a' 'menu'>d</div>", "a\n\nb\n\nc\n\nd"),
    ("<div aria-label='skip' class='header-image skip-it comments-open no-sidebar'>real</div>", "real"),
]


def test_names_are_read_whole():
    for page, want in NAMES:
        assert H.assemble([k for k, _ in H.blocks(page)], [t for _, t in H.blocks(page)], None) == want, page


def test_short_blocks_that_repeat_go(spark):
    """Beside articles, too: a short block on three pages of a host is boilerplate, one on two pages isn't, nor one within a longer text."""
    rows = [(i, "http://one/" if i < 4 else f"http://h{i}/", f"<div>Read this</div><article>text {i}</article><div>{'twice' if i < 2 else f'once {i}'}</div><div>Read this and more</div><p>say {i} Read this") for i in range(6)]
    got = {r.page_id: r.text for r in H.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "\n\n".join(["Read this"] * (i > 3) + [f"text {i}", "twice" if i < 2 else f"once {i}"] + ["Read this and more"] * (i > 3) + [f"say {i} Read this"]) for i in range(6)}


def test_inline_elements_keep_their_block():
    for page, want in INLINE:
        assert H.assemble([k for k, _ in H.blocks(page)], [t for _, t in H.blocks(page)], None) == want, page


def test_time_is_linear_in_the_page():
    parts = ["<script ", "<p ", '<a "', "<a '", "<!--", "<![CDATA[>", "<head><body>", "<div>", "<ul><li>", "</p>", "<p class=", '<p class="ad" ', "&amp;", "<", "<title>", "<section></div>"]
    for part in parts:
        for tail in ("", ">", '">'):
            began = time.perf_counter()
            H.blocks(part * 100_000 + tail)
            assert time.perf_counter() - began < 8, (part, tail)


def test_very_long_page(spark):
    text = " ".join(f"w{i}" for i in range(300_000))
    got = H.main_texts(spark.createDataFrame([(1, "http://a/", f"<nav>m</nav><article><p>{text}</p></article>"), (2, "http://a/", f"<div>{text}</div>")], "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {1: text, 2: text}
