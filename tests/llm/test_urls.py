import duckdb

from tarnspark.llm import urls as U
from tarnspark.llm.queries import OP4_SQL

URLS = ["http://a.net/x", "HTTPS://WWW.Example.NET/en/1?q#f", "http://example.net/en", "http://x.example.com/de/1", "http://example.com/DE/1", "http://a.org/fr/", "http://org/fr/x", "http://nonet/x", "http://net/", "http://net", "ftp://h?x/y", "h/no", "", None, "a://b://c/d", "http://www.spam-farm.example.com/en/3", "http://x.cheap-pills.example.org/", "http://notspam-farm.example.org/", "http://example.net/en/#a", "http://İ.org/fr/", "://h/p", "http://h\n.org/fr/\nx"]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    fit = [(len(h + p), h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    bare = host.removeprefix("www.")
    listed = {x.split("://")[1].rstrip("/") for x in U.LISTED}
    return host, path, None, "block" if any(bare == x or bare.endswith("." + x) for x in listed) else "allow"


def test_brute_and_sql(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[15])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as verdict", "3 as key", "4 as block", "5 as w0")
    got = sorted((repr(r.page_id), r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages, U.default_list(spark)).collect())
    assert got == sorted((repr(i), *brute(u)) for i, u in rows)
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", rows[: len(URLS)])
    sql = con.execute(OP4_SQL)
    names = [d[0] for d in sql.description]
    assert sorted(tuple(r[names.index(c)] for c in ("page_id", "host", "path", "rule", "verdict")) for r in sql.fetchall() if r[0] != 21) == sorted((i, *brute(u)) for i, u in rows[: len(URLS)] if i != 21)


def test_very_long_urls(spark):
    long = "http://www.spam-farm.example.org/" + "x/" * 200_000
    rows = [(1, long), (2, "http://" + "a." * 50_000 + "example.com/de/" + "y" * 100_000), (3, "http://" + "b" * 300_000)]
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), U.default_list(spark)).collect())
    assert got == [(i, *brute(u)) for i, u in rows] and [g[4] for g in got] == [brute(u)[3] for _, u in rows]


def test_empty_sides(spark):
    none = spark.createDataFrame([], "url string")
    pages = spark.createDataFrame([(1, "http://spam-farm.example.org/")], "page_id long, url string")
    assert [r.verdict for r in U.judge_urls(pages, none).collect()] == ["allow"]
    assert U.judge_urls(pages.limit(0), U.default_list(spark)).count() == 0


def test_listed_paths_and_filter(spark):
    listed = spark.createDataFrame([(f"http://www.h{i}.com/p/{i}/",) for i in range(500)] + [(None,), ("bad",)], "url string")
    pages = spark.createDataFrame([(i, f"http://h{i}.com/p/{i}" if i % 2 else f"http://h{i}.com/q") for i in range(600)], "page_id long, url string")
    got = {r.page_id for r in U.judge_urls(pages, listed).where("verdict = 'block'").collect()}
    assert got == {i for i in range(500) if i % 2}
