"""Pages with references that no semicolon closes, and texts with neighbouring numbers, against the queries' SQL."""

import duckdb
import pytest

import __spark_entry__ as entry

CUT = "<html><head><title>Tools &amp;&amp</title></head><body><h1>Tools &amp;&amp</h1><article><h1>{0} &lt;&gt;&gt</h1><p>One word after the other number {0} &copy &amp;amp &quot;x&quot end.</p></article><footer>&copy; &middot; &middot {0}</footer></body></html>"


@pytest.mark.parametrize("name", ["q08_html_to_text", "html_hosts"])
def test_unclosed_references(spark, tmp_path, name):
    rows = [(i, f"https://a.example/{i}", CUT.format("abcdefghijkl"[i])) for i in range(12)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, entry.queries()[name](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(entry.oracle_sql()[name]).fetchall())
    assert all("&gt" in r[-1] for r in got)


def test_neighbouring_numbers(spark, tmp_path):
    texts = ["(988) 555-2485 (208) 555-1177 x", "tel:4984250489669609 ", "171.132\x0b2024 ", "+1 988.555.2485\n208.555.1177", "9885552485 4984250489669609 2085551177", None, "", "208.555.1177"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, entry.queries()["q06_contacts"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(entry.oracle_sql()["q06_contacts"]).fetchall())
