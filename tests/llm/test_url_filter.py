import duckdb
import pytest

from shelfmark.llm.queries import ORACLE_SQL, QUERIES
from shelfmark.llm.url_filter import filter_urls

URLS = [
    (1, "https://www.Example.NET/en/1?x=/de/", "www.example.net", "/en/1", "example.net/en/", "allow"),
    (2, "http://foo.net", "foo.net", "", None, "allow"),
    (3, "http://foo.net/", "foo.net", "/", "net/", "block"),
    (4, "http://example.com/de/#a", "example.com", "/de/", "example.com/de/", "block"),
    (5, "http://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    (6, "http://a.org/fr/porn", "a.org", "/fr/porn", "org/fr/", "allow"),
    (7, "http://a.org/en/porn/x", "a.org", "/en/porn/x", None, "block"),
    (8, "http://a.org/en/pornography", "a.org", "/en/pornography", None, "allow"),
    (9, "http://a.org/casino-poker/slots", "a.org", "/casino-poker/slots", None, "block"),
    (10, "http://a.org/casino/casino/casino", "a.org", "/casino/casino/casino", None, "allow"),
    (11, "no scheme/porn", "", "", None, "allow"),
    (12, None, "", "", None, "allow"),
    (13, "", "", "", None, "allow"),
    (14, "x://y://net/a?b", "y:", "//net/a", None, "allow"),
    (15, "http://É.net/É", "É.net", "/É", "net/", "block"),
    (16, "http://h.org\n.net/a\nb", "h.org\n.net", "/a\nb", "net/", "block"),
    (16, "http://" + "a" * 50_000 + ".org/" + "sex" * 10_000, "a" * 50_000 + ".org", "/" + "sex" * 10_000, None, "allow"),
    (None, "http://net/", "net", "/", "net/", "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame(
        [(number, url, None, "clash", "clash") for number, url, *_ in URLS],
        "page_id long, url string, html string, host string, verdict string",
    )
    rows = filter_urls(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(str((n, *rest)) for n, _, *rest in URLS)
    assert filter_urls(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name, table", [("op4_url_filter", "pages"), ("op8_exact_dedup", "documents")])
def test_against_sql(spark, sf_small, name, table):
    connection = duckdb.connect()
    connection.sql(f"create view {table} as select * from '{sf_small}/{table}.parquet'")
    expected = connection.sql(ORACLE_SQL[name])
    rows = QUERIES[name](spark, sf_small).select(*expected.columns).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected.fetchall()))
