"""URL rules and terms on given cases and against DuckDB."""

from checks.compare import canonical, oracle_rows
from tallyboard.llm.oracles import oracle_sql
from tallyboard.llm.queries import op7_url_filter
from tallyboard.llm.url_filter import filter_urls

CASES = [
    (None, "", "", None, "allow"),
    ("no scheme at all", "", "", None, "allow"),
    ("cheap casino without scheme", "", "", None, "block"),
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("https://m.example.com/de/1", "m.example.com", "/de/1", "example.com/de/", "block"),
    ("https://m.example.com?/de/1", "m.example.com", "", None, "allow"),
    ("https://b.org/fr/1#x://y/", "b.org", "/fr/1", "org/fr/", "allow"),
    ("https://internet/x", "internet", "/x", None, "allow"),
    ("https://net/x", "net", "/x", "net/", "block"),
    ("https://a.com/viagra", "a.com", "/viagra", None, "block"),
    ("https://a.com/viagras", "a.com", "/viagras", None, "allow"),
    ("https://free.a.com/free-x", "free.a.com", "/free-x", None, "allow"),
    ("https://free-bets.a.com/", "free-bets.a.com", "/", None, "block"),
    ("https://a.com/" + "x/" * 100_000 + "porn", "a.com", "/" + "x/" * 100_000 + "porn", None, "block"),
]


def test_cases(spark):
    rows = [(i, c[0], None, "x") for i, c in enumerate(CASES)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    found = filter_urls(pages).collect()
    assert len(found) == 2 * len(CASES)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == CASES[r.page_id][1:], CASES[r.page_id][0][:80]
    assert filter_urls(pages.limit(0)).collect() == []


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    table = op7_url_filter(spark, folder)
    names, rows = oracle_rows(folder, oracle_sql()["op7_url_filter"])
    assert canonical(table.columns, [tuple(r) for r in table.collect()]) == canonical(names, rows)
