"""Links, labels and dates in HTML."""

from datetime import date
from urllib.parse import urljoin

import pytest

from tallyboard.sources import pages

LABEL = '<span class="ml-2 font-normal text-sm text-subtle">{}</span>'


def page(spark, *htmls, url="https://example.org/events/abc"):
    return spark.createDataFrame([(i, url, html) for i, html in enumerate(htmls)], "page_id long, url string, html string")


def schedule(spark, *links, inside=True):
    parts = [
        f'<a href="{href}">x {LABEL.format(year)}</a>' if inside else f'<a href="{href}">x</a>{LABEL.format(year)}'
        for href, year in links
    ]
    return page(spark, "<html><body>" + "".join(parts) + "</body></html>")


def urls(table):
    return [r["url"] for r in table.orderBy("position").collect()]


@pytest.mark.parametrize("inside", [True, False])
def test_recent_event_links(spark, inside):
    found = schedule(
        spark,
        ("/about", 2031),
        ("/events/spring-open/leaderboard", 2030),
        ("/events/spring-open", 2030),
        ("/events/winter-cup/leaderboard", 2028),
        ("/events/no-label/leaderboard", "TBA"),
        ("/events/night-round/leaderboard", "\n2029\t"),
        ("/events/spring-open/leaderboard", 2030),
        inside=inside,
    )
    links = pages.event_links(found, "https://site.example", 2029)
    assert urls(links) == [
        "https://site.example/events/spring-open/leaderboard",
        "https://site.example/events/night-round/leaderboard",
    ]


def test_link_without_a_following_label_is_skipped(spark):
    before = f'{LABEL.format(2030)}<a href="/events/lonely/leaderboard">x</a>'
    assert urls(pages.event_links(page(spark, before), "s", 2000)) == []


def test_the_label_is_the_next_one_in_the_document(spark):
    html = f'<a href="/events/p/leaderboard">p</a><a href="/events/q/leaderboard">q</a>{LABEL.format(2030)}'
    html += f'<a href="/events/r/leaderboard">r</a>{LABEL.format(2011)}'
    assert urls(pages.event_links(page(spark, html), "", 2030)) == ["/events/p/leaderboard", "/events/q/leaderboard"]


def test_leaderboard_links_are_resolved_and_distinct(spark):
    html = """<A HREF='/events/dusk/leaderboard'>D</A> <a id=1 href=https://else.example/events/k/leaderboard>K</a>
      <a href="/shop">no</a> <a href="/events/dusk/leaderboard/export">E</a> <!-- <a href="/events/x/leaderboard"> -->
      <a data-href="/events/x/leaderboard">no</a> <a href="/events/dusk/leaderboard">again</a>"""
    found = pages.resolved_links(page(spark, html)).orderBy("position").collect()
    assert [r["export_url"] for r in found] == [
        "https://example.org/events/dusk/leaderboard",
        "https://else.example/events/k/leaderboard",
        "https://example.org/events/dusk/leaderboard/export",
    ]


BASES = ["https://example.org/a/b/c?x=1#f", "http://example.org", "https://example.org/a/b/", "https://example.org/a"]
HREFS = [
    "https://h.example/p", "//h.example/p", "/p/q?y=2#z", "p", "p/q", "./p", "../p", "../../p", "../../../p", "?k=v",
    "#top", "", "/a/./b/../c", "p/..", "p/.", "..", ".", "mailto:a@example.org", "p?x=/../y",
]


@pytest.mark.parametrize("base", BASES)
def test_urls_resolve_as_in_the_standard_library(spark, base):
    from pyspark.sql import functions as F

    from tallyboard.functions.html import resolved

    rows = spark.createDataFrame([(i, h) for i, h in enumerate(HREFS)], "i int, h string").orderBy("i")
    got = [r[0] for r in rows.select(resolved(F.lit(base), F.col("h"))).collect()]
    assert got == [urljoin(base, href) for href in HREFS]


def test_end_dates(spark):
    table = page(
        spark,
        '<time datetime="2030-02-28">a</time> to <time datetime="2030-03-01" class="y">b</time>',
        "<p>no times here</p>",
        '<time datetime="in spring">x</time>',
        '<time datetime="2031-12-31"></time><time>later</time>',
        '<time datetime="2030-02-30"></time>',
    )
    dates = [r["event_end_date"] for r in pages.page_end_dates(table).orderBy("page_id").collect()]
    assert dates == [date(2030, 3, 1), None, None, date(2031, 12, 31), None]


def test_page_links_keep_the_first_place(spark):
    html = '<a href="/events/m/leaderboard?a=1&amp;b=2">1</a><a href="/faq">2</a><a href="/events/n/leaderboard">3</a>'
    html += '<a href="/events/m/leaderboard?a=1&amp;b=2">4</a>'
    found = pages.page_links(page(spark, html)).orderBy("position").collect()
    assert [(r["link"], r["position"]) for r in found] == [
        ("/events/m/leaderboard?a=1&b=2", 0),
        ("/events/n/leaderboard", 2),
    ]
