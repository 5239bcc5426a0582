"""Tags, character references and dates in HTML against Python's own readers."""

import html
import random
from datetime import date
from html.parser import HTMLParser

from pyspark.sql import functions as F

from tallyboard.functions import html as markup


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        target = dict(attrs).get("href")
        if tag == "a" and target is not None:
            self.found.append(target)

    handle_startendtag = handle_starttag


def read_by_python(text):
    reader = Links()
    reader.feed(text)
    reader.close()
    return reader.found


def read(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.found for r in rows.select("i", column(F.col("text")).alias("found")).orderBy("i").collect()]


PAGES = [
    """<a title="see href='/x'" href="/real">t</a>""",
    """<a title='a > b' class=x href=/plain/path/>t</a>""",
    """<A\nHREF = "/upper"\n>t</A><a href='/single' title="it's">""",
    """<a data-href="/no" x-href=/no href="/yes">""",
    """<a href="/first" href="/last">""",
    """<img alt="<a href='/no'>"><a href="/after">""",
    """<!-- <a href="/no"> --><a href="/one"><!----><a href="/two"><!-- x > <a href='/no'> -->""",
    """<script>var s = "<a href='/no'>";</script><style>a { content: "<a href=/no>" }</style><a href="/three">""",
    """<a name="top">no target</a><a>none</a><abbr href="/no"><area href="/no"><a/href="/slash">""",
    """<p title='<a href="/no">'>text < 3 and <a href="/less">""",
    """<a href="/q?a=1&amp;b=2&copy;&#233;&#xE9;&eacute;&hellip;&nosuch;&amp&#39;">""",
    """<a title="&quot; href='/no'" href="&#x2F;coded">""",
    "",
    "<a href='/open' title='never closed",
]


def test_links_as_the_standard_library_reads_them(spark):
    assert read(spark, PAGES, markup.hrefs) == [read_by_python(page) for page in PAGES]


def test_made_tags(spark):
    rng = random.Random(7)
    names = ["href", "title", "data-href", "HREF", "class", "hrefx", "x"]
    values = ['"/a b"', "'/c\"d'", "/plain", '"x href=\'/no\'"', "'<a href=\"/no\">'", '"a>b"', '""', "'&amp;&#65;'"]
    pages = []
    for _ in range(60):
        tags = []
        for _ in range(rng.randrange(1, 5)):
            parts = [f"{rng.choice(names)}{rng.choice(['=', ' = ', '='])}{rng.choice(values)}" for _ in range(rng.randrange(4))]
            tags.append(f"<{rng.choice(['a', 'A', 'b', 'span'])} {rng.choice([' ', chr(10)]).join(parts)}>t")
        pages.append("".join(tags))
    assert read(spark, pages, markup.hrefs) == [read_by_python(page) for page in pages]


def test_very_many_attributes_and_tags(spark):
    long = "<a " + " ".join(f'x{i}="{i}"' for i in range(20_000)) + ' href="/end">' + "<b>" * 20_000 + '<a href="/later">'
    assert read(spark, [long, "<" * 50_000, '<a "' * 20_000], markup.hrefs)[0] == ["/end", "/later"]


def test_character_references(spark):
    cases = ["&#0;", "&#65", "&#x41;b", "&#128;", "&#x9f;", "&#129;", "&#xD800;", "&#1114112;", "&#99999999999;", "&#x1F600;",
             "&#000000000065;", "&lt;&gt;&amp;&quot;&apos;", "&NotEqualTilde;", "&unknown;", "&", "&&amp;", "&#;", "&#x;", "a & b",
             "&AMP;", "&Amp;", "&#1;&#11;&#65535;", "plain", "&nbsp;x"]
    assert read(spark, cases, markup.decoded) == [html.unescape(case) for case in cases]
    # Without a semicolon an old name counts, unless it goes on as a query string does.
    assert read(spark, ["&copy", "&copy=1", "&copyx", "&copy-1", "&hellip"], markup.decoded) == ["©", "&copy=1", "&copyx", "©-1", "&hellip"]


def test_dates_as_the_standard_library_takes_them(spark):
    cases = ["2024-06-15", "20240615", "2024-W24-6", "2024W246", "2024-W24", "2024W24", "2020-W53-7", "2021-W53-1", "2021W531",
             "2026-W53", "0001-01-01", "0000-01-01", "00000101", "0001-W01-1", "9999-W52-5", "9999-W52-7", "9999-12-31", "2023-02-29",
             "2024-02-29", "20240230", "2024-13-01", "2024-1-1", "2024-W00-1", "2024-W1-1", "2024-W01-0", "2024-W01-8", "2024W01-1",
             "2024-W011", "2024-166", "2024166", "2024-06", "2024", "", " 2024-06-15", "2024-06-15T00:00", "2024-w24-6",
             "٢٠٢٤-06-15", "2024/06/15", "24-06-15", "99999999"]

    def plain(text):
        try:
            return date.fromisoformat(text)
        except ValueError:
            return None

    assert read(spark, cases, markup.iso_date) == [plain(case) for case in cases]


def test_every_day_of_some_years_in_its_forms(spark):
    days = [date.fromordinal(n) for n in range(date(2019, 12, 20).toordinal(), date(2027, 1, 20).toordinal(), 3)]
    texts = []
    for day in days:
        year, week, weekday = day.isocalendar()
        texts += [f"{year}-W{week:02}-{weekday}", f"{year}W{week:02}{weekday}", day.strftime("%Y%m%d")]
    assert read(spark, texts, markup.iso_date) == [day for day in days for _ in range(3)]
