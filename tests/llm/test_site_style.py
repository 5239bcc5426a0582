"""Article text of pages: markup of many kinds, the host's template, awkward rows."""

import html
import math
import re
from collections import Counter, defaultdict

import pytest

from tallyboard.llm import site_style
from tallyboard.llm.page_blocks import blocks
from tallyboard.llm.site_style import article, candidates, digest, extract, low_nodes

CASES = [
    (None, ""),
    ("", ""),
    ("just text", "just text"),
    ("<p>a  b\n\tc&amp;d&nbsp;&lt;e&#62;</p><p></p><p> f</p>", "a b c&d <e>\nf"),
    ("<html><head><title>t</title></head><body><nav>n</nav><article><h1>T</h1><p>one<br>two</article><footer>f</footer>", "T\none two"),
    ("<article><p><b>x.<br><p>y<p>z</article>after", "x.\ny\nz"),
    ("<main><div class='post'><p>a</p><aside>s</aside><form>q<input></form><p>b</p></div></main>", "a\nb"),
    ("<article>a<script>var t='</p><p>no';</script>b<style>p{}</style></article>", "ab"),
    ("<article><p>a</p><section id='comments'><article class='comment'><p>c</p></article></section></article>", "a"),
    ("<body><header><h1>Site</h1></header><div class='cookie-notice'>k</div><article><header><h1>H</h1></header>p</article>", "H\np"),
    ("<article><p>a</p><!-- <p>hidden</p> --><p hidden>h</p><p style='display:none'>n</p><div class=ad>x</div>b", "a\nb"),
    ("<article><p title='a > b'>kept</p><p data-x=\"</article>\">too</p></article>", "kept\ntoo"),
    ("<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", "x\ny\n1\n2\n3"),
    ("<div><a href='/a'>home</a> <a href='/b'>next</a></div><p>text of it</p>", "text of it"),
    ("<article>a &amp b <i>c</i>d <span>e</span></article>", "a & b cd e"),
    ("<article><p>cut off <b", "cut off"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article><div class='sideBar'>s</div><div class='post-body'>p</div><div id='readerComments'>c</div></article>", "p"),
    ("<article>" + "<p>long text</p>" * 20_000 + "</article>", "\n".join(["long text"] * 20_000)),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("a < b and c > d", "a < b and c > d"),
]


def test_cases():
    for source, expected in CASES:
        assert article(source, None) == expected, (source or "")[:100]


def test_templates_go_and_articles_stay(spark):
    """Blocks that all pages of a host show go; copies of an article and small hosts are left alone."""
    rows = []
    for i in range(30):
        body = f"<p>Story number {i} of this site.</p><p>It has a second part {i}.</p>"
        rows.append((i, f"http://big.com/{i}", f"<div class=x><p>Buy our things today</p></div><div class=y>{body}</div><p>All rights</p>"))
        rows.append((100 + i, f"http://marked.com/{i}", f"<article><p>Read this too</p>{body}</article>"))
    copy = "<article><p>The same story.</p><p>Told again.</p></article>"
    rows += [(200 + i, f"http://copies.com/{i}", copy if i < 25 else copy.replace("story", f"tale {i}")) for i in range(40)]
    rows += [(300 + i, f"http://small.com/{i}", f"<p>Hello there</p><p>{i}</p>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in extract(pages).collect()}
    assert len(found) == len(rows)
    assert found[3].text == "Story number 3 of this site.\nIt has a second part 3."
    assert found[103].text == "Story number 3 of this site.\nIt has a second part 3."
    assert found[200].text.startswith("The same story.") and found[239].text.startswith("The same tale 39.")
    assert found[301].text == "Hello there\n1"
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_awkward_rows(spark):
    rows = [(i, None if i == 1 else "http://a.com/x", source, "t", 1) for i, (source, _) in enumerate(CASES)]
    rows += rows[3:5] + [(None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    found = extract(pages).collect()
    assert len(found) == len(rows)
    assert sorted(map(repr, extract(pages.limit(0)).collect())) == []


def test_given_pages_hold_their_article(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    sources = {r.page_id: r.html for r in table.collect()}
    for r in extract(table).collect():
        inside = re.search("<article>(.*?)</article>", sources[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", inside)]
        assert r.text == "\n".join(x for x in parts if x)


def test_only_what_most_pages_of_a_host_repeat_goes(spark):
    rows = []
    for i in range(400):
        shared = "<p>A passage that some pages quote in full.</p>" if i < 60 else ""
        rows.append((i, f"http://quotes.com/{i}", f"<p>All pages say this</p><div>{shared}<p>The own text of page number {i}.</p></div>"))
    same = "".join(f"<p>Paragraph {k} is the same in all of them.</p>" for k in range(9))
    rows += [(1000 + i, f"http://near.com/{i}", f"<article>{same}<p>Only this differs: {i}.</p></article>") for i in range(20)]
    for i in range(100):
        often = "<p>Most have it</p>" if i < 85 else ""
        rows.append((2000 + i, f"http://marked.com/{i}", f"<article><p>All have it</p>{often}<p>The story of this page is number {i}.</p></article>"))
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] == "A passage that some pages quote in full.\nThe own text of page number 3."
    assert found[99] == "The own text of page number 99."
    assert found[1007].count("is the same in all of them.") == 9 and found[1007].endswith("Only this differs: 7.")
    assert found[2001] == "Most have it\nThe story of this page is number 1."


def test_names_do_not_rule_out_the_article():
    story = "<p>The story of the day.</p><p>It is told in two parts.</p>"
    text = "The story of the day.\nIt is told in two parts."
    cases = [
        f"<html class='no-cookies'><body class='has-sidebar'><article>{story}</article><div class='sidebar'>s</div></body></html>",
        f"<body class='no-sidebar header-top'>{story}<div class='sidebar'>s</div></body>",
        f"<article class='post comments-open category-social'>{story}<article class='comment'><p>c</p></article></article>",
        f"<main id='skip-menu'>{story}</main>",
        f"<div class='content with-banner'><article>{story}</article><div class='related'><article>r</article></div></div>",
        f"<div class='content with-banner'>{story}<div class='widget'>w</div></div><div class='cookie-notice'>k</div>",
        f"<article>{story}</article><div class='comments'><article><p>{'a long comment ' * 20}</p></article></div>",
    ]
    for source in cases:
        assert article(source, None) == text, source


def test_what_is_ruled_out_inside_a_line_leaves_one_block():
    noise = [
        "<span class='ad'>BUY NOW</span>", "<span hidden>BUY</span>", "<button>BUY</button>", "<b aria-hidden=true>BUY</b>",
        "<select><option>BUY<option selected>NOW</select>", "<span style='display: none'>BUY <i>NOW</i></span>",
    ]
    for x in noise:
        for around in ("<article>{}</article>", "<div>{}</div><p>And some more text after it.</p>"):
            rest = "" if "article" in around else "\nAnd some more text after it."
            assert article(around.format(f"<p>hi {x} there, all of you</p>"), None) == "hi there, all of you" + rest, x
            assert article(around.format(f"<p>one{x}word &amp; more</p>"), None) == "oneword & more" + rest, x
    assert article("<p>a <span itemprop='articleBody'>story <i>of</i> it</span> b</p>", None) == "story of it"
    assert article("<article><p>x <span class=ad>cut off", None) == "x"


def test_forms_around_pages_and_in_them():
    story = "<h1>Head</h1><p>The story of the day.</p><p>It is told in two parts.</p>"
    text = "Head\nThe story of the day.\nIt is told in two parts."
    form = "<form>Name <input> Mail <input></form>"
    cases = [
        f"<body><form action=x>{story}<input type=hidden></form></body>",
        f"<body><form><div class='sidebar'>s</div><nav>n</nav><article>{story}</article></form></body>",
        f"<form><div class='content with-banner'>{story}</div></form>",
        f"<main><form>{story}</form></main>",
        f"<main>{story}{form}</main>",
        f"<div>{story}</div>{form}",
        f"<article>{story}</article><form>{'a very long form ' * 50}</form>",
    ]
    for source in cases:
        assert article(source, None) == text, source


def test_names_that_together_hold_all_leave_it():
    a, b = "The science of society, told at some length.", "What the search has found, told at some length."
    source = f"<div class='social-science'><p>{a}</p></div><div class='search-results'><p>{b}</p></div><div class='cookie'>ok</div>"
    assert article(source, None) == f"{a}\n{b}"


def test_paragraphs_with_a_link_are_no_menus():
    text = "<p>The rest of the text.</p>"
    assert article("<p><a href=x>The whole report of the commission</a></p>" + text, None).startswith("The whole report")
    assert article("<p>See <a href=x>the whole report of the commission</a></p>" + text, None).startswith("See the whole")
    assert article("<h2><a href=x>A heading</a></h2>" + text, None).startswith("A heading")
    assert article("<p><a href=x>Home</a>&nbsp;| <a href=y>News</a></p>" + text, None) == "The rest of the text."
    assert article("<ul><li><a href=x>Home</a><li><a href=y>News</a></ul>" + text, None) == "The rest of the text."


def test_a_low_branch_goes_from_marked_articles(spark):
    """A box that 80 of 100 articles carry goes by its branch; lines that as many share stay."""
    box = "<div class=join><h3>Join us</h3><p>It takes a minute.</p></div>"
    rows = []
    for i in range(100):
        line = "<p class=note>One line that many have</p>" if i < 80 else ""
        rows.append((i, f"http://boxes.com/{i}", f"<article><p>The story number {i} is told here.</p>{box if i < 80 else ''}{line}</article>"))
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] == "The story number 3 is told here.\nOne line that many have"
    assert found[90] == "The story number 90 is told here."


def plain_tree(sources):
    """The low nodes of one host by plain loops: {(path, content or None): (importance, share)}."""
    styles, contents, pages = defaultdict(set), defaultdict(set), set()
    for source in sources:
        found, elements = blocks(source)
        kept = candidates(found)
        page = "\n".join(b.text for b in kept)
        pages.add(page)
        for b in kept:
            contents[b.path, b.text].add(page)
        for path, inside in elements:
            if any(b.path == path or b.path.startswith(path + "/") for b in kept):
                styles[path].add((inside, page))
    m = len(pages)
    if m < site_style.LEAST_PAGES:
        return {}
    weight = {key: (1 - math.log(len(on)) / math.log(m), len(on) / m, len(on)) for key, on in contents.items()}
    low = {(p, digest(t)): w[:2] for (p, t), w in weight.items() if w[0] < site_style.ELSEWHERE and w[1] >= site_style.HALF}
    for path, seen in styles.items():
        below = [w for (p, _), w in weight.items() if p == path or p.startswith(path + "/")]
        mean = sum(w[0] * w[2] for w in below) / sum(w[2] for w in below)
        of = Counter(inside for inside, _ in seen)
        entropy = sum(-n / m * math.log(n / m) for n in of.values()) / math.log(m)
        most, least = max(w[0] for w in below), min(w[1] for w in below)
        whole = (1 - site_style.G) * min(entropy, 1) + site_style.G * mean
        if whole < site_style.LOW_BRANCH and most < site_style.ELSEWHERE and least >= site_style.HALF:
            low[path, None] = (most, least)
    return low


@pytest.mark.parametrize("n", [site_style.LEAST_PAGES - 1, site_style.LEAST_PAGES, 40])
def test_tree_equals_plain_loops(spark, n):
    sources = []
    for i in range(n):
        extra = "<p>Half of them say this</p>" if i % 2 else "<ul><li>Or else this</ul>"
        sources.append(
            f"<body><div class='top'><p>All say this</p><p>And this</p></div><div class='mid'>{extra}<p>Own text {i}.</p></div>"
            f"<div class='low'>{'<p>Nearly all</p>' if i else ''}<div>Words {i // 4}</div></div></body>"
        )
    rows = [(i, "http://one.com/x", s) for i, s in enumerate([*sources, *sources[:3]])]
    found = low_nodes(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    low = {(x.path, x.what): (x.importance, x.share) for r in found for x in r.low}
    expected = plain_tree(sources)
    assert low.keys() == expected.keys()
    assert bool(low) == (n >= site_style.LEAST_PAGES)
    for key, pair in expected.items():
        assert low[key] == pytest.approx(pair, abs=1e-9)
