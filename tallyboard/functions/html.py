"""Column expressions that read links, labels and dates out of raw HTML.

A page is scanned once, from tag to tag. A tag is read attribute by attribute, so what looks like a tag or an
attribute inside a quoted value, a comment, a script or a style sheet is neither.
"""

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyboard.functions.text import stripped

# The grammar of tags. Names and values end as the HTML standard says; no part gives back what it took.
ATTRIBUTE = r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+"""
ATTRIBUTES = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+"""
COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
RAW_TEXT = rf"<(?:script(?=[\s/>]){ATTRIBUTES}>.*?(?:</script(?=[\s/>])|\z)|style(?=[\s/>]){ATTRIBUTES}>.*?(?:</style(?=[\s/>])|\z))"
# A tag that never ends takes the rest of the page.
ANY_TAG = rf"</?[a-z][^\s/>]*+{ATTRIBUTES}(?:>|\z)"
TAG = r"(?s)<[^>]*>"

# The class of year labels, and the forms of a date that are taken.
YEAR_LABEL = "ml-2 font-normal text-sm text-subtle"
CALENDAR_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
COMPACT_DATE = r"^[0-9]{8}$"
WEEK_DATE = r"^([0-9]{4})(?:-W([0-9]{2})(?:-([0-9]))?|W([0-9]{2})([0-9])?)$"

# Code points 128 to 159 stand for those of the Windows code page 1252, five of them for themselves.
UNUSED = (129, 141, 143, 144, 157)
WINDOWS = [n if n in UNUSED else ord(bytes([n]).decode("cp1252")) for n in range(128, 160)]
REPLACEMENT = "\ufffd"


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """What `body` makes of a value that it looks at several times; the value is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(name: str) -> str:
    """The pattern of one step through a page: group 1 is a start tag called `name`."""
    return rf"(?is){COMMENT}|{RAW_TEXT}|(<{name}(?=[\s/>]){ATTRIBUTES}>)|{ANY_TAG}"


def tags(html: Column, name: str) -> Column:
    """All start tags of a name, in document order."""
    return F.filter(F.regexp_extract_all(html, F.lit(_scan(name)), F.lit(1)), lambda tag: tag != "")


def attribute(tag: Column, name: str) -> Column:
    """The value of one attribute of a start tag, the last of that name; NULL if it has none."""
    every = F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]+", ""), F.lit(ATTRIBUTE), F.lit(0))
    last = F.try_element_at(F.filter(every, lambda one: one.rlike(rf"(?i)^{name}(?![^\s=])")), F.lit(-1))
    # Of the three ways to write a value at most one is used.
    written = lambda one: F.concat(*[F.regexp_extract(one, f"^{ATTRIBUTE}", group) for group in (2, 3, 4)])
    return decoded(_once(last, written))


def _character(digits: Column, base: int) -> Column:
    """The character of a numeric reference."""
    short = F.regexp_replace(digits, "^0+", "")
    number = _once(short, lambda text: F.conv(F.when(F.length(text).between(1, 7), text).otherwise("0"), base, 10).cast("int"))
    meant = _once(number, lambda given: F.coalesce(F.get(F.lit(WINDOWS), F.when(given >= 128, given - 128)), given))

    def character(code: Column) -> Column:
        # Controls and code points that are no characters vanish; what is no code point is replaced.
        nothing = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
        nothing = nothing | ((code.bitwiseAND(0xFFFF) >= 0xFFFE) & (code <= 0x10FFFF))
        sound = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(~sound, REPLACEMENT).when(nothing, "").otherwise(wide)

    return _once(meant, character)


def named_references() -> Column:
    """The public list of named references as a map; names end with a semicolon, but for the old ones."""
    return F.from_json(F.lit(json.dumps(html5)), "map<string,string>")


def decoded(value: Column) -> Column:
    """An attribute's value with its character references replaced.

    Decimal, hexadecimal and named ones, the old names without semicolon too, unless `=` or a letter or digit
    follows, as in a query string.
    """
    references = named_references()
    pattern = r"^&(#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[a-zA-Z][a-zA-Z0-9]*+;?)"

    def known(cut: Column) -> Column:
        """What the reference at the beginning of a piece stands for; NULL for none."""
        reference, after = cut["reference"], cut["after"]
        digits = F.rtrim(reference, F.lit(";"))
        name = F.when(reference.endswith(";") | ~after.startswith("="), F.try_element_at(references, reference))
        return (
            F.when(reference == "", F.lit(None).cast("string"))
            .when(reference == "amp;", "&")
            .when(reference.rlike("^#[xX]"), _character(F.substr(digits, F.lit(3)), 16))
            .when(reference.startswith("#"), _character(F.substr(digits, F.lit(2)), 10))
            .otherwise(name)
        )

    def replaced(piece: Column) -> Column:
        after = lambda one: F.struct(one.alias("reference"), F.substr(piece, F.length(one) + 2).alias("after"))
        cut = _once(F.regexp_extract(piece, pattern, 1), after)
        return F.coalesce(_once(cut, lambda parts: F.concat(known(parts), parts["after"])), piece)

    def whole(text: Column) -> Column:
        # Cut before every &; the first piece has none.
        pieces = F.transform(F.split(text, "(?=&)"), replaced)
        return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)

    return _once(value, whole)


def _hrefs(found: Column) -> Column:
    """Targets of those start tags that have one."""
    return F.filter(F.transform(found, lambda tag: attribute(tag, "href")), lambda href: href.isNotNull())


def hrefs(html: Column) -> Column:
    """All link targets of a page in document order."""
    return _hrefs(tags(html, "a"))


def schedule_marks(html: Column) -> Column:
    """Links and year labels in document order: (href, is_label, year).

    The text of a label runs to the end of its element. A column of its own, as later steps look at it twice.
    """
    label = rf"(<span(?=[\s/>]){ATTRIBUTES}>)(?=(.*?)(?:</span|\z))"
    steps = rf"(?is){COMMENT}|{RAW_TEXT}|(<a(?=[\s/>]){ATTRIBUTES}>)|{label}|{ANY_TAG}"
    part = lambda group: F.regexp_extract_all(html, F.lit(steps), F.lit(group))
    both = F.zip_with(part(1), part(2), lambda a, span: F.struct(a.alias("a"), span.alias("span")))
    found = F.zip_with(both, part(3), lambda tag, text: F.struct(tag["a"].alias("a"), tag["span"].alias("span"), text.alias("text")))
    found = F.filter(found, lambda x: (x["a"] != "") | F.contains(x["span"], F.lit("class")) | x["span"].rlike("(?i)class"))

    def mark(x: Column) -> Column:
        names = F.regexp_replace(stripped(attribute(x["span"], "class")), r"\s+", " ")
        label = stripped(decoded(F.regexp_replace(x["text"], TAG, "")))
        year = _once(label, lambda text: F.when(text.rlike(r"^[+-]?\d+$"), text).try_cast("int"))
        return F.struct(
            F.when(x["a"] != "", attribute(x["a"], "href")).alias("href"),
            F.coalesce(names == YEAR_LABEL, F.lit(False)).alias("is_label"),
            year.alias("year"),
        )

    marks = F.transform(found, mark)
    return F.filter(marks, lambda x: x["is_label"] | x["href"].isNotNull())


def label_places(marks: Column) -> Column:
    """Where the labels are among the marks; a column of its own."""
    every = F.sequence(F.lit(0), F.size(marks) - 1)
    return F.when(F.size(marks) > 0, F.filter(every, lambda i: F.get(marks, i)["is_label"])).otherwise(F.array().cast("array<int>"))


def dated_hrefs(marks: Column, places: Column) -> Column:
    """Link targets with the year label that follows each of them, as an array of (href, year).

    The links between two labels are one slice of the marks, so no link is compared with the labels. Links
    after the last label have none and are left out.
    """

    def links_before(place: Column, index: Column) -> Column:
        begin = F.coalesce(F.get(places, index - 1), F.lit(-1)) + 1
        year = F.get(marks, place)["year"]
        own = F.slice(marks, begin + 1, place - begin)
        return F.transform(own, lambda mark: F.struct(mark["href"].alias("href"), year.alias("year")))

    return F.flatten(F.transform(places, links_before))


def last_time(html: Column) -> Column:
    """What the page's last time element with a date says, as text; NULL if there is none."""
    dates = F.transform(tags(html, "time"), lambda tag: attribute(tag, "datetime"))
    return F.try_element_at(F.filter(dates, lambda text: text.isNotNull()), F.lit(-1))


def iso_date(text: Column) -> Column:
    """The day a text names: 2024-06-15, 20240615, 2024-W24-6, 2024W246, or a week (its Monday); else NULL.

    `text` should be a column of its own, as it is looked at many times.
    """
    plain = F.when(text.rlike(CALENDAR_DATE), F.replace(text, F.lit("-"), F.lit(""))).when(text.rlike(COMPACT_DATE), text)
    day = F.try_to_date(F.when(~plain.startswith("0000"), plain), "yyyyMMdd")

    def part(*groups: int) -> Column:
        return F.concat(*[F.regexp_extract(text, WEEK_DATE, group) for group in groups])

    year, week, weekday = part(1).try_cast("int"), part(2, 4).try_cast("int"), F.coalesce(part(3, 5).try_cast("int"), F.lit(1))
    fourth = F.make_date(F.when(year > 0, year), F.lit(1), F.lit(4))
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    # A week belongs to the year of its Thursday.
    sound = week.between(1, 53) & weekday.between(1, 7) & (F.year(F.date_add(monday, 3)) == year)
    found = F.when(sound, F.date_add(monday, weekday - 1))
    return F.coalesce(day, F.when(F.year(found) <= 9999, found))


def _without_dot_segments(path: Column) -> Column:
    """Resolve '.' and '..' in an absolute path."""
    parts = F.split(path, "/")
    tail = F.element_at(parts, -1)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done))
        .otherwise(F.array_append(done, part)),
    )
    joined = F.array_join(kept, "/")
    return F.when(tail.isin(".", "..") & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolved(base: Column, href: Column) -> Column:
    """Absolute form of a link found on the page at `base`."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, r"[^/]*$", ""))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href.isNull() | base.isNull(), F.lit(None).cast("string"))
        .when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, _without_dot_segments(path), rest))
        .when(href.startswith("?"), F.concat(origin, base_path, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(origin, _without_dot_segments(F.concat(folder, path)), rest))
    )
