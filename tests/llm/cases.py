"""Small awkward tables shared by the tests of this folder."""

import re

LONG = " ".join(f"word{i % 977} the of and" for i in range(20_000))
PROSE = "The keeper of the lighthouse wrote down the weather every morning and sent it to the harbour by noon."
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "row string, key string, score double, kept string, w string, s string, h string, id string, found string, text_2 string"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})

DOCUMENTS = [
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),  # a repeated row
    (3, None, "en", "a"),
    (4, "", "de", None),
    (5, " \t\n ", None, "b"),
    (6, "123 456 ... !!!", "en", "b"),
    (7, LONG, "en", "hot"),
    (8, "Die Möwen über dem Hafen schrien, als das Schiff langsam einlief und die Leute am Ufer winkten.", "de", "hot"),
    (8, "Another text under the same number, with enough words in it to be a document by itself.", "en", "hot"),
    (None, PROSE + " Nobody knew why.", "en", "hot"),
    (None, None, None, None),
    (9, "x", "en", "hot"),
    (10, "a <|endoftext|> b", "en", "hot"),
    (11, "\U0001f600 emoji and ünïcödé \u00a0 spaces", "en", "hot"),
]


def documents(spark, rows=None):
    """The rows as a table of documents with more columns, whose names operators may use themselves."""
    rows = DOCUMENTS if rows is None else rows
    full = [(*r, len(r[1]) if r[1] is not None else None, *[None] * 10) for r in rows]
    return spark.createDataFrame(full, f"{SCHEMA}, {EXTRA}")


def empty(spark):
    return documents(spark, [])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def canonical(rows):
    return sorted(map(repr, rows))
