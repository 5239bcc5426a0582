"""Column expressions that clean text cells. No Python runs per row."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide which cells, columns and file names are recognised.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
FILE_STAMP = r"[-_](\d{4}-\d{2}-\d{2}|\d{8})_(\d{8}_\d{6})$"
HOLE_COLUMN = r"^hole_(\d+)$"
LAST_HOLE = 36
TRUE_WORDS = ("1", "true", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "no", "n", "off")
LIST_SEPARATOR = "|"


def stripped(text: Column) -> Column:
    return F.btrim(text.cast("string"), F.lit(WHITESPACE))


def to_text(cell: Column) -> Column:
    """Stripped text; blank cells become NULL."""
    text = stripped(cell)
    return F.when(text != "", text)


def to_int(cell: Column) -> Column:
    """Whole part of a numeric cell; NULL when blank, not a number or out of range."""
    text = stripped(cell)
    return F.when(text.rlike(NUMBER), text).try_cast("double").try_cast("bigint")


def to_flag(cell: Column, default: bool | None = False) -> Column:
    """Yes/no words as booleans, anything else as the default."""
    word = F.lower(stripped(cell))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default).cast("boolean"))
    )


def split_list(text: Column) -> Column:
    """A delimited string as an array of its non-blank, stripped parts; NULL gives an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), re.escape(LIST_SEPARATOR))
    return F.filter(F.transform(parts, stripped), lambda part: part != "")


def join_list(parts: Column) -> Column:
    """The inverse of split_list for an array; a NULL array stays NULL."""
    kept = F.filter(F.transform(parts, stripped), lambda part: part != "")
    return F.when(parts.isNotNull(), F.array_join(kept, LIST_SEPARATOR))


def plain_path(path: Column, is_uri: Column | None = None) -> Column:
    """One form for the paths of files: URIs decoded, local ones without their scheme.

    Without `is_uri` a path counts as URI if it begins with a scheme. A plus stays a plus.
    """
    has_scheme = path.rlike("^[A-Za-z][A-Za-z0-9+.-]*:/") if is_uri is None else is_uri
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.when(has_scheme, F.coalesce(decoded, path)).otherwise(path), "^file:/+", "/")


def file_stem(path: Column) -> Column:
    """Last path segment without its extension."""
    name = F.substring_index(path, "/", -1)
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def event_name(path: Column) -> Column:
    """Readable name of an export file: no time stamp, hyphens as spaces."""
    bare = F.regexp_replace(file_stem(path), FILE_STAMP, "")
    return stripped(F.translate(bare, "-", " "))


def download_time(path: Column) -> Column:
    """Time stamp at the end of an export file name, NULL if absent or not a real time."""
    stamp = F.regexp_extract(file_stem(path), FILE_STAMP, 2)
    return F.try_to_timestamp(F.when(stamp != "", stamp), F.lit("yyyyMMdd_HHmmss"))


def hole_number(column_name: Column) -> Column:
    """Number of a hole column, NULL for other columns and for numbers out of range."""
    digits = F.regexp_extract(F.lower(stripped(column_name)), HOLE_COLUMN, 1)
    number = F.when(digits != "", digits).try_cast("bigint")
    return F.when(number.between(1, LAST_HOLE), number)


def column_key(header: Column) -> Column:
    """Normalised header: lower case, only letters, digits and underscores."""
    return F.regexp_replace(F.lower(header), "[^a-z0-9_]", "")
