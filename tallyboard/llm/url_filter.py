"""URL filter: host and path rules first, then a weighted vocabulary found by Aho-Corasick.

Defined cases: a null url, or one without `://`, has an empty host and path and meets no rule; the
terms are looked for in the whole url, a null one counting as empty. Extra columns are ignored. Repeated rows give repeated results; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyboard.llm.common import prepare, texts_of

# One strict term rejects a url.
STRICT = ("adult", "casino", "escort", "gambling", "hentai", "malware", "phishing", "pills", "porn",
          "porno", "sex", "spam", "viagra", "warez", "xxx")
# So many distinct soft terms reject a url.
SOFT = ("ads", "bet", "bets", "bonus", "buy", "cheap", "click", "credit", "deal", "deals", "discount",
        "farm", "free", "jackpot", "loan", "loans", "lottery", "poker", "promo", "prize", "slots",
        "track", "win", "winner")
SOFT_HITS = 2
# Fixed values: (host suffix, path prefix, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))

RESULT = "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int"
_ASCII_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without `://`."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    cut = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate(_ASCII_LOWER), path[:cut]


def rule_index(rules: Iterable[tuple[str, str, str]]) -> dict[str, list[tuple[str, str, str]]]:
    """Rules by host, longest path first: (path, text, verdict)."""
    index: dict[str, list[tuple[str, str, str]]] = {}
    for host, path, verdict in rules:
        index.setdefault(host, []).append((path, host + path, verdict))
    for entries in index.values():
        entries.sort(key=lambda e: -len(e[0]))
    return index


def best_rule(host: str, path: str, index) -> tuple[str, str] | None:
    """The longest rule whose host is this one or a parent of it and whose path begins this path."""
    found, suffix = None, host
    while suffix:
        for start, text, verdict in index.get(suffix, ()):
            if path.startswith(start) and (found is None or len(text) > len(found[0])):
                found = (text, verdict)
        suffix = suffix.partition(".")[2]
    return found


@lru_cache(maxsize=8)
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for term in soft:
        machine.add_word(term, (term, False))
    for term in strict:
        machine.add_word(term, (term, True))
    machine.make_automaton()
    return machine


def term_hits(url: str, machine: ahocorasick.Automaton) -> tuple[int, int]:
    """Distinct strict and soft terms that stand between characters which are no letters or digits."""
    strict, soft = set(), set()
    text = url.translate(_ASCII_LOWER)
    for last, (term, hard) in machine.iter(text):
        before = last - len(term)
        if (before < 0 or not text[before].isalnum()) and (last + 1 == len(text) or not text[last + 1].isalnum()):
            (strict if hard else soft).add(term)
    return len(strict), len(soft)


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    strict: tuple[str, ...] = STRICT,
    soft: tuple[str, ...] = SOFT,
    soft_needed: int = SOFT_HITS,
) -> DataFrame:
    """One row per page: host, path, the rule met, the verdict and the terms met."""
    rules = tuple(rules)
    prepare(pages.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, machine = rule_index(rules), automaton(tuple(strict), tuple(soft))
        for batch in batches:
            rows = []
            for url in texts_of(batch, "url"):
                host, path = split_url(url)
                hard, weak = term_hits(url or "", machine)
                rule = best_rule(host, path, index)
                own = "block" if hard or weak >= soft_needed else "allow"
                rows.append((host, path, *(rule or (None, own)), hard, weak))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
            ids = batch.column(batch.schema.get_field_index("page_id")).cast(pa.int64())
            names = ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
            yield pa.RecordBatch.from_arrays([ids, *arrays], names=names)

    return pages.select("page_id", "url").mapInArrow(judge, RESULT)
