"""How the sources of a language differ from it and from each other, by their term frequencies.

Terms are the longest runs of letters A-Z, a-z and non-ASCII characters, A-Z lower-cased. A language keeps the
terms found in at least `LEAST_DOCUMENTS` of its documents. Every (language, source) group and every language
gives each of the V kept terms p = 1 + floor(10^9 * (count + 5) / (N + 5 V)), N being its count of kept terms.
Part `pair` sums |p - q| over the kept terms between a source and each other one of the language; part `term`
lists the terms that a source uses most above its language. All arithmetic is on integers.

1. Each task takes a few megabytes of text at a time and cuts it into terms, all at once. Terms of up to 8 bytes
   become one 64-bit word and of up to 16 bytes two, padded with zero bytes, so that words compare as the
   terms do; they are sorted by stable passes over 16 bits (numpy's radix sort). Longer terms are put into one
   bucket per length and sorted as bytes. Documents are taken group by group, so the runs of equal terms
   give counts and documents per group; only these leave the task, one row per group and term.
2. Counts are summed, documents summed per language and term, rare terms go.
3. For the pairs, the kept terms are dealt into blocks of about `BLOCK_TERMS` and the sources into tiles of about
   `TILE_SOURCES`. One task takes the counts of one block for two tiles as a matrix and gives sums per pair of
   sources; a term that neither source of a pair has adds a constant, worked out at the end.

So a group of any size is counted before it is shuffled, and what a task holds is bounded by the chunk of text
(or its longest single text) and by one block of two tiles.

Defined cases: null text, lang or source are ''. A group without terms has count 0 for each kept term. A
language without kept terms has pairs with value 0 and no terms. Repeated rows are documents of their own; very
long texts and terms are counted whole. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm.common import prepare, stage

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
UNIT, PRIOR = 1_000_000_000, 5
CHUNK_BYTES = 12_000_000
BLOCK_TERMS = 4096
TILE_SOURCES = 256

_IN_TERM = np.array([i >= 128 or chr(i).isalpha() for i in range(256)])


def term_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms begin and how long they are; the last byte is no part of a term."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _IN_TERM[data]]).astype(np.int8)))
    return edge[0::2], edge[1::2] - edge[0::2]


def packed_words(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first `lengths` (1 to 8) bytes from each place as one word; the first byte weighs most."""
    # Words at every byte: `data` has 8 more bytes than the last place.
    at_bytes = np.ndarray(shape=(len(data) - 8,), dtype=">u8", buffer=data, strides=(1,))
    spare = (np.uint64(8) * (8 - lengths).astype(np.uint64)).astype(np.uint64)
    return (at_bytes[begins].astype(np.uint64) >> spare) << spare


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by their words, the first word weighing most, 16 bits a pass."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digits = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digits) and digits.min() != digits.max():
                order = order[np.argsort(digits[order], kind="stable")]
    return order


def _runs(order: np.ndarray, fresh: np.ndarray, groups: np.ndarray, texts: np.ndarray):
    """Runs of equal terms of one group: (first token, group, count, documents). `fresh` marks new terms in order."""
    group, text = groups[order], texts[order]
    new_group = fresh.copy()
    new_group[1:] |= group[1:] != group[:-1]
    new_text = new_group.copy()
    new_text[1:] |= text[1:] != text[:-1]
    heads = np.flatnonzero(new_group)
    counts = np.diff(np.concatenate([heads, [len(order)]]))
    return order[heads], group[heads], counts, np.add.reduceat(new_text.astype(np.int64), heads)


def _fresh(columns: list[np.ndarray]) -> np.ndarray:
    fresh = np.ones(len(columns[0]), dtype=bool)
    fresh[1:] = False
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
    return fresh


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, groups, counts, documents) of lower-cased texts that are ordered by group, bucket by bucket."""
    data = np.frombuffer(b" ".join(texts) + b" " * 24, dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    begins, lengths = term_places(data)
    text_of = np.searchsorted(np.cumsum(sizes), begins, side="right")
    for least, most in ((1, 8), (9, 16)):
        own = np.flatnonzero((lengths >= least) & (lengths <= most))
        if not len(own):
            continue
        words = [packed_words(data, begins[own], np.minimum(lengths[own], 8))]
        if most == 16:
            words.append(packed_words(data, begins[own] + 8, lengths[own] - 8))
        order = radix_order(words)
        heads, group, counts, documents = _runs(order, _fresh([w[order] for w in words]), groups[text_of[own]], text_of[own])
        joined = np.stack([w[heads] for w in words], axis=1).astype(">u8")
        yield joined.view(f"S{most}")[:, 0].tolist(), group, counts, documents
    long = np.flatnonzero(lengths > 16)
    long = long[np.argsort(lengths[long], kind="stable")]
    cuts = np.flatnonzero(np.diff(lengths[long])) + 1
    for own in np.split(long, cuts) if len(long) else []:
        size = int(lengths[own[0]])
        terms = np.array([data[b : b + size].tobytes() for b in begins[own].tolist()], dtype=f"S{size}")
        order = np.argsort(terms, kind="stable")
        heads, group, counts, documents = _runs(order, _fresh([terms[order]]), groups[text_of[own]], text_of[own])
        yield terms[heads].tolist(), group, counts, documents


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed per chunk of a task."""

    def flush(rows: list[tuple[str, str, bytes]]) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: r[:2])
        names = sorted({r[:2] for r in rows})
        codes = {name: i for i, name in enumerate(names)}
        groups = np.fromiter((codes[r[:2]] for r in rows), dtype=np.int64, count=len(rows))
        langs, sources = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))
        for terms, group, counts, held in count_terms([r[2] for r in rows], groups):
            at = pa.array(group)
            columns = [langs.take(at), sources.take(at), pa.array(terms, pa.binary()), pa.array(counts), pa.array(held)]
            whole = pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            for first in range(0, len(terms), 50_000):
                yield whole.slice(first, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode("utf-8").lower()
                if rows and size + len(raw) > CHUNK_BYTES:
                    yield from flush(rows)
                    rows, size = [], 0
                rows.append((lang, source, raw))
                size += len(raw)
        if rows:
            yield from flush(rows)

    read = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return read.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), as an integer."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = (wide(count) + PRIOR) * F.lit(UNIT).cast("decimal(10,0)")
    under = wide(total) + wide(terms) * F.lit(PRIOR).cast("decimal(1,0)")
    return F.call_function("div", top, under) + 1


def kept_counts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n) of the kept terms; (lang, source, total, terms, base) of every group."""
    counted = stage(
        term_counts(documents).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "term_counts",
    )
    frequent = counted.groupBy("lang", "term").agg(F.sum("docs").alias("held")).where(F.col("held") >= LEAST_DOCUMENTS)
    kept = counted.join(frequent.select("lang", "term"), ["lang", "term"])
    kept = stage(kept.select("lang", "source", F.col("term").cast("string").alias("term"), "n"), "kept_counts")
    sizes = kept.groupBy("lang").agg(F.count_distinct("term").alias("terms"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = (
        every.join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))
    )
    base = F.when(F.col("terms") > 0, probability(F.lit(0), F.col("total"), F.col("terms")))
    return kept, stage(groups.withColumn("base", base), "groups")


def distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value): sum of |p - q| over the kept terms for every two sources of a language."""
    tile = F.pmod(F.xxhash64("source"), F.col("tiles"))
    shape = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / TILE_SOURCES).alias("tiles"),
        F.greatest(F.ceil(F.max("terms") / BLOCK_TERMS), F.lit(1)).alias("blocks"),
    )
    members = groups.join(shape, "lang").withColumn("tile", tile)
    counts = kept.join(members, ["lang", "source"]).select(
        "lang", "source", "tiles", "tile", "term", "base",
        probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"),
    )
    heads = members.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang", "source", "tiles", "tile", F.lit(None).cast("string").alias("term"), "base", F.col("base").alias("p"), "block"
    )

    def run(key: tuple, table: pa.Table) -> pa.Table:
        names = table.column("source").combine_chunks().dictionary_encode()
        sources, place = names.dictionary, names.indices.to_numpy(zero_copy_only=False)
        terms = table.column("term").combine_chunks().dictionary_encode()
        at = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        base = np.zeros(len(sources), dtype=np.int64)
        base[place] = table.column("base").fill_null(0).to_numpy()
        p = np.repeat(base[:, None], len(terms.dictionary), axis=1)
        p[place[at >= 0], at[at >= 0]] = table.column("p").fill_null(0).to_numpy()[at >= 0]
        first, second, sums = [], [], []
        for i in range(len(sources)):
            step = np.abs(p[i] - p).sum(axis=1) - len(terms.dictionary) * np.abs(base[i] - base)
            first.append(np.full(len(sources), i))
            second.append(np.arange(len(sources)))
            sums.append(step)
        first, second, sums = (np.concatenate(x) for x in (first, second, sums))
        # Two sources of one tile meet in the group (a, a) only.
        if key[1].as_py() != key[2].as_py():
            in_a = np.zeros(len(sources), dtype=bool)
            in_a[place] = table.column("mine").to_numpy()
            apart = in_a[first] != in_a[second]
        else:
            apart = first != second
        first, second = (sources.take(pa.array(x[apart])) for x in (first, second))
        lang = pa.array([key[0].as_py()] * len(first), pa.string())
        return pa.table({"lang": lang, "source": first, "other": second, "more": pa.array(sums[apart], pa.int64())})

    rows = spread_with_side(counts.unionByName(heads))
    parts = rows.groupBy("lang", "a", "b", "block").applyInArrow(run, "lang string, source string, other string, more long")
    summed = parts.groupBy("lang", "source", "other").agg(F.sum("more").alias("more"))
    one = groups.select("lang", "source", F.col("base").alias("own"), "terms")
    two = groups.select("lang", F.col("source").alias("other"), F.col("base").alias("theirs"))
    value = F.when(F.col("terms") > 0, F.col("more") + F.col("terms") * F.abs(F.col("own") - F.col("theirs"))).otherwise(0)
    return summed.join(one, ["lang", "source"]).join(two, ["lang", "other"]).select("lang", "source", "other", value.alias("value"))


def spread_with_side(rows: DataFrame) -> DataFrame:
    """The rows once per tile that theirs meets: tiles (a, b) with a <= b, and whether the row is of a."""
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    a, b = F.least("tile", "other"), F.greatest("tile", "other")
    return met.select(
        "lang", a.alias("a"), b.alias("b"), "block", "source", "term", "p", "base", (F.col("tile") == a).alias("mine")
    )


def audit(documents: DataFrame) -> DataFrame:
    """The report: (lang, source, part, item, value, rank)."""
    prepare(documents.sparkSession)
    kept, groups = kept_counts(documents)
    per_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    report = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]

    pairs = distances(kept, groups).withColumnRenamed("other", "item").withColumn("part", F.lit("pair"))
    pairs = pairs.withColumn("rank", F.row_number().over(per_source)).select(*report)

    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.max("terms").alias("terms"))
    general = (
        kept.groupBy("lang", "term")
        .agg(F.sum("n").alias("n"))
        .join(of_lang, "lang")
        .select("lang", "term", probability(F.col("n"), F.col("all"), F.col("terms")).alias("q"))
    )
    terms = (
        kept.join(groups, ["lang", "source"])
        .withColumn("p", probability(F.col("n"), F.col("total"), F.col("terms")))
        .join(general, ["lang", "term"])
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    )
    terms = terms.withColumn("rank", F.row_number().over(per_source)).where(F.col("rank") <= TOP_TERMS).select(*report)
    return pairs.unionByName(terms)
