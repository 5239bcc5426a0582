"""Quality rules: base rules on each text and log-likelihood ratios of hashed n-grams.

Everything is DataFrame code. Two kinds of n-gram are hashed into buckets: pairs of following word
shapes (a run of small letters is a, of capitals A, of letters without case o, of digits 0, other
characters are as they are), which tell what a text is made of, and the lower-cased words themselves,
which tell lists of words from prose. For each kind two multinomials are learned: the trusted target
from all documents labelled good (with `PRIOR` n-grams of the raw corpus, so that a few of them say
little), the raw corpus from all documents. A ratio of a document is the mean of
log(p_target / p_raw) over its n-grams of a kind.

`score` is the ratio of the shapes; it has to reach `THRESHOLD`. `word_score` is that of the words. What
prose scores there depends on the size of the vocabulary, so the words of half of the trusted documents
are not learned from but set the limit: as far below the lowest `LIMIT_SHARE` of their scores as that is
below their median.

The texts are taken apart once: counts and buckets are written to the shared folder, and learning, the
limit and the verdicts read them there. Labels meet document numbers only, in a join of narrow rows;
what comes of it is two bits a row, `ROWS_PER_MARK` rows to one mark, which go back to the buckets in a
join that Spark broadcasts if they are small and shuffles otherwise. No number of labels is a limit.

Defined cases: a null or empty text has no words, fails the base rules and has scores 0. Without
trusted documents every score is 0; without any for the limit, no text falls below it. Conflicting
labels count as the worst. Repeated rows are judged alike, very long texts are read in full. Extra
columns, whatever their names, are left out by `judge` and kept by `keep_good`. An empty table gives an
empty result.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import prepare, stage

BUCKETS = 1 << 14  # of pairs of shapes
WORD_BUCKETS = 1 << 18
LEVELS = 127  # that the weights of words are rounded to
PRIOR = 1000.0  # n-grams drawn like the raw corpus that are added to the target
THRESHOLD = -0.3
LIMIT_SHARE = 0.01
MARK_BITS = 6
ROWS_PER_MARK = 1 << MARK_BITS  # bits of a long
PARTS = 1024  # of a level, that scores are rounded to for the limit
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
WINDOW = 5

SPACES = " \t\n\x0b\f\r"
SPLIT = "[ \\t-\\r]+"
SYMBOLS = "[#*$%&|<>]+"
# Kinds of character that a shape keeps as one: (pattern, sign).
KINDS = (("\\p{Ll}+", "a"), ("\\p{Lu}+", "A"), ("[\\p{Lo}\\p{Lm}\\p{M}]+", "o"), ("[0-9]+", "0"))
NO_LONGS = "array<bigint>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    """The words of a text, none for a null one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT))


def reduced(text: Column) -> Column:
    """The text with its words as shapes. Small letters come first: most of a text is shorter after that."""
    return reduce(lambda t, kind: F.regexp_replace(t, kind[0], kind[1]), KINDS, text)


def tail(values: Column) -> Column:
    """All but the first."""
    return F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))


def buckets(shape: Column) -> Column:
    """The buckets of the pairs of following shapes; the last one is paired with null."""
    return F.zip_with(shape, tail(shape), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))


def word_buckets(found: Column) -> Column:
    """The buckets of the words, in lower case."""
    return F.transform(found, lambda w: F.pmod(F.xxhash64(F.lower(w)), F.lit(WORD_BUCKETS)).cast("int"))


def window_hashes(found: Column) -> Column:
    """64-bit hashes of all windows of five words."""
    first = F.sequence(F.lit(0), F.greatest(F.size(found) - WINDOW, F.lit(0)))
    hashes = F.transform(first, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(WINDOW)]))
    return F.when(F.size(found) >= WINDOW, hashes).otherwise(F.array().cast(NO_LONGS))


def in_order(hashes: Column) -> Column:
    """(hash, place) ascending; nothing for a text whose windows all differ."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), pairs).otherwise(none)


def repeated(ordered: Column) -> Column:
    """The places, ascending, whose hash a neighbour in order shares."""
    none = F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(None).cast("int").alias("i"))
    after = F.zip_with(ordered, tail(ordered), lambda a, b: F.struct(a.h.alias("h"), a.i.alias("i"), (a.h == b.h).alias("same")))
    before = F.slice(F.concat(F.array(none), ordered), F.lit(1), F.size(ordered))
    places = F.zip_with(after, before, lambda a, b: F.when(a.same | (a.h == b.h), a.i))
    return F.sort_array(F.array_compact(places))


def covered(places: Column) -> Column:
    """How many words the windows at these ascending places cover together."""
    own = F.zip_with(places, tail(places), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, n: total + n)


def features(text: Column, table: DataFrame) -> DataFrame:
    """The table with the base counts of a text column added."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    plain = F.coalesce(text, F.lit(""))
    return (
        table.withColumn("w", words(text))
        .withColumn("lines", lines)
        .withColumn("hashes", window_hashes(F.col("w")))
        .withColumn("ordered", in_order(F.col("hashes")))
        .withColumn("places", repeated(F.col("ordered")))
        .withColumns(
            {
                "n_words": F.size("w").cast("bigint"),
                "word_chars": F.length(F.array_join("w", "")).cast("bigint"),
                "n_symbols": (F.length(plain) - F.length(F.regexp_replace(plain, SYMBOLS, ""))).cast("bigint"),
                "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
                "n_repeat_words": settled(covered(F.col("places"))),
            }
        )
    )


def settled(value: Column) -> Column:
    """The value, in a form that filters are not moved below.

    Spark moves a filter down by writing the columns it tests out in full. Here each of them is built
    on several uses of the one before, so the condition would grow beyond measure.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents labelled good; `apart`: not for the target of the words."""
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    apart = F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(2)) == 1
    return good.where("quality = 1").select("doc_id", F.lit(True).alias("good"), apart.alias("apart"))


@dataclass(frozen=True)
class Weights:
    """log(p_target / p_raw) of every bucket, and the least ratio of the words that is kept.

    Those of the words are levels, a byte each: 0 stands for `low`, each further one for `step` more.
    """

    shapes: list[float]
    words: bytes
    low: float
    step: float
    limit: float = float("-inf")

    def of_shapes(self, found: Column, count: Column) -> Column:
        """The mean weight, 0 of none. The weights are one folded constant of `BUCKETS` numbers."""
        weight = F.from_json(F.lit(json.dumps(self.shapes)), "array<double>")
        total = F.aggregate(found, F.lit(0.0), lambda a, b: a + F.get(weight, b))
        return F.coalesce(F.when(count > 0, total / count), F.lit(0.0))

    def levels(self, found: Column) -> Column:
        """The sum of the levels of words. The levels are one folded constant of `WORD_BUCKETS` numbers."""
        level = F.from_json(F.lit(json.dumps([*self.words], separators=(",", ":"))), "array<tinyint>")
        return F.aggregate(found, F.lit(0).cast("bigint"), lambda a, b: a + F.get(level, b - BUCKETS))

    def of_words(self, found: Column, count: Column) -> Column:
        """The mean weight, 0 of none."""
        return F.coalesce(F.when(count > 0, self.low + self.step * self.levels(found) / count), F.lit(0.0))


def taken_apart(table: DataFrame, text: Column) -> DataFrame:
    """The table without its text, written once, with a number of each row, base counts and the buckets.

    Those of shapes are `s`, those of words `w`; the latter follow the former.
    """
    names = [c for c in table.columns if c != "text"]
    # A column of its own, as `words` looks at its text more than once.
    counted = features(text, table).withColumn("reduced", reduced(text)).withColumn("shape", words(F.col("reduced")))
    parts = counted.select(
        *names, *COUNTS, F.monotonically_increasing_id().alias("at"),
        buckets(F.col("shape")).alias("s"),
        F.transform(word_buckets(F.col("w")), lambda b: b + BUCKETS).alias("w"),
    )
    return stage(parts, "quality")


def marked(parts: DataFrame, doc_id: Column, labels: DataFrame) -> DataFrame:
    """What `taken_apart` gives with `good` and `apart` of the row's label."""
    mark, place = F.shiftright("at", MARK_BITS).alias("mark"), F.pmod("at", F.lit(ROWS_PER_MARK)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place"))
    found = (
        parts.select(mark, place.alias("place"), doc_id.alias("doc_id"))
        .join(trusted_ids(labels), "doc_id")
        .groupBy("mark")
        .agg(F.bit_or(bit).alias("goods"), F.bit_or(F.when(F.col("apart"), bit).otherwise(0)).alias("aparts"))
    )
    # Written, so that its size is known: then the buckets move only if it is too large to broadcast.
    marks = stage(found, "trusted")
    held = {"good": "goods", "apart": "aparts"}
    flags = [F.coalesce(F.getbit(bits, place) == 1, F.lit(False)).alias(name) for name, bits in held.items()]
    return parts.withColumn("mark", mark).join(marks, "mark", "left").select(*parts.columns, *flags)


def ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The weights of buckets by their counts. A bucket that no document shows counts as one without target."""
    if not target.sum():
        return np.zeros(len(raw))
    share = raw / raw.sum()
    known = np.where(raw > 0, share, 1.0)
    learned = np.log((target + PRIOR * share) / (target.sum() + PRIOR), where=raw > 0, out=np.zeros(len(raw))) - np.log(known)
    return np.round(np.where(raw > 0, learned, np.log(PRIOR / (target.sum() + PRIOR))), 6)


def learn(parts: DataFrame, doc_id: Column, labels: DataFrame) -> Weights:
    """Both kinds of n-gram counted over all documents, reduced per bucket, and the limit of the words.

    The driver gets a row per bucket. For the limit scores are counted by their value in parts of a level.
    """
    known = marked(parts, doc_id, labels)
    for_target = F.col("good") & ((F.col("b") < BUCKETS) | ~F.col("apart"))
    counted = (
        known.select("good", "apart", F.explode(F.concat("s", "w")).alias("b"))
        .groupBy("b")
        .agg(F.count("*").alias("raw"), F.count_if(for_target).alias("target"))
        .toArrow()
    )
    raw, target = np.zeros((2, BUCKETS + WORD_BUCKETS))
    raw[counted["b"].to_numpy()], target[counted["b"].to_numpy()] = counted["raw"].to_numpy(), counted["target"].to_numpy()
    of_shapes, of_words = ratios(raw[:BUCKETS], target[:BUCKETS]), ratios(raw[BUCKETS:], target[BUCKETS:])
    low = float(of_words.min())
    step = float(of_words.max() - low) / LEVELS
    levels = np.rint((of_words - low) / step) if step else np.zeros(WORD_BUCKETS)
    learned = Weights(of_shapes.tolist(), levels.astype(np.uint8).tobytes(), low, step)
    others = known.where(F.col("apart") & (F.col("n_words") >= LEAST_WORDS))
    mean = F.round(PARTS * learned.levels(F.col("w")) / F.col("n_words")).cast("bigint")
    found = (
        others.groupBy(mean.alias("mean"))
        .agg(F.count("*").alias("n"))
        .select(F.percentile("mean", F.array(F.lit(LIMIT_SHARE), F.lit(0.5)), F.col("n")))
        .first()[0]
    )
    if not found:
        return learned
    lowest, middle = (low + step * x / PARTS for x in found)
    return replace(learned, limit=2 * lowest - middle)


def weights(documents: DataFrame, labels: DataFrame) -> Weights:
    """What the documents and their labels teach."""
    parts = taken_apart(documents.select("doc_id", "text"), F.col("text"))
    return learn(parts, F.col("doc_id"), labels)


def with_ratios(parts: DataFrame, learned: Weights) -> DataFrame:
    """What `taken_apart` gives with `score` and `word_score` added."""
    return parts.withColumns(
        {
            "score": settled(learned.of_shapes(F.col("s"), F.col("n_words"))),
            "word_score": settled(learned.of_words(F.col("w"), F.col("n_words"))),
        }
    )


def passed(learned: Weights, threshold: float) -> Column:
    return settled(~base_failed() & (F.col("score") >= threshold) & (F.col("word_score") >= learned.limit))


def judge(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the base counts, the score and whether it is kept."""
    prepare(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = taken_apart(texts, F.col("text"))
    learned = learn(parts, F.col("doc_id"), labels)
    return with_ratios(parts, learned).select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), "score", "word_score", passed(learned, threshold).alias("kept")
    )


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they are, that pass the base rules and both thresholds."""
    prepare(documents.sparkSession)
    whole = documents.select(F.struct("*").alias("row"))
    parts = taken_apart(whole, F.col("row.text"))
    learned = learn(parts, F.col("row.doc_id"), labels)
    return with_ratios(parts, learned).select("row", passed(learned, threshold).alias("kept")).where("kept").select("row.*")
