"""Language identification by bit-sliced Bloom filters of character n-grams.

Each slot of one shared table holds a mask with a bit per language. An n-gram is added by setting its
language's bit in `PROBES` slots; a look-up takes the AND of the slots, so it returns all languages
that may contain the n-gram at once. Per document, the bits of all look-ups are counted per language,
and the counts are corrected for the share of look-ups that hit by chance.

An n-gram is four code points of a lower-cased text that begin inside or just before a word, with all
that are not letters read as one kind of gap; behind a one-letter word the rest is blank.

Defined cases: `und` with score 0 where text is null or has no letter, or where nothing could be
learned; a text of unknown n-grams gets the first learned language with score 0. Ties go to the
first language in order. Rows without lang or text are not learned from. Very long texts are read in
full. Extra columns are kept out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import BYTES_PER_STEP, mix, prepare, texts_of

PROBES = 3
MASK_BITS = 64
SLOTS_PER_GRAM = 12
# About so many documents of each language are learned from, dealt by a hash of doc_id; then so many n-grams a language.
LEARN_FROM = 24_000
GRAMS = 200_000
# An n-gram counts for a language if it is seen so often there, and not much rarer than elsewhere.
LEAST_COUNT = 5
LEAST_RATE = 0.34
KNOWN = 0.35  # the least share of known n-grams of an accepted text

RESULT = "doc_id long, held_out boolean, lang_pred string, score double, known double"


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the document is kept from learning; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, 0 where no letter stands, and where each text begins."""
    lowered = [(t or "").lower() + "\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), dtype=np.uint32)
    begins = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
    return np.where(_letters()[points], points, np.uint32(0)), begins


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts, and where each text's n-grams begin (one more entry)."""
    c, begins = codes(texts)
    w = np.concatenate([[0], c, [0, 0, 0]]).astype(np.uint64)
    a, b, d, e = w[:-3], w[1:-2], w[2:-1], w[3:]
    inside = d > 0
    wanted = (b > 0) & (inside | (a == 0))
    keep = np.flatnonzero(wanted)
    key = (a << np.uint64(21)) ^ b
    key = key * np.uint64(0x9E3779B97F4A7C15) ^ (d << np.uint64(21)) ^ np.where(inside, e, np.uint64(0))
    return mix(key[keep]), np.searchsorted(keep, begins)


def steps(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """The texts in steps of bounded size, each with its first row."""
    first, size, step = 0, 0, []
    for i, text in enumerate(texts):
        if step and size + len(text or "") > BYTES_PER_STEP:
            yield first, step
            first, size, step = i, 0, []
        step.append(text)
        size += len(text or "")
    if step:
        yield first, step


@dataclass
class Model:
    """Languages in order and the table of their masks; beyond 64, `more` has one for each further 64."""

    languages: list[str]
    table: np.ndarray
    more: list[np.ndarray] = field(default_factory=list)

    def bits(self) -> Iterator[tuple[int, np.ndarray, np.generic]]:
        """Per language: its number, its table and its place in a mask."""
        tables = [self.table, *self.more]
        for i in range(len(self.languages)):
            table = tables[i // MASK_BITS]
            yield i, table, table.dtype.type(i % MASK_BITS)

    def slots(self, hashes: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(len(self.table) - 1)
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return [((hashes + np.uint64(i) * step) & size).astype(np.int64) for i in range(PROBES)]

    def chance(self) -> np.ndarray:
        """Per language, how likely a look-up of a foreign n-gram hits."""
        fill = np.array([np.mean((table >> place) & table.dtype.type(1)) for _, table, place in self.bits()])
        return fill**PROBES

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits per text and language, and the number of n-grams per text."""
        hashes, begins = grams(texts)
        total = np.diff(begins)
        at = self.slots(hashes)
        hits = np.zeros((len(texts), len(self.languages)))
        for i, table, place in self.bits():
            if place == 0:
                masks = np.bitwise_and.reduce([table[slots] for slots in at])
            run = np.concatenate([[0], np.cumsum((masks >> place) & table.dtype.type(1), dtype=np.int64)])
            hits[:, i] = run[begins[1:]] - run[begins[:-1]]
        chance = self.chance()
        return np.maximum(0, (hits - total[:, None] * chance) / np.maximum(1e-9, 1 - chance)), total


def learn(documents: DataFrame, lang: str = "lang", learn_from: int = LEARN_FROM) -> Model | None:
    """The filters of the languages of the given rows, learned from about `learn_from` rows of each.

    A language with fewer rows is learned from all of them, however many rows the others have.
    Counting is spread over the tasks and reduced per n-gram; the driver gets at most `GRAMS`
    n-grams of each language.
    """
    usable = documents.where(F.col(lang).isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r["count"] for r in usable.groupBy(F.col(lang).alias("lang")).count().collect()}
    if not sizes:
        return None
    parts = {code: int(learn_from / n * (1 << 40)) for code, n in sizes.items() if n > learn_from}
    chosen = F.lit(True)
    if parts:
        limit = F.create_map(*[F.lit(x) for code in sorted(parts) for x in (code, parts[code])])[F.col(lang)]
        chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.coalesce(limit, F.lit(1 << 40))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def shrink(lang: str) -> None:
            keys = np.concatenate([k for k, _ in held[lang]])
            values = np.concatenate([v for _, v in held[lang]])
            unique, at = np.unique(keys, return_inverse=True)
            held[lang] = [(unique, np.bincount(at, weights=values).astype(np.int64))]

        for batch in batches:
            langs = texts_of(batch, "lang")
            texts = texts_of(batch)
            for code in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == code]
                for _, step in steps(own):
                    held.setdefault(code, []).append(np.unique(grams(step)[0], return_counts=True))
                    if len(held[code]) > 16:
                        shrink(code)
        for code in sorted(held):
            shrink(code)
            keys, values = held[code][0]
            for i in range(0, len(keys), 50_000):
                part = keys[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([code] * len(part)), pa.array(part.view(np.int64)), pa.array(values[i : i + 50_000])],
                    names=["lang", "gram", "n"],
                )

    counted = (
        usable.where(chosen)
        .select(F.col(lang).alias("lang"), "text")
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("gram", "lang")
        .agg(F.sum("n").alias("n"))
        .groupBy("gram")
        .agg(F.collect_list(F.struct("lang", "n")).alias("langs"))  # one entry per language
        .persist()
    )
    try:
        per_lang = counted.select(F.explode("langs").alias("l")).groupBy("l.lang").agg(F.sum("l.n").alias("n"))
        totals = {r.lang: r.n for r in per_lang.collect()}
        if not totals:  # texts without letters only
            first, *more = [np.zeros(2, dtype=np.uint64) for _ in range(0, len(sizes), MASK_BITS)]
            return Model(sorted(sizes), first, more)
        total = F.create_map(*[x for lang in sorted(totals) for x in (F.lit(lang), F.lit(float(totals[lang])))])
        rated = counted.select("gram", F.transform("langs", lambda l: F.struct(
            l.lang.alias("lang"), l.n.alias("n"), (l.n / total[l.lang]).alias("rate"))).alias("langs"))
        best = F.array_max(F.transform("langs", lambda l: l.rate))
        good = F.filter("langs", lambda l: (l.n >= LEAST_COUNT) & (l.rate >= LEAST_RATE * best))
        chosen_grams = rated.select("gram", F.explode(good).alias("l")).select("gram", "l.lang", "l.n")
        languages = sorted(totals)
        found = []
        for i, code in enumerate(languages):
            most_seen = chosen_grams.where(F.col("lang") == code).orderBy(F.desc("n"), "gram").limit(GRAMS)
            found.append((i, [r.gram for r in most_seen.collect()]))
    finally:
        counted.unpersist()
    most = max((len(keys) for _, keys in found), default=0)
    slots = 1 << max(10, int(np.ceil(np.log2(max(1, most) * SLOTS_PER_GRAM))))
    kind = next((k for k in (np.uint8, np.uint16, np.uint32) if len(languages) <= np.iinfo(k).bits), np.uint64)
    first, *more = [np.zeros(slots, dtype=kind) for _ in range(0, len(languages), MASK_BITS)]
    model = Model(languages, first, more)
    for (_, table, place), (_, keys) in zip(model.bits(), found, strict=True):
        for at in model.slots(np.array(keys, dtype=np.int64).view(np.uint64)):
            np.bitwise_or.at(table, at, kind(1) << place)
    return model


def judge(model: Model | None, texts: list[str | None]) -> list[tuple[str, float, float]]:
    """Per text: the language, its share of all corrected hits, and the share of n-grams it knows."""
    result = []
    for _, step in steps(texts):
        if model is None:
            result += [("und", 0.0, 0.0)] * len(step)
            continue
        hits, total = model.counts(step)
        for row, n in zip(hits, total, strict=True):
            if not n:
                result.append(("und", 0.0, 0.0))
                continue
            best = int(np.argmax(row))
            everything = row.sum()
            score = float(row[best] / everything) if everything else 0.0
            result.append((model.languages[best], score, float(min(1.0, row[best] / n))))
    return result


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """Language, score and share of known n-grams of every document."""
    prepare(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge(sent.value, texts_of(batch)) or []
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                 pa.array(columns[2], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score", "known"],
            )

    ids = F.col("doc_id").cast("long")
    return documents.select(ids.alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, RESULT)


def identify(documents: DataFrame) -> DataFrame:
    """Learn from all but the held-out fold, then predict every document."""
    prepare(documents.sparkSession)
    return predict(documents, learn(documents.where(~held_out(F.col("doc_id")))))


def keep_known(documents: DataFrame, least: float = KNOWN) -> DataFrame:
    """The documents, all columns as they are, whose language is recognised.

    Rejected are those without letters and those of whose n-grams less than `least` belong to the
    best language.
    """
    prepare(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(learn(documents.where(~held_out(F.col("doc_id")))))
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge(sent.value, batch.column(at).to_pylist())
            yield batch.filter(pa.array([lang != "und" and known >= least for lang, _, known in found], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
