"""Language-model scoring with a log-frequency Bloom filter.

Tokens are the words of a text (A-Z lower-cased) and one end. The base score is a smoothed unigram
model over exact counts. The model is a bigram model over all tokens that backs off to classes: the
`CLASSES` most frequent tokens are a class each, all others share one. Pairs of following tokens and
of following classes are counted over the whole training text (a pair of two tokens with a class of
their own is its class pair), the counts are quantised to levels (1 + floor(2 log2 count)), and a pair
of level q is put into a Bloom filter q times, with its level numbers. The filter is broadcast; a
count is read back by probing level after level until one is missing:

    p(t | h) = a c(h, t) / c(h) + (1 - a) p(class | class of h) p(t | class)
    p(class | x) = a c(x, class) / c(x) + (1 - a) p(class)

The filter takes `BITS_PER_ENTRY` bits an entry up to `MOST_BITS`; if there are more pairs, the most
frequent levels are put in. Word counts are exact: the `FREQUENT` most frequent ones are broadcast (a
fixed bound). All that the broadcasts lack, rarer words and the other pairs, a document's tokens meet
in one shuffled join on the key; the probabilities come back as one sum per document.

Defined cases: a null or empty text is the end alone. Without training rows all counts are 0. Repeated
rows are scored alike, very long texts are read in full; extra columns are ignored; a null doc_id is
never held out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm.common import mix, prepare, stage, text_steps, texts_of, word_hashes
from tallyboard.session import shuffle_width

FREQUENT = 1 << 20
CLASSES = 4095
HISTORY_SHARE = 0.7
LEVELS_PER_DOUBLING = 2
PROBES = 4
BITS_PER_ENTRY = 12
MOST_BITS = 1 << 30
BLOCK_BITS = 1 << 19
MOST_BLOCKS = 1 << 11
READ_AT_ONCE = 1 << 15  # pairs whose levels are read together
UNREAD = 255
INDEX_BITS = 20  # leading bits of a hash that the index of the frequent tokens goes by

END = np.int64(-0x5EED0E5EED0E5EED)  # the hash that stands for the end of a text
START = np.int64(0x57A2757A2757A275)  # and for what stands before the first token


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, each closed by the end, and where each begins (one more entry)."""
    words, starts = word_hashes(texts)
    closed = np.insert(words.view(np.int64), starts[1:], END)
    return closed, starts + np.arange(len(starts))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of counts with the same key; keys ascending."""
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")  # fast where the parts are ascending
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[new], np.add.reduceat(n, new) if len(new) else n


def counted(texts: DataFrame, classes: np.ndarray | None = None) -> DataFrame:
    """Counts over all texts: (key, n) of tokens or, with the classes given, `PACKED` ones of their pairs and class pairs.

    Each task adds up its counts before they are shuffled, in pieces of bounded size.
    """
    sent, parts_of_keys = texts.sparkSession.sparkContext.broadcast(classes), key_parts(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def out(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            if sent.value is not None:
                yield from packed(keys, n, parts_of_keys)
                return
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 100_000]), pa.array(n[i : i + 100_000])], names=["key", "n"])

        for batch in batches:
            for _, step in text_steps(texts_of(batch)):
                found, starts = tokens(step)
                if sent.value is not None:
                    by_class, by_token = pair_keys(found, starts, class_of(found, sent.value))
                    found = np.concatenate([by_class, by_token[by_token != by_class]])
                parts.append(np.unique(found, return_counts=True))
            if sum(len(k) for k, _ in parts) > 4_000_000:
                parts = [_merged(parts)]
                if len(parts[0][0]) > 3_000_000:
                    yield from out(*parts.pop())
        if parts:
            yield from out(*_merged(parts))

    if classes is None:
        return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return summed(texts.select("text").mapInArrow(run, PACKED))


# Keys with the same low bits and their counts in one row, as 64-bit integers.
PACKED = "part int, keys binary, n binary"
# Summed up: with the level of each count in a byte.
LEVELS = "part int, keys binary, levels binary"


def key_parts(spark: SparkSession) -> int:
    """How many parts keys are dealt into, a power of two: several a task, and none of them in two blocks of the filter."""
    return max(MOST_BLOCKS, 1 << (4 * shuffle_width(spark)).bit_length())


def packed(keys: np.ndarray, n: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """`PACKED` rows of the counts, a part each."""
    part = (keys & (parts - 1)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)
    order = np.argsort(part, kind="stable")
    found, sizes = np.unique(part[order], return_counts=True)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    keys, n = keys[order], n[order].astype(np.int64)
    for i in range(0, len(found), 256):
        last = min(i + 256, len(found))
        inside = slice(ends[i], ends[last])
        offsets = pa.py_buffer(((ends[i : last + 1] - ends[i]) * 8).astype(np.int32))
        binary = [pa.Array.from_buffers(pa.binary(), last - i, [None, offsets, pa.py_buffer(x[inside].copy())]) for x in (keys, n)]
        yield pa.RecordBatch.from_arrays([pa.array(found[i:last].astype(np.int32)), *binary], names=["part", "keys", "n"])


def summed(counts: DataFrame) -> DataFrame:
    """`LEVELS` rows of `PACKED` ones. A task holds one part at a time; a part comes in pieces of bounded size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pieces = None, []

        def out() -> Iterator[pa.RecordBatch]:
            keys, n = _merged(pieces)
            for i in range(0, len(keys), 100_000):
                values = [[held], [keys[i : i + 100_000].tobytes()], [level(n[i : i + 100_000]).astype(np.uint8).tobytes()]]
                columns = [pa.array(x, kind) for x, kind in zip(values, (pa.int32(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "keys", "levels"])

        for batch in batches:
            for part, keys, n in zip(*batch.columns, strict=True):
                part = part.as_py()
                if part != held and pieces:
                    yield from out()
                    pieces.clear()
                held = part
                # Copies, so that a piece does not keep its batch.
                pieces.append(tuple(np.frombuffer(x.as_buffer(), dtype=np.int64).copy() for x in (keys, n)))
        if pieces:
            yield from out()

    return counts.repartition("part").sortWithinPartitions("part").mapInArrow(add, LEVELS)


def pairs_by_level(counts: DataFrame) -> dict[int, int]:
    """How many pairs of `LEVELS` rows have each level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for levels in batch.column(0):
                total += np.bincount(np.frombuffer(levels.as_buffer(), dtype=np.uint8), minlength=256)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["level", "pairs"])

    rows = counts.select("levels").mapInArrow(run, "level long, pairs long").groupBy("level").agg(F.sum("pairs").alias("pairs"))
    return {r.level: r.pairs for r in rows.collect()}


def below_level(counts: DataFrame, least: int) -> DataFrame:
    """(key, n) of the pairs of `LEVELS` rows below a level, with the counts that their levels stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, levels in zip(*batch.columns, strict=True):
                keys, levels = np.frombuffer(keys.as_buffer(), dtype=np.int64), np.frombuffer(levels.as_buffer(), dtype=np.uint8)
                some = levels < least
                yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(COUNTS[levels[some]])], names=["key", "n"])

    return counts.select("keys", "levels").mapInArrow(run, "key long, n double")


def class_of(found: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Class numbers of tokens, 0 for the shared class. `classes`: the hashes of the others, ascending."""
    if not len(classes):
        return np.zeros(len(found), dtype=np.int64)
    at = np.minimum(np.searchsorted(classes, found), len(classes) - 1)
    return np.where(classes[at] == found, at + 1, 0)


def pairs(numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Pairs of following classes as one number; before the first token stands a class `CLASSES + 1`."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[starts[:-1]] = CLASSES + 1
    return before * (CLASSES + 2) + numbers


def histories(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The token before each token."""
    before = np.empty_like(found)
    before[1:] = found[:-1]
    before[starts[:-1]] = START
    return before


def pair_keys(found: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of class pairs and of token pairs, the same where both tokens are a class of their own."""
    by_class = pairs(numbers, starts)
    before = histories(found, starts).view(np.uint64)
    by_token = mix(before * np.uint64(0x9E3779B97F4A7C15) + found.view(np.uint64)).view(np.int64)
    return by_class, np.where((numbers > 0) & (by_class >= CLASSES + 2), by_class, by_token)


def level(n: np.ndarray) -> np.ndarray:
    """Quantised counts, 0 for none."""
    return np.where(n > 0, 1 + np.floor(LEVELS_PER_DOUBLING * np.log2(np.maximum(n, 1)) + 1e-9), 0).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of those that have it."""
    low = 2.0 ** ((levels - 1) / LEVELS_PER_DOUBLING)
    return np.where(levels > 0, np.maximum(np.ceil(low), (low + 2.0 ** (levels / LEVELS_PER_DOUBLING) - 1) / 2), 0.0)


COUNTS = count_of(np.arange(64))


def positions(keys: np.ndarray, levels: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of (key, level): the key chooses one block, so that a block can be made by itself."""
    blocks = max(1, bits // BLOCK_BITS)
    width = np.uint64(min(bits, BLOCK_BITS) - 1)
    block = block_of(keys, bits) * np.int64(min(bits, BLOCK_BITS))
    assert blocks * min(bits, BLOCK_BITS) == bits
    h = mix(keys.view(np.uint64) * np.uint64(64) + levels.astype(np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [block + ((h + np.uint64(i) * step) & width).astype(np.int64) for i in range(PROBES)]


def block_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys & np.int64(max(1, bits // BLOCK_BITS) - 1)


@dataclass
class Model:
    """What the workers need: exact counts of frequent tokens, class shares and the filter of pairs."""

    total: int  # training tokens
    distinct: int
    frequent: np.ndarray  # hashes of the most frequent tokens, ascending
    counts: np.ndarray  # and their counts
    classes: np.ndarray  # hashes with a class of their own, ascending
    class_counts: np.ndarray  # by class number; the last is the number of texts
    filter: np.ndarray  # bytes
    bits: int
    whole: bool = True  # whether the filter holds all pairs

    @cached_property
    def index(self) -> np.ndarray:
        """Where the frequent tokens with the same leading bits begin."""
        leading = np.arange(-(1 << (INDEX_BITS - 1)), 1 << (INDEX_BITS - 1)) << (64 - INDEX_BITS)
        return np.searchsorted(self.frequent, leading).astype(np.int32)

    @cached_property
    def numbers(self) -> np.ndarray:
        """Class numbers of the frequent tokens."""
        return class_of(self.frequent, self.classes).astype(np.int16)

    @cached_property
    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probabilities of the frequent tokens in the base model, and the probabilities."""
        logs = self.smoothed(self.counts)
        return logs, 10.0**logs

    def places(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of tokens among the frequent ones, and whether they are there at all."""
        last = len(self.frequent) - 1
        if last < 0:
            return np.zeros(len(found), dtype=np.int64), np.zeros(len(found), dtype=bool)
        at = np.minimum(self.index[(found >> (64 - INDEX_BITS)) + (1 << (INDEX_BITS - 1))], last).astype(np.int64)
        open_ = np.flatnonzero(self.frequent[at] < found)
        while len(open_):
            open_ = open_[at[open_] < last]
            at[open_] += 1
            open_ = open_[self.frequent[at[open_]] < found[open_]]
        return at, self.frequent[at] == found

    def looked_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of tokens: counts (-1 if not frequent), class numbers, log10 base probabilities (0 if not frequent) and probabilities."""
        at, common = self.places(found)
        if not len(self.frequent):
            none = np.zeros(len(found))
            return np.full(len(found), -1, dtype=np.int64), none.astype(np.int64), none, none + 1.0
        logs, shares = self.shares
        return (
            np.where(common, self.counts[at], -1),
            np.where(common, self.numbers[at], 0).astype(np.int64),
            np.where(common, logs[at], 0.0),
            np.where(common, shares[at], 1.0),
        )

    def exact(self, found: np.ndarray) -> np.ndarray:
        """Counts of frequent tokens, -1 for all others."""
        return self.looked_up(found)[0]

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of pairs, read back from the filter level by level."""
        return COUNTS[self.levels(keys)]

    def class_pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of class pairs, which come again and again: levels once read are kept (16 MB)."""
        found = self.class_pair_levels[keys]
        new = np.unique(keys[found == UNREAD])
        if len(new):
            self.class_pair_levels[new] = self.levels(new)
            found = self.class_pair_levels[keys]
        return COUNTS[found]

    @cached_property
    def class_pair_levels(self) -> np.ndarray:
        return np.full((CLASSES + 2) ** 2, UNREAD, dtype=np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of pairs, 0 for those the filter lacks."""
        levels = np.zeros(len(keys), dtype=np.uint8)
        if self.bits:
            for i in range(0, len(keys), READ_AT_ONCE):
                self._read(keys[i : i + READ_AT_ONCE], levels[i : i + READ_AT_ONCE])
        return levels

    def _read(self, keys: np.ndarray, levels: np.ndarray) -> None:
        # The bits are those of `positions`, worked out one after the other.
        width = np.uint64(min(self.bits, BLOCK_BITS) - 1)
        block = block_of(keys, self.bits).view(np.uint64) * (width + np.uint64(1))
        base, open_ = keys.view(np.uint64) * np.uint64(64), np.arange(len(keys))

        def marked(block: np.ndarray, h: np.ndarray) -> np.ndarray:
            at = ((h & width) + block).view(np.int64)
            return (self.filter[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)).view(bool)

        q = 1
        while len(open_) and q < 64:
            h = mix(base + np.uint64(q))
            # Most keys that lack a level fail at its first probe; only the others are probed on.
            left = np.flatnonzero(marked(block, h))
            base, block, open_, h = base[left], block[left], open_[left], h[left]
            step = (h >> np.uint64(32)) | np.uint64(1)
            seen = np.ones(len(left), dtype=bool)
            for _ in range(1, PROBES):
                h += step
                seen &= marked(block, h)
            if not seen.all():
                base, block, open_ = base[seen], block[seen], open_[seen]
            levels[open_] = q
            q += 1

    def smoothed(self, n: np.ndarray) -> np.ndarray:
        """The base model's log10 probability of tokens seen so often."""
        return np.log10((n + 1.0) / (self.total + 1.0 * (self.distinct + 1)))


def learn(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the training texts, and the counts (key, n) of the words and pairs it does not hold.

    Which count makes a word frequent follows from a histogram in eighths of a doubling, so that the
    frequent ones are never more than `FREQUENT`; which level puts a pair into the filter, from a
    histogram of the levels.
    """
    words = stage(counted(training), "token_counts")
    eighth = F.floor(8 * F.log2(F.col("n")) + 1e-9)
    bins = words.groupBy(eighth.alias("bin")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    bins.sort(key=lambda r: -r.bin)
    total, distinct = sum(r.n for r in bins), sum(r.words for r in bins)
    least, room = bins[0].bin + 1 if bins else 0, FREQUENT
    for row in bins:
        room -= row.words
        if room < 0:
            break
        least = row.bin
    frequent = words.where(eighth >= least).toArrow()
    keys, n = frequent.column("key").to_numpy(), frequent.column("n").to_numpy()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    own = np.sort(np.lexsort((keys, -n))[:CLASSES])
    class_counts = np.zeros(CLASSES + 2)
    class_counts[1 : len(own) + 1] = n[own]
    class_counts[0] = total - class_counts.sum()
    ends = words.where(F.col("key") == int(END)).first()
    class_counts[-1] = ends.n if ends else 0
    pair_counts = stage(counted(training, keys[own]), "pair_counts")
    levels = pairs_by_level(pair_counts)
    least_level, room = 1, MOST_BITS // BITS_PER_ENTRY
    for q in sorted(levels, reverse=True):
        room -= q * levels[q]
        if room < 0:
            least_level = q + 1
            break
    entries = sum(q * n for q, n in levels.items() if q >= least_level)
    bits, made = filter_of(pair_counts, entries, least_level)
    model = Model(total, distinct, keys, n, keys[own], class_counts, made, bits, room >= 0)
    rest = words.where(eighth < least).select("key", F.col("n").cast("double").alias("n"))
    return model, rest if model.whole else rest.unionByName(below_level(pair_counts, least_level))


def distinct_pairs(keys: np.ndarray, texts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the distinct keys: where one stands, how often it does, and where each text begins."""
    order = np.lexsort((keys, texts))
    text, key = texts[order], keys[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])])[: len(key)])
    times = np.diff(np.append(new, len(key)))
    return order[new], times, np.searchsorted(text[new], np.arange(rows + 1))


def build_filter(counts: DataFrame) -> tuple[int, np.ndarray]:
    """The filter of counts (key, n), whatever their number allows."""
    parts = key_parts(counts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from packed(batch.column(0).to_numpy(), batch.column(1).to_numpy(), parts)

    table = summed(counts.select("key", "n").mapInArrow(run, PACKED))
    return filter_of(table, sum(q * n for q, n in pairs_by_level(table).items()))


def filter_of(counts: DataFrame, entries: int, least: int = 1) -> tuple[int, np.ndarray]:
    """The filter of `LEVELS` rows from a level on: its size follows the entries; tasks make blocks, which are put together."""
    if not entries:
        return 0, np.zeros(0, dtype=np.uint8)
    bits = min(MOST_BITS, 1 << int(np.ceil(np.log2(entries * BITS_PER_ENTRY))))
    inside = min(bits, BLOCK_BITS)
    size = inside // 8

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for keys, levels in zip(*batch.columns, strict=True):
                keys, levels = np.frombuffer(keys.as_buffer(), dtype=np.int64), np.frombuffer(levels.as_buffer(), dtype=np.uint8)
                some = levels >= least
                keys, levels = keys[some], levels[some].astype(np.int64)
                if not len(keys):
                    continue
                block = int(block_of(keys[:1], bits)[0])  # all keys of a part go to one
                ends = np.cumsum(levels)
                numbers = np.arange(1, ends[-1] + 1) - np.repeat(ends - levels, levels)  # 1 up to the level of each key
                marks = np.zeros(inside, dtype=bool)
                for at in positions(np.repeat(keys, levels), numbers, bits):
                    marks[at & (inside - 1)] = True
                marks = np.packbits(marks, bitorder="little")
                made[block] = made[block] | marks if block in made else marks
        for block in sorted(made):
            yield pa.RecordBatch.from_pydict({"block": [block], "made": [made[block].tobytes()]})

    blocks = stage(counts.select("keys", "levels").mapInArrow(fill, "block long, made binary"), "blocks")
    made = np.zeros(bits // 8, dtype=np.uint8)
    for row in blocks.toLocalIterator():
        made[row.block * size : (row.block + 1) * size] |= np.frombuffer(row.made, dtype=np.uint8)
    return bits, made


# What the probability of a token depends on. Each has a key; its value is null until the join gives it.
PARTS = ("pair", "class_pair", "history", "token")
# Besides: how often the pair stands in the text, the count and share that its classes have, and whether the token shares its class.
OPEN = {
    **{f"{part}_key": pa.int64() for part in PARTS},
    **{part: pa.float64() for part in PARTS},
    "times": pa.float64(), "class_history": pa.float64(), "class_share": pa.float64(), "shared": pa.bool_(),
}


def probability(pair, class_pair, history, base, class_history, class_share, shared, shared_share, choose, least):
    """p(t | h) as in the head of this module, of arrays or columns. `base`: the token's own probability."""
    of_class = HISTORY_SHARE * least(class_pair / class_history) + (1 - HISTORY_SHARE) * class_share
    of_class = choose(class_history > 0, of_class, class_share)
    back = choose(shared, of_class * base / shared_share, of_class)
    return choose(history > 0, HISTORY_SHARE * least(pair / history) + (1 - HISTORY_SHARE) * back, back)


def score(documents: DataFrame, training: DataFrame) -> DataFrame:
    """One row per document: exact counts, the base score and the model's log10 probability.

    Every row gets a number of its own, so that the sums of its open tokens, those with a part that the
    broadcasts lack, come back to it. A row with no open token takes no part in the join.
    """
    spark = prepare(documents.sparkSession)
    model, rest = learn(training)
    sent = spark.sparkContext.broadcast(model)
    open_type = pa.list_(pa.struct(list(OPEN.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        class_share = (m.class_counts + 1) / (m.total + len(m.class_counts))
        for batch in batches:
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            columns: list[list] = [[], [], [], [], []]
            for _, step in text_steps(at["text"].to_pylist()):
                found, starts = tokens(step)
                texts = np.repeat(np.arange(len(step)), np.diff(starts))
                exact, numbers, base, share = m.looked_up(found)
                common = exact >= 0
                by_class, by_token = pair_keys(found, starts, numbers)
                class_pair = m.class_pair_counts(by_class)
                pair = class_pair.copy()
                mixed = np.flatnonzero(by_token != by_class)
                pair[mixed] = m.pair_counts(by_token[mixed])
                before = histories(found, starts)
                history = np.append(0.0, exact[:-1])
                history[starts[:-1]] = m.class_counts[-1]
                class_history = m.class_counts[by_class // (CLASSES + 2)]
                lacking = {
                    "pair": (pair == 0) & (not m.whole),
                    "class_pair": (class_pair == 0) & (not m.whole),
                    "history": history < 0,
                    "token": ~common,
                }
                is_open = np.logical_or.reduce(list(lacking.values()))
                with np.errstate(divide="ignore", invalid="ignore"):
                    p = probability(
                        pair, class_pair, history, share, class_history, class_share[numbers], numbers == 0,
                        class_share[0], np.where, lambda x: np.minimum(x, 1.0),
                    )
                own = np.where(is_open, 0.0, np.log10(np.where(is_open, 1.0, p)))
                add = lambda values, n=len(step), t=texts: np.bincount(t, weights=values, minlength=n)
                places = np.flatnonzero(is_open)
                first, times, begins = distinct_pairs(by_token[places], texts[places], len(step))
                places = places[first]
                keys = {"pair": by_token, "class_pair": by_class, "history": before, "token": found}
                values = {"pair": pair, "class_pair": class_pair, "history": history, "token": exact}
                sent_parts = [pa.array(keys[x][places], mask=~lacking[x][places]) for x in PARTS]
                sent_parts += [pa.array(values[x][places].astype(float), mask=lacking[x][places]) for x in PARTS]
                sent_parts += [pa.array(times.astype(float)), pa.array(class_history[places]), pa.array(class_share[numbers[places]])]
                sent_parts.append(pa.array(numbers[places] == 0))
                columns[0] += np.diff(starts).tolist()
                columns[1] += add((exact > 0).astype(float)).astype(np.int64).tolist()
                columns[2] += add(base).tolist()
                columns[3] += add(own).tolist()
                inside = pa.StructArray.from_arrays(sent_parts, names=list(OPEN))
                columns[4].append(pa.ListArray.from_arrays(pa.array(begins, pa.int32()), inside))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            opened = pa.concat_arrays(columns.pop()) if columns[4] else pa.array([], open_type)
            yield pa.RecordBatch.from_arrays(
                [at["row"], at["doc_id"], at["held_out"], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], opened],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "own", "open"],
            )

    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    names = {pa.int64(): "bigint", pa.float64(): "double", pa.bool_(): "boolean"}
    inside = ", ".join(f"{name}: {names[kind]}" for name, kind in OPEN.items())
    scored = stage(
        rows.mapInArrow(
            run,
            "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, own double, "
            f"open array<struct<{inside}>>",
        ),
        "scored",
    )
    # One row for each part that an open token lacks; then the token is put together again.
    opened = scored.select("row", F.posexplode("open").alias("slot", "o")).select("row", "slot", "o.*")
    asked = F.array(*[F.struct(F.lit(i).alias("part"), F.col(f"{part}_key").alias("key")) for i, part in enumerate(PARTS)])
    wanted = opened.withColumn("ask", F.explode(F.filter(asked, lambda x: x.key.isNotNull())))
    wanted = wanted.withColumns({"part": F.col("ask.part"), "key": F.col("ask.key")}).drop("ask", *[f"{x}_key" for x in PARTS])
    given = {x: F.when(F.col("part") == i, F.coalesce("n", F.lit(0.0))).otherwise(F.col(x)) for i, x in enumerate(PARTS)}
    put = (
        wanted.join(rest, "key", "left")
        .groupBy("row", "slot")
        .agg(
            *[F.max(value).alias(x) for x, value in given.items()],
            *[F.max(x).alias(x) for x in ("times", "class_history", "class_share", "shared")],
            F.max(F.col("part") == PARTS.index("token")).alias("rare"),
        )
    )
    base = (F.col("token") + 1.0) / F.lit(model.total + 1.0 * (model.distinct + 1))
    shared_share = float((model.class_counts[0] + 1) / (model.total + len(model.class_counts)))
    p = probability(
        *[F.col(x) for x in ("pair", "class_pair", "history")], base, F.col("class_history"), F.col("class_share"), F.col("shared"),
        F.lit(shared_share), lambda test, a, b: F.when(test, a).otherwise(b), lambda x: F.least(x, F.lit(1.0)),
    )
    sums = put.groupBy("row").agg(
        F.sum(F.when(F.col("rare"), F.col("times") * F.log10(base))).alias("more_base"),
        F.sum(F.when(F.col("rare") & (F.col("token") > 0), F.col("times"))).cast("long").alias("known"),
        F.sum(F.col("times") * F.log10(p)).alias("more"),
    )
    return scored.drop("open").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("own") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
