"""Size-aware set join of documents by shingles: subsets of small sets, inverted lists of large ones.

A document's set holds its distinct shingles of `size` words (A-Z lower-cased); with fewer words the whole
sequence is the one shingle. Two documents link if 100 * intersection >= `percent` * union. Every document
gets the least doc_id that links lead to. All filters below are exact, so no link is lost.

1. **Order.** All shingles are counted in a table of `SLOTS` slots, by hash, in documents. The table is summed on
   the executors and sent back as a level of two bits a slot (32 MB, whatever the input): in one document at most, and
   three degrees of sharing, told by the slot's own load. Shingles are ordered by level and by hash. Any fixed order
   gives right results; this one puts passages that many documents share last.
2. **Classes.** Documents with equal sets (size and two hashes of 64 bits) are one class.
3. **Inverted lists.** Two linked sets share one of the first n - ceil(percent n / 100) + 1 shingles, in that order, of
   either. These prefixes are the inverted lists. Entries of the lowest level have no other document. Those of
   the middle levels, whose lists the level bounds, are sorted by shingle once and lone ones leave; those of the highest
   are taken as they are. So no list is gathered in one task before its size is bounded.
4. **Boundary.** A set of n shingles is linked with one of m if they share a subset of c(n, m) shingles, the overlap
   that the limit asks for. Where n is small these subsets are few. For every boundary up to `LARGEST_SMALL` the
   subsets of the smaller sets and the list entries that the larger sets scan are added up from the counted sets;
   the cheapest boundary is taken.
5. **Small sets**, up to the boundary, enumerate their c(n, m)-subsets for every size m of a partner. Sets of sizes
   n and m that meet in a subset are linked; each side is tied to the least class of the other.
6. **Large sets** scan the lists for partners of any size. In each list, all are paired with the member that meets
   most others. Then components are formed, and in lists that still hold several, members of different
   components are paired; the join itself refutes pairs whose sizes or parity bitmaps (whose differing bits never
   outnumber the differing shingles) rule a link out. Wider bitmaps refute more, and the others are confirmed on
   the full sets. So a group of copies is never expanded into all its pairs.

Defined cases: a text without words (or null) has the empty set and links with nothing. Repeated rows are copies
of each other; a null doc_id counts as the largest; very long texts are read in full. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import mix, prepare, release, stage
from tallyboard.llm.components import components
from tallyboard.llm.near_duplicates import NO_ID, confirmed, row_id, sets_of
from tallyboard.session import shuffle_width

SLOT_BITS, RANGE_BITS = 27, 16
SLOTS, RANGES = 1 << SLOT_BITS, 1 << (SLOT_BITS - RANGE_BITS)
# Shingles that a task gathers before it counts them.
GATHERED = 4_000_000
# The levels: more than one document, and more than these numbers beyond what a slot holds by chance.
SHARED, HOT = 15, 255
LARGEST_SMALL = 24
# Longs of a parity bitmap, and of the one it is folded to while lists are scanned.
LANES, NARROW = 16, 8
_SECOND = np.uint64(0xA0761D6478BD642F)


def overlap(n: int, m: int, percent: int) -> int:
    """The least intersection of linked sets of n and m members."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subsets(n: int, percent: int) -> int:
    """How many subsets a set of n members enumerates."""
    return sum(comb(n, overlap(n, m, percent)) for m in partner_sizes(n, percent) if overlap(n, m, percent) <= n)


def slots_of(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)


def texts_in(documents: DataFrame) -> DataFrame:
    return documents.select(row_id(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("h"), "text")


def levels(table: np.ndarray) -> np.ndarray:
    """How widely the shingles of each slot are shared, 0 to 3, packed four to a byte, from the documents per slot."""
    load = table.mean()
    level = (table > 1).astype(np.uint8) + (table > SHARED + 4 * load) + (table > HOT + 8 * load)
    return (level.reshape(-1, 4).astype(np.uint8) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)


def level_of(packed: np.ndarray, members: np.ndarray) -> np.ndarray:
    slots = slots_of(members)
    return (packed[slots >> 2] >> ((slots & 3) * 2).astype(np.uint8)) & 3


def frequencies(documents: DataFrame, size: int) -> np.ndarray:
    """The packed levels of all slots."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held = [], 0
        for batch in batches:
            for members in sets_of(batch.column(0).to_pylist(), size):
                gathered.append(slots_of(members))
                held += len(members)
                if held >= GATHERED:
                    yield _counted(gathered)
                    gathered, held = [], 0
        if held:
            yield _counted(gathered)

    return slot_table(documents.select("text").mapInArrow(count, COUNTS), levels)


COUNTS = "place int, low binary, counts binary"


def slot_table(parts: DataFrame, finish) -> np.ndarray:
    """Counts per slot, summed over all parts on the executors; `finish` makes bytes of the sums of a range."""

    def add(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        """Sums the counts of each range. Rows come sorted by range, so one range is held, however many a task has."""

        def out() -> pa.RecordBatch:
            at = np.flatnonzero(table)
            low, counts = (b"", finish(table)) if last else (at.astype(np.uint16).tobytes(), table[at])
            columns = [pa.array([held], pa.int32()), pa.array([low], pa.binary()), pa.array([counts.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["place", "low", "counts"])

        held, table = None, np.zeros(1 << RANGE_BITS, dtype=np.uint32)
        for batch in batches:
            for place, low, counts in zip(*batch.columns, strict=True):
                place = place.as_py()
                if place != held and held is not None:
                    yield out()
                    table[:] = 0
                held = place
                table[np.frombuffer(low.as_buffer(), dtype=np.uint16)] += np.frombuffer(counts.as_buffer(), dtype=np.uint32)
        if held is not None:
            yield out()

    def by_range(rows: DataFrame, *others: str) -> DataFrame:
        return rows.repartition("place", *others).select("place", "low", "counts").sortWithinPartitions("place")

    width = shuffle_width(parts.sparkSession) // RANGES
    if width > 1:  # a range is summed in several tasks first
        salted = by_range(parts.withColumn("salt", F.spark_partition_id() % width), "salt")
        parts = salted.mapInArrow(lambda batches: add(batches, False), COUNTS)
    blank = finish(np.zeros(1 << RANGE_BITS, dtype=np.uint32))
    table = np.tile(blank, (RANGES, 1))
    for row in by_range(parts).mapInArrow(lambda batches: add(batches, True), COUNTS).select("place", "counts").collect():
        table[row.place] = np.frombuffer(row.counts, dtype=np.uint8)
    return table.reshape(-1)


def texts_of(documents: DataFrame, firsts: DataFrame) -> DataFrame:
    """(key, text) of the rows `firsts` (id, h, key), written.

    A table of one bit a slot (16 MB, whatever the input) says which hashes of texts are wanted, so that
    other texts are not shuffled; the join decides.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _counted([slots_of(mix(batch.column(0).to_numpy().view(np.uint64)))])

    bits = lambda table: np.packbits(table > 0, bitorder="little")
    wanted = documents.sparkSession.sparkContext.broadcast(slot_table(firsts.select("h").mapInArrow(count, COUNTS), bits))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted.value
        for batch in batches:
            slots = slots_of(mix(batch.column(1).to_numpy().view(np.uint64)))
            yield batch.filter(pa.array((table[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)))

    some = texts_in(documents).mapInArrow(choose, "id long, h long, text string")
    texts = stage(some.join(firsts, ["id", "h"]).dropDuplicates(["key"]).select("key", "text"), "candidate_texts")
    wanted.destroy()  # what needed it is written
    return texts


def _counted(gathered: list[np.ndarray]) -> pa.RecordBatch:
    slots, counts = np.unique(np.concatenate(gathered), return_counts=True)
    cuts = np.searchsorted(slots, np.arange(RANGES + 1, dtype=np.uint64) << np.uint64(RANGE_BITS))
    some = [i for i in range(RANGES) if cuts[i] < cuts[i + 1]]
    low, counts = slots.astype(np.uint16), counts.astype(np.uint32)
    columns = [
        pa.array(some, pa.int32()),
        pa.array([low[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
        pa.array([counts[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["place", "low", "counts"])


def sketches(documents: DataFrame, size: int, percent: int, held) -> DataFrame:
    """One row per document: id, hash of the text, size and two hashes of the set, its prefix in the common order.

    The prefix comes without shingles that no other document has; `hot` says how many at its end are of the highest level.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            sizes, one, two, hot, prefixes = [], [], [], [], []
            for members in sets_of(batch.column(2).to_pylist(), size):
                n = len(members)
                level = level_of(table, members)
                order = np.lexsort((members, level))[: prefix_length(n, percent) if n else 0]
                order = order[level[order] > 0]
                sizes.append(n)
                one.append(int(members.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mix(members * _SECOND).sum(dtype=np.uint64).view(np.int64)))
                hot.append(int((level[order] == 3).sum()))
                prefixes.append(members[order].view(np.int64))
            columns = [pa.array(x, pa.int64()) for x in (sizes, one, two, hot)] + [pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    names = ["id", "h", "n", "k1", "k2", "hot", "prefix"]
    return texts_in(documents).mapInArrow(run, "id long, h long, n long, k1 long, k2 long, hot long, prefix array<long>")


def shared_entries(classes: DataFrame) -> DataFrame:
    """(g, key, n): the list entries of the classes without those that are alone on their list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by g. The last row of a batch waits for the next one.
        waiting, before = None, None
        for batch in batches:
            batch = pa.Table.from_batches([waiting, batch] if waiting is not None else [batch]).combine_chunks().to_batches()[0]
            g = batch.column(0).to_numpy()
            same = g[1:] == g[:-1]
            first = before is not None and before == g[0]
            keep = np.concatenate([[first], same]) | np.concatenate([same, [False]])
            yield batch.slice(0, len(g) - 1).filter(pa.array(keep[:-1]))
            waiting, before = batch.slice(len(g) - 1), (g[-2] if len(g) > 1 else before)
        if waiting is not None and before is not None and before == waiting.column(0)[0].as_py():
            yield waiting

    cold = F.slice("prefix", F.lit(1), (F.size("prefix") - F.col("hot")).cast("int"))
    hot = F.slice("prefix", (F.size("prefix") - F.col("hot") + 1).cast("int"), F.col("hot").cast("int"))
    bounded = classes.select(F.explode(cold).alias("g"), "key", "n").repartition("g").sortWithinPartitions("g")
    return bounded.mapInArrow(run, "g long, key long, n long").union(classes.where("hot > 0").select(F.explode(hot).alias("g"), "key", "n"))


def choose_boundary(spread: DataFrame, percent: int) -> int:
    """The size up to which sets enumerate subsets. `spread`: one row per class with its size and list entries."""
    small = F.when(F.col("n") <= LARGEST_SMALL, F.col("n"))
    rows = spread.groupBy(small.alias("n")).agg(F.count("*").alias("sets"), F.sum("scanned").alias("scanned")).collect()
    # A set is also an entry of its own lists, met or not. Sets beyond `LARGEST_SMALL` cost the same whatever is chosen.
    counts = {r.n: (r.sets, r.scanned + r.sets * prefix_length(r.n, percent)) for r in rows if r.n}
    rest = sum(scanned for _, scanned in counts.values())
    best, cost, enumerated = 0, rest, 0
    for n in range(1, LARGEST_SMALL + 1):
        sets, scanned = counts.get(n, (0, 0))
        enumerated += sets * subsets(n, percent)
        rest -= scanned
        if enumerated + rest <= cost:
            best, cost = n, enumerated + rest
    return best


def small_links(small: DataFrame, texts: DataFrame, size: int, percent: int, boundary: int) -> DataFrame:
    """Links (u, v) among the sets (key, n) up to the boundary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            rows = []
            for key, members in zip(batch.column(0).to_pylist(), sets_of(batch.column(1).to_pylist(), size), strict=True):
                n = len(members)
                for m in partner_sizes(n, percent):
                    c = overlap(n, m, percent)
                    if c > min(n, m) or m > boundary:
                        continue
                    if (n, c) not in places:
                        places[n, c] = np.array(list(combinations(range(n), c)))
                    hashes = mix(mix(members * _SECOND)[places[n, c]].sum(axis=1, dtype=np.uint64)).view(np.int64)
                    rows += [(key, max(n, m), min(n, m), x, n) for x in hashes.tolist()]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "big", "little", "subset", "n"])

    met = small.select("key").join(texts, "key").select("key", "text")
    entries = met.mapInArrow(run, "key long, big long, little long, subset long, n long")
    side = F.col("n") == F.col("big")
    heads = (
        entries.groupBy("big", "little", "subset")
        .agg(F.min(F.when(side, F.col("key"))).alias("a"), F.min(F.when(F.col("n") == F.col("little"), F.col("key"))).alias("b"), F.count("*").alias("size"))
        .where("size > 1 and a is not null and b is not null")
    )
    joined = entries.join(heads, ["big", "little", "subset"])
    # The other side's least class; in a list of one size that is the least of all.
    other = F.when(side, F.col("b")).otherwise(F.col("a"))
    return joined.select(F.col("key").alias("u"), other.alias("v")).where("u <> v").distinct()


def bitmaps(texts: DataFrame, size: int) -> DataFrame:
    """(key, b0, b1, ...): per bit whether an odd number of the set's shingles fall on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lanes = []
            for members in sets_of(batch.column(1).to_pylist(), size):
                odd = np.bincount((mix(members) % np.uint64(64 * LANES)).astype(np.int64), minlength=64 * LANES) & 1
                lanes.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            columns = [pa.array([x[i] for x in lanes], pa.int64()) for i in range(LANES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", *names])

    names = [f"b{i}" for i in range(LANES)]
    return texts.select("key", "text").mapInArrow(run, "key long, " + ", ".join(f"{n} long" for n in names))


def folded(bitmap: DataFrame) -> DataFrame:
    """(key, n, b0, ...) with bitmaps of `NARROW` longs; parities add up when halves are laid over each other."""
    lanes = [F.col(f"b{i}").bitwiseXOR(F.col(f"b{i + NARROW}")).alias(f"b{i}") for i in range(NARROW)]
    return bitmap.select("key", "n", *lanes)


def may_link(a: str, b: str, percent: int, lanes: int = LANES) -> Column:
    """Whether sizes and bitmaps of two sides leave a link possible."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differing = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}.b{i}").bitwiseXOR(F.col(f"{b}.b{i}"))) for i in range(lanes)])
    sizes = (100 * F.least(n, m) >= percent * F.greatest(n, m))
    # intersection = (n + m - differing shingles) / 2
    return sizes & ((100 + percent) * (n + m - differing) >= 2 * percent * (n + m))


def large_links(members: DataFrame, classes: DataFrame, texts: DataFrame, linked: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v) of `linked` and of lists `members` (g, key, n, degree): confirmed links that give all components."""
    best = members.groupBy("g").agg(F.max(F.struct("degree", "key")).getField("key").alias("centre"))
    centres = stage(best, "centres")
    kept = members.select("key").distinct()
    signs = stage(bitmaps(texts.join(kept, "key"), size).join(classes.select("key", "n"), "key"), "bitmaps")

    def possible(pairs: DataFrame) -> DataFrame:
        left, right = signs.withColumnRenamed("key", "u").alias("a"), signs.withColumnRenamed("key", "v").alias("b")
        return pairs.join(left, "u").join(right, "v").where(may_link("a", "b", percent)).select("u", "v")

    stars = (
        members.join(centres, "g")
        .where("key <> centre")
        .groupBy(F.col("key").alias("u"), F.col("centre").alias("v"))
        .agg(F.lit(1).alias("one"))
    )
    links = stage(linked.union(confirmed(possible(stars), texts, size, percent)), "confirmed")
    parts = components(links)

    label = F.coalesce("v", "key").alias("label")
    named = members.join(parts, F.col("key") == F.col("u"), "left").select("g", "key", label)
    split = named.groupBy("g").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("g")
    unsettled = stage(named.join(split, "g").join(centres, "g"), "unsettled")
    main = unsettled.where("key = centre").select("g", F.col("label").alias("main"))
    sides = unsettled.join(main, "g").join(folded(signs), "key").withColumn("outside", F.col("label") != F.col("main"))
    rest = (
        sides.where("outside")
        .alias("a")
        .join(
            sides.where("key <> centre").alias("b"),
            (F.col("a.g") == F.col("b.g"))
            & (F.col("a.label") != F.col("b.label"))
            & (~F.col("b.outside") | (F.col("a.key") < F.col("b.key")))
            & may_link("a", "b", percent, NARROW),
        )
        .groupBy(F.least("a.key", "b.key").alias("u"), F.greatest("a.key", "b.key").alias("v"))
        .agg(F.lit(1).alias("one"))
    )
    return links.union(stage(confirmed(possible(rest), texts, size, percent), "confirmed"))


def groups(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, k1, k2) of all documents and (n, k1, k2, head), the least id that a class leads to."""
    spark = documents.sparkSession
    held = spark.sparkContext.broadcast(frequencies(documents, size))
    sketched = stage(sketches(documents, size, percent, held), "sketches")
    held.destroy()  # what needed it is written
    every = stage(sketched.select("id", "n", "k1", "k2"), "sizes")
    classes = stage(
        sketched.where("n > 0")
        .groupBy("n", "k1", "k2")
        .agg(F.min(F.struct("id", "h")).alias("first"), F.first("prefix").alias("prefix"), F.first("hot").alias("hot"))
        # Fixed by being written.
        .withColumn("key", F.monotonically_increasing_id()),
        "classes",
    )
    release(sketched)
    entries = stage(shared_entries(classes), "entries")
    lengths = entries.groupBy("g").agg(F.count("*").alias("length")).where("length > 1")
    shared = entries.join(lengths, "g")
    scanned = shared.groupBy("key", "n").agg(F.sum("length").alias("scanned"))
    degrees = stage(scanned, "degrees")
    small = classes.where(F.col("n") <= LARGEST_SMALL).select("key", "n")
    boundary = choose_boundary(small.join(degrees, ["key", "n"], "left").union(degrees.where(F.col("n") > LARGEST_SMALL)).na.fill(0), percent)

    wanted = degrees.select("key").union(small.where(F.col("n") <= boundary).select("key")).distinct()
    firsts = classes.select("key", F.col("first.id").alias("id"), F.col("first.h").alias("h")).join(wanted, "key")
    texts = texts_of(documents, firsts)
    linked = small_links(small.where(F.col("n") <= boundary), texts, size, percent, boundary)

    # A list matters if it has a set beyond the boundary; smaller sets can only be partners down to this size.
    least = partner_sizes(boundary + 1, percent).start
    lists = entries.where(F.col("n") >= least)
    beyond = lists.groupBy("g").agg(F.max("n").alias("most"), F.count("*").alias("length")).where((F.col("most") > boundary) & (F.col("length") > 1))
    members = lists.select("g", "key", "n").join(beyond.select("g"), "g").join(degrees.select("key", F.col("scanned").alias("degree")), "key")
    links = large_links(stage(members, "members"), classes, texts, linked, size, percent)
    parts = components(links)
    named = classes.join(parts, F.col("key") == F.col("u"), "left").select("n", "k1", "k2", "first", F.coalesce("v", "key").alias("label"))
    heads = named.groupBy("label").agg(F.min("first").getField("id").alias("head"))
    return every, named.join(heads, "label").select("n", "k1", "k2", "head")


def linked(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, set size, and the least doc_id that links lead to."""
    prepare(documents.sparkSession)
    every, heads = groups(documents, size, percent)
    found = every.join(heads, ["n", "k1", "k2"], "left")
    head = F.coalesce("head", "id")
    real = lambda c: F.when(c != NO_ID, c)
    return found.select(real(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(head).alias("component_id"))
