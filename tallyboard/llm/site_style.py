"""Article text of web pages by a site style tree.

The pages of a host are merged: elements with the same path (tags and classes from the root) are one
node. Its presentation importance is the entropy of the sequences of elements found right inside it,
over the pages and relative to log(pages). The importance of a content is 1 - log(d) / log(m), if it
stands at its path on d of the host's m pages: 0 if all pages show it, 1 if one does. A branch weighs
(1 - G) * presentation + G * mean importance of the contents below it. Pages with the same article
count once, so copies of an article don't make it a template.

From each page come the blocks of its article (`article`, `main` and the like; else the whole body)
without elements that a tag, role, class or id names as something else, without branches of low
importance, and without contents of low importance. A content goes only if it also stands on a fixed
share of the host's pages, `MOST_PAGES` of them inside a marked article and `HALF` elsewhere, however
many pages there are. A branch of low weight goes as a whole, inside a marked article too, if every
content below it stands on `HALF` of the pages and there are `LEAST_CONTENTS` of them: a box that many
articles carry is no part of them, a single line that many share may be. Elsewhere menus go too: blocks
that are mostly links, paragraphs and headings only if they are several links and nothing else. Hosts with fewer than `LEAST_PAGES` different pages are not judged by the tree.

Host statistics are counted in Spark, on hashes. Only nodes and contents of low importance go back to
the pages, one row per host, by a join on the host; one page has few blocks, so the contents on most
pages of a host are few.

Defined cases: a null or empty html gives an empty text, a null url the empty host. Markup that is cut
off or not closed ends with the page. Repeated rows give repeated results; very long pages are read in
full; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import prepare, stage
from tallyboard.llm.page_blocks import Block, blocks

LEAST_PAGES = 8
G = 0.9
IN_ARTICLE = 0.05  # importance below which a content of an article goes
ELSEWHERE = 0.4
LOW_BRANCH = 0.1
LEAST_CONTENTS = 2  # different contents below a branch that goes by its weight
MOST_PAGES, HALF = 0.95, 0.5  # shares of the pages that a content stands on at least to go, in an article and elsewhere
MOSTLY_LINKS = 0.6

RESULT = "page_id long, url string, text string, n_chars long"
CONTENT, STYLE = 0, 1


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def candidates(found: list[Block]) -> list[Block]:
    """The blocks that may be the article's: those in a marked article, else all but menus."""
    return [b for b in found if b.main] or [b for b in found if not menu(b)]


def menu(b: Block) -> bool:
    """Whether a block is mostly links; in prose only if it is several links and nothing but signs between them."""
    return b.linked > MOSTLY_LINKS * len(b.text) and (not b.prose or b.links > 1 and not b.bare)


def nodes(pages: DataFrame) -> DataFrame:
    """(host, path, kind, what, page): the contents and the style of every node, a page by its article."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in ("host", "path", "kind", "what", "page")}
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, elements = blocks(source)
                kept = candidates(found)
                page = digest("\n".join(b.text for b in kept))
                entries = {(b.path, CONTENT, digest(b.text)) for b in kept}
                used = {p for b in kept for p in ancestors(b.path)}
                entries |= {(path, STYLE, digest(inside)) for path, inside in elements if path in used}
                for path, kind, what in sorted(entries):
                    for name, value in zip(rows, (host, path, kind, what, page), strict=True):
                        rows[name].append(value)
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], k) for n, k in zip(rows, kinds, strict=True)], names=list(rows))

    schema = "host string, path string, kind int, what long, page long"
    return pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, schema)


def ancestors(path: str) -> list[str]:
    """The path and all above it."""
    steps = path.split("/")
    return ["/".join(steps[: i + 1]) for i in range(len(steps))]


def low_nodes(pages: DataFrame) -> DataFrame:
    """One row per host: the branches and (path, content) pairs of low importance."""
    # Written, as three aggregates read it: the pages are taken apart once for all of them.
    seen = stage(nodes(pages).distinct(), "nodes")
    counted = seen.groupBy("host", "path", "kind", "what").agg(F.count("*").alias("d"))
    # Pages of a host: a page has one style of the root, so the root's styles count them.
    # Written, so that its size is known: one row per host is broadcast, and the nodes of a large host stay spread.
    size = stage(seen.groupBy("host").agg(F.count_distinct("page").alias("m")).where(F.col("m") >= LEAST_PAGES), "sizes")
    judged = counted.join(size, "host")
    content = judged.where(F.col("kind") == CONTENT).withColumn("importance", 1 - F.log("d") / F.log("m"))
    content = content.withColumn("share", F.col("d") / F.col("m"))
    above = F.transform(F.sequence(F.lit(1), F.size("steps")), lambda i: F.array_join(F.slice("steps", F.lit(1), i), "/"))
    below = (
        content.withColumn("steps", F.split("path", "/"))
        .select("host", F.explode(above).alias("path"), "importance", "d", "share")
        .groupBy("host", "path")
        .agg(
            (F.sum(F.col("importance") * F.col("d")) / F.sum("d")).alias("content"),
            F.max("importance").alias("importance"),
            F.min("share").alias("share"),
            F.count("*").alias("contents"),
        )
    )
    share = F.col("d") / F.col("m")
    style = (
        judged.where(F.col("kind") == STYLE)
        .groupBy("host", "path")
        .agg((F.sum(-share * F.log(share)) / F.log(F.first("m"))).alias("style"))
    )
    weight = (1 - G) * F.least(F.coalesce("style", F.lit(0.0)), F.lit(1.0)) + G * F.col("content")
    branches = below.join(style, ["host", "path"], "left").where(weight < LOW_BRANCH)
    branches = branches.where((F.col("importance") < ELSEWHERE) & (F.col("share") >= HALF))
    few = content.where((F.col("importance") < ELSEWHERE) & (F.col("share") >= HALF))
    return (
        branches.select("host", "path", F.lit(None).cast("long").alias("what"), "importance", "share", "contents")
        .unionByName(few.select("host", "path", "what", "importance", "share", F.lit(1).cast("long").alias("contents")))
        .groupBy("host")
        .agg(F.collect_list(F.struct("path", "what", "importance", "share", "contents")).alias("low"))
    )


def article(source: str | None, low: list | None) -> str:
    """The text of a page's article: its blocks, one a line.

    What most of a marked article's text consists of is no template: such pages are near copies.
    """
    kept = candidates(blocks(source)[0])
    entries = {(x["path"], x["what"]): (x["importance"], x["share"]) for x in low or () if x["what"] is not None}
    branches = {x["path"] for x in low or () if x["what"] is None and x["contents"] >= LEAST_CONTENTS}

    def goes(b: Block) -> bool:
        limit, least = (IN_ARTICLE, MOST_PAGES) if b.main else (ELSEWHERE, HALF)
        importance, share = entries.get((b.path, digest(b.text)), (1.0, 0.0))
        return importance < limit and share >= least or any(p in branches for p in ancestors(b.path))

    lines = [b for b in kept if not entries or not goes(b)]
    if kept and kept[0].main and 2 * sum(len(b.text) for b in lines) < sum(len(b.text) for b in kept):
        lines = kept
    return "\n".join(b.text for b in lines)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: the text of its article and how many code points it has."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [article(s, low) for s, low in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes)],
                names=["page_id", "url", "text", "n_chars"],
            )

    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    # Written first, so that its size is known: then pages move only if it is too large to broadcast.
    low = stage(low_nodes(pages), "low_nodes")
    return whole.join(low, "host", "left").select("page_id", "url", "html", "low").mapInArrow(run, RESULT)
