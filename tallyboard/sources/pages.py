"""Event and export links from fetched web pages (`page_id`, `url`, `html`)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.html import dated_hrefs, hrefs, iso_date, label_places, last_time, resolved, schedule_marks

# Which links lead to events and leaderboards.
EVENT_PATH = "/events"
LEADERBOARD_PATH = "/leaderboard"


def _first_seen(links: DataFrame, page: list[str], link: str) -> DataFrame:
    """Each link of a page once, with the place it first appears."""
    return links.groupBy(*page, link).agg(F.min("position").cast("bigint").alias("position"))


def page_links(pages: DataFrame, prefix: str = EVENT_PATH, part: str = LEADERBOARD_PATH) -> DataFrame:
    """Distinct links of each page that start with `prefix` and contain `part`."""
    found = pages.select("page_id", F.posexplode(hrefs(F.col("html"))).alias("position", "link"))
    return _first_seen(found.where(F.col("link").startswith(prefix) & F.contains("link", F.lit(part))), ["page_id"], "link")


def event_links(pages: DataFrame, site: str, first_year: int) -> DataFrame:
    """Event leaderboards on schedule pages whose year label is recent enough, as full URLs."""
    marked = pages.select("page_id", schedule_marks(F.col("html")).alias("marks"))
    placed = marked.select("page_id", "marks", label_places(F.col("marks")).alias("places"))
    dated = dated_hrefs(F.col("marks"), F.col("places"))
    found = placed.select("page_id", F.posexplode(dated).alias("position", "found"))
    link = F.col("found.href")
    recent = found.where(
        link.startswith(EVENT_PATH) & F.contains(link, F.lit(LEADERBOARD_PATH)) & (F.col("found.year") >= first_year)
    ).withColumn("url", F.concat(F.lit(site), link))
    return _first_seen(recent, ["page_id"], "url")


def resolved_links(pages: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Distinct leaderboard links of each page as absolute URLs; `wanted` is a condition on `link`."""
    if wanted is None:
        wanted = F.contains("link", F.lit(EVENT_PATH)) & F.contains("link", F.lit(LEADERBOARD_PATH))
    found = pages.select("page_id", "url", F.posexplode(hrefs(F.col("html"))).alias("position", "link"))
    absolute = found.where(wanted).withColumn("export_url", resolved(F.col("url"), F.col("link")))
    return _first_seen(absolute, ["page_id"], "export_url")


def page_end_dates(pages: DataFrame) -> DataFrame:
    """End date of the event each page shows."""
    found = pages.select("page_id", last_time(F.col("html")).alias("told"))
    return found.select("page_id", iso_date(F.col("told")).alias("event_end_date"))
