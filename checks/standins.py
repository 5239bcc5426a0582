"""The given tables recast as competition data.

One SQL text per stand-in serves Spark and the DuckDB oracle, so both sides start from the
same rows. Customers are players, market segments are leagues, months are events, orders are
rounds and order lines are holes. Some customers have no username and some rounds no score.
"""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

SITE = "https://example.org"
AS_OF = date(2001, 8, 1)
PLAN_AS_OF = date(2001, 4, 15)
SEASON = 2001
PAYOUT_FROM_YEAR = 1996
RUN_TIME = datetime(2001, 8, 1)

LEAGUES = """
select c_mktsegment as league_id,
       c_mktsegment || ' league' as league_name,
       ' https://example.org/leagues/' || lower(c_mktsegment) || ' | | https://example.org/more/'
           || lower(c_mktsegment) || '|' as league_urls,
       cast(4 as decimal(10,2)) as league_entry_fee,
       cast(10 as decimal(5,2)) as league_cash_percentage,
       c_mktsegment <> 'FURNITURE' as league_is_handicap,
       cast(3 as bigint) as handicap_minimum_rounds,
       cast(case c_mktsegment when 'BUILDING' then 2 when 'MACHINERY' then 5 else 3 end as bigint)
           as handicap_rounds_considered,
       cast(2 as bigint) as handicap_years_lookback,
       cast(49 as bigint) as handicap_base_score,
       cast(0.8 as decimal(6,3)) as handicap_multiplier,
       timestamp '2001-01-01 00:00:00' as create_time,
       timestamp '2001-01-01 00:00:00' as update_time
from (select distinct c_mktsegment from {customer}) segments
"""

# The same events before the overrides; `month_no` rules the overrides below.
LEAGUE_EVENTS = """
select c_mktsegment || '-' || cast(event_month as string) as event_id,
       c_mktsegment as league_id,
       c_mktsegment || ' ' || cast(event_month as string) as event_name,
       event_month as event_end_date,
       'https://example.org/events/' || c_mktsegment || '-' || cast(event_month as string)
           || '/leaderboard/export' as export_url,
       true as is_downloaded,
       c_mktsegment || '_' || replace(cast(event_month as string), '-', '') || '_20010801_080000.csv' as file_name,
       '/exports/' || c_mktsegment || '.csv' as file_path,
       num_players,
       timestamp '2001-08-01 08:00:00' as download_date,
       month(event_month) % 2 = 0 as is_imported,
       cast(null as timestamp) as import_date,
       false as is_excluded_from_handicap,
       false as is_excluded_from_points,
       false as is_no_handicap_applied,
       cast(null as decimal(6,3)) as points_multiplier,
       cast(null as decimal(10,2)) as buy_in_override_ammt,
       timestamp '2001-01-01 00:00:00' as create_time,
       timestamp '2001-01-01 00:00:00' as update_time
from (select c_mktsegment, cast(date_trunc('month', o_orderdate) as date) as event_month,
             count(*) as num_players
      from {orders} join {customer} on o_custkey = c_custkey
      group by 1, 2) months
"""

EVENT_UPDATES = """
select export_url,
       case when month(event_end_date) % 6 = 0 then true end as is_excluded_from_handicap,
       case when month(event_end_date) % 5 = 0 then true end as is_no_handicap_applied,
       case when month(event_end_date) % 7 = 0 then true end as is_excluded_from_points,
       case when month(event_end_date) = 12 then cast(2 as decimal(6,3)) end as points_multiplier,
       case when month(event_end_date) = 4 then cast(6 as decimal(10,2)) end as buy_in_override_ammt,
       timestamp '2001-01-01 00:00:00' as create_time,
       timestamp '2001-01-01 00:00:00' as update_time
from {league_events}
where month(event_end_date) in (4, 5, 6, 7, 10, 12)
"""

# Every order is a round, in the division of its priority: players have several a month.
RAW_SCORES = """
select cast(o_orderkey as string) as raw_score_id,
       c_mktsegment || '-' || cast(cast(date_trunc('month', o_orderdate) as date) as string) as event_id,
       c_mktsegment as league_id,
       'Division ' || substr(o_orderpriority, 1, 1) as division,
       c_name as player_name,
       case when o_custkey % 50 = 7 then cast(null as string) else cast(o_custkey as string) end as player_username,
       case when o_orderkey % 97 = 5 then cast(null as bigint) else 45 + o_orderkey % 31 end as raw_score,
       timestamp '2001-01-01 00:00:00' as create_time,
       timestamp '2001-01-01 00:00:00' as update_time
from {orders} join {customer} on o_custkey = c_custkey
"""

HOLE_SCORES = """
select cast(l_orderkey as string) || '/' || cast(l_linenumber as string) as hole_score_id,
       cast(l_orderkey as string) as raw_score_id,
       cast(l_linenumber as bigint) as hole_number,
       cast(l_quantity as bigint) as hole_score,
       timestamp '2001-01-01 00:00:00' as create_time,
       timestamp '2001-01-01 00:00:00' as update_time
from {lineitem}
"""

# One export row per order, as text and with the flaws real cells have.
EXPORTS = """
select '/exports/' || c_mktsegment || '-league-' || cast(event_month as string) || '_'
           || replace(cast(event_month as string), '-', '') || '_080000.csv' as file_path,
       cast(o_orderkey as string) as raw_score_id,
       c_mktsegment || '-' || cast(event_month as string) as event_id,
       c_mktsegment as league_id,
       case when o_orderkey % 17 = 0 then ' ' else ' ' || o_orderpriority end as division,
       case when o_orderkey % 19 = 0 then '   ' when o_orderkey % 23 = 0 then cast(null as string)
            else '  ' || c_name || ' ' end as name,
       case when o_orderkey % 29 = 0 then '' else cast(o_custkey as string) end as username,
       case when o_orderkey % 13 = 0 then 'abc' when o_orderkey % 11 = 0 then ''
            when o_orderkey % 7 = 0 then ' ' || cast(45 + o_orderkey % 31 as string) || '.0 '
            when o_orderkey % 5 = 0 then '-' || cast(o_orderkey % 31 as string) || '.75'
            else cast(45 + o_orderkey % 31 as string) end as round_total_score,
       hole_1, hole_2, hole_3, hole_4, hole_5, hole_6, hole_7
from (select o_orderkey, o_custkey, o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as event_month
      from {orders}) dated
join {customer} on o_custkey = c_custkey
left join (
    select l_orderkey,
           cast(cast(sum(case when l_linenumber = 1 then l_quantity end) as bigint) as string) as hole_1,
           cast(cast(sum(case when l_linenumber = 2 then l_quantity end) as bigint) as string) || '.0' as hole_2,
           cast(cast(sum(case when l_linenumber = 3 then l_quantity end) as bigint) % 10 as string) as hole_3,
           cast(cast(sum(case when l_linenumber = 4 then l_quantity end) as bigint) as string) as hole_4,
           cast(cast(sum(case when l_linenumber = 5 then l_quantity end) as bigint) as string) as hole_5,
           cast(cast(sum(case when l_linenumber = 6 then l_quantity end) as bigint) as string) as hole_6,
           case when l_orderkey % 3 = 0 then 'n/a'
                else cast(cast(sum(case when l_linenumber = 7 then l_quantity end) as bigint) as string) end as hole_7
    from {lineitem} group by l_orderkey) lines on l_orderkey = o_orderkey
"""

# The same rows with commas and quotes in cells, and in two leagues with line breaks and blank lines too.
AWKWARD_EXPORTS = """
select league_id, division, name,
       case when league_id not in ('BUILDING', 'MACHINERY') or cast(raw_score_id as bigint) % 3 > 0 then username
            when cast(raw_score_id as bigint) % 2 = 0 then 'two' || chr(10) || 'lines' || chr(10) || chr(10) || 'more, "' || username || '"'
            else '"' || username || chr(10) || '"' end as username,
       case when cast(raw_score_id as bigint) % 4 = 0 then 'say "' || round_total_score || '", so' else round_total_score end
           as round_total_score,
       hole_1, hole_2, hole_3, hole_4, hole_5, hole_6, hole_7
from {exports}
"""

# Links as pages write them: attributes that look like others, every way to quote, character references,
# and what only looks like a link.
AWKWARD_PAGES = """
select page_id, url,
       '<a title="see href=''/events/0' || cast(page_id as string) || '/leaderboard''" href="/events/'
           || cast(page_id as string) || '/leaderboard">a</a>'
           || '<a data-href="/events/no/leaderboard" rel=x' || chr(10) || 'HREF=''/events/' || cast(page_id as string)
           || '/leaderboard?a=1&amp;b=&#50;&#x33;&copy=4&eacute;&lt;''>b</a>'
           || '<img alt="<a href=''/events/no/leaderboard''>"><!-- <a href="/events/no/leaderboard"> -->'
           || '<script>x = "<a href=/events/no/leaderboard>"</script><a class=">" title=''"'' href = /events/'
           || cast(page_id as string) || '/leaderboard/last>c</a>' || html as html
from {pages}
"""

# Every export link, the page it hangs on, and the file it was saved to.
CANDIDATES = """
select export_url, league_id, event_end_date, file_name as file_path from {league_events}
union all
select replace(export_url, '/export', '') as export_url, league_id, event_end_date, file_name as file_path
from {league_events}
"""

# Events of which part is stored already: none of the months after May 2001.
STORED_EVENTS = """
select * from {league_events} where event_end_date < date '2001-06-01'
"""

# League settings as they stand in a config file, in both spellings and with gaps.
CONFIG_CELLS = """
select c_mktsegment as segment,
       case when c_mktsegment < 'F' then ' ' || c_mktsegment || ' ' end as league_name,
       case when c_mktsegment > 'G' then c_mktsegment end as name,
       case when c_mktsegment <> 'MACHINERY' then 'https://example.org/' || c_mktsegment || ' | |x' end as urls,
       cast(players as string) as league_entry_fee,
       case when c_mktsegment > 'B' then 'true' end as league_is_handicap
from (select c_mktsegment, count(*) as players from {customer} group by 1) segments
"""

# Pages whose links lead to leaderboards, with a year label in each link and a date at the end.
EVENT_PAGES = """
select page_id, url,
       replace(replace(html, '<a href="/', '<a href="/events/leaderboard/'), '</a>',
               ' <span class="ml-2 font-normal text-sm text-subtle"> ' || cast(2020 + page_id % 7 as string)
               || ' </span></a>')
           || case when page_id % 3 = 0 then '<time datetime="2024-01-01">start</time><time class="x" datetime="2024-0'
                        || cast(1 + page_id % 9 as string) || '-15">end</time>'
                   when page_id % 3 = 1 then '<time datetime="soon">?</time>' else '' end as html
from {pages}
"""

# Pages with links to leaderboards and with others.
MIXED_PAGES = """
select page_id, url, replace(html, '<a href="/', '<a href="/events/leaderboard/') || html as html from {pages}
"""

TEXTS = {
    "leagues": LEAGUES,
    "league_events": LEAGUE_EVENTS,
    "event_updates": EVENT_UPDATES,
    "raw_scores": RAW_SCORES,
    "hole_scores": HOLE_SCORES,
    "exports": EXPORTS,
    "candidates": CANDIDATES,
    "stored_events": STORED_EVENTS,
    "config_cells": CONFIG_CELLS,
    "awkward_exports": AWKWARD_EXPORTS,
    "awkward_pages": AWKWARD_PAGES,
    "event_pages": EVENT_PAGES,
    "mixed_pages": MIXED_PAGES,
}
GIVEN = ("customer", "orders", "lineitem", "pages", "documents")


def _needs(text: str) -> list[str]:
    return [name for name in (*GIVEN, *TEXTS) if "{" + name + "}" in text]


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def standin(spark: SparkSession, folder: str, name: str, **made: DataFrame) -> DataFrame:
    """A stand-in from its SQL text; `made` are those it builds on that exist already."""
    if name in made:
        return made[name]
    if name in GIVEN:
        return given(spark, folder, name)
    text = TEXTS[name]
    return spark.sql(text, **{need: standin(spark, folder, need, **made) for need in _needs(text)})


def ctes(*names: str) -> str:
    """The named stand-ins and what they need as a WITH list for the oracle."""
    done: dict[str, str] = {}

    def add(name):
        if name in done or name in GIVEN:
            return
        for need in _needs(TEXTS[name]):
            add(need)
        done[name] = f"{name} as (" + TEXTS[name].format(**{n: n for n in (*GIVEN, *TEXTS)}) + ")"

    for name in names:
        add(name)
    return ",\n".join(done.values())
