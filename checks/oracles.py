"""DuckDB queries that work out each registered result another way.

Windows run over raw rows, histories are self joins, and money is whole numbers, where the
Spark side aggregates first, slides over slots and uses decimals.
"""

from checks.standins import AS_OF, PAYOUT_FROM_YEAR, PLAN_AS_OF, SEASON, ctes

LIVE_EVENTS = """
live_events as (
    select event_id, league_id, event_name, event_end_date, export_url,
           coalesce(u.is_excluded_from_handicap, false) as off_handicap,
           coalesce(u.is_no_handicap_applied, false) as no_handicap,
           coalesce(u.is_excluded_from_points, false) as off_points,
           u.points_multiplier, u.buy_in_override_ammt
    from league_events left join event_updates u using (export_url))
"""

SCOPE = f"""
scope as (
    select s.raw_score_id, s.raw_score, s.league_id, s.player_username as player, e.event_end_date as day,
           not e.off_handicap as counts, not e.no_handicap as receives,
           g.handicap_minimum_rounds as needed, g.handicap_rounds_considered as depth,
           g.handicap_base_score as base, g.handicap_multiplier as factor
    from raw_scores s, live_events e, leagues g
    where s.event_id = e.event_id and s.league_id = g.league_id and g.league_is_handicap
      and year(e.event_end_date) >= {AS_OF.year} - g.handicap_years_lookback)
"""

HISTORY = """
history as (
    select r.raw_score_id, c.raw_score as used, c.day as used_day,
           row_number() over (partition by r.raw_score_id order by c.day desc, c.raw_score_id desc) as recency,
           r.depth
    from scope r join scope c on c.counts and c.league_id = r.league_id and c.player = r.player and c.day <= r.day
    where r.receives),
earlier as (
    select r.raw_score_id, count(c.raw_score_id) as n
    from scope r left join scope c
      on c.counts and c.league_id = r.league_id and c.player = r.player and c.day < r.day
    where r.receives group by 1)
"""

HANDICAPS = """
formed as (
    select raw_score_id, avg(used) as mean_used,
           string_agg(cast(used as varchar), ',' order by recency) as listed
    from history where recency <= depth group by 1),
led as (
    select r.*, f.listed,
           case when e.n < r.needed - 1 then 0
                when f.mean_used is not null
                then greatest(cast(round((f.mean_used - r.base) * cast(r.factor as double)) as bigint), 0) end as next_one
    from formed f join scope r using (raw_score_id) join earlier e using (raw_score_id)),
handicap_table as (
    select raw_score_id, raw_score, league_id, player, day, next_one, listed,
           last_value(next_one ignore nulls) over past as carried,
           last_value(listed ignore nulls) over past as carried_list,
           count(*) over (partition by league_id, player)
               - row_number() over (partition by league_id, player order by day, raw_score_id) + 1 as recency
    from led
    window past as (partition by league_id, player order by day, raw_score_id
                    rows between unbounded preceding and 1 preceding))
"""

# Shares in billionths and money in whole numbers keep the oracle exact.
LADDER = """
ladder_weights as (
    select n, p, pow(cast(0.64 as double), p - 1) as weight
    from range(1, 101) fields(n), range(1, 35) places(p) where p <= ceil(n / 3.0)),
ladder as (
    select n, p, weight, weight / sum(weight) over (partition by n) as share,
           cast(round(weight / sum(weight) over (partition by n) * 1e9) as bigint) as billionths
    from ladder_weights)
"""

PLACED = f"""
placed as (
    select s.*, h.carried as handicap, coalesce(s.raw_score - h.carried, s.raw_score) as adjusted
    from raw_scores s left join handicap_table h using (raw_score_id)),
ranked as (
    select *, rank() over (partition by league_id, division, event_id order by adjusted nulls first) as place,
           count(*) over (partition by league_id, division, event_id, adjusted) as ties,
           count(*) over (partition by league_id, division, event_id) as field
    from placed),
shared as (
    select r.raw_score_id,
           (2 * coalesce(sum(l.billionths), 0) + r.ties) // (2 * r.ties) as share
    from ranked r left join ladder l on l.n = r.field and l.p >= r.place and l.p < r.place + r.ties
    group by r.raw_score_id, r.ties),
priced as (
    select r.*, g.league_name, e.event_end_date as day, year(e.event_end_date) as year,
           case when e.off_points then 0
                else (r.field - r.place + 1) * coalesce(e.points_multiplier, 1) end as points,
           case when year(e.event_end_date) < {PAYOUT_FROM_YEAR} then 0
                else (2 * cast(r.field as hugeint) * cast(coalesce(e.buy_in_override_ammt, g.league_entry_fee) * 100 as bigint)
                        * cast(10000 - g.league_cash_percentage * 100 as bigint) * s.share
                      + 1000000000000000) // 2000000000000000 end as payout
    from ranked r join shared s using (raw_score_id)
    join live_events e using (event_id) join leagues g on g.league_id = r.league_id),
adjusted_table as (
    select *, sum(points) over (partition by league_id, division, player_username, year order by day) as running
    from priced)
"""

SEASON_EVENTS = f"""
season_events as (
    select a.event_id, a.league_id, a.league_name, e.event_name, a.day, a.year,
           count(*) as num_players, round(avg(a.raw_score), 2) as average_raw_score,
           rank() over (partition by a.year, a.league_id order by a.day desc) as newness
    from adjusted_table a join live_events e using (event_id)
    where a.year = {SEASON}
    group by a.event_id, a.league_id, a.league_name, e.event_name, a.day, a.year)
"""

SEASON_PLAYERS = f"""
season_players as (
    select *, rank() over (partition by league_id, division order by season_points desc) as season_place
    from (
        select a.player_username, a.player_name, a.league_id, a.league_name, a.division,
               max(a.day) as last_played, round(avg(a.raw_score), 2) as average_raw_score,
               count(*) as events_played, sum(a.points) as season_points, sum(a.payout) as season_winnings,
               h.next_one, h.listed
        from adjusted_table a
        left join (select * from handicap_table where recency = 1) h
          on h.player = a.player_username and h.league_id = a.league_id
        where a.year = {SEASON}
        group by 1, 2, 3, 4, 5, h.next_one, h.listed) totals)
"""


def _with(*parts: str) -> str:
    return "with " + ",\n".join(part.strip() for part in parts) + "\n"


TO_EVENTS = (ctes("leagues", "league_events", "event_updates", "raw_scores"), LIVE_EVENTS)
TO_SCOPE = (*TO_EVENTS, SCOPE)
TO_HANDICAPS = (*TO_SCOPE, HISTORY, HANDICAPS)
TO_ADJUSTED = (*TO_HANDICAPS, LADDER, PLACED)
TO_SEASON = (*TO_ADJUSTED, SEASON_EVENTS, SEASON_PLAYERS)

# A cell as text and as a whole number.
CLEAN = """
cells as (
    select *, case when trim(round_total_score) similar to '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)'
                   then cast(trunc(cast(trim(round_total_score) as double)) as bigint) end as total
    from exports)
"""

EVENT_COLUMNS = """
    event_id, league_id, cast(event_end_date as varchar) as event_end_date, export_url
"""


def oracle_sql() -> dict[str, str]:
    given = ["division", "name", "username", "round_total_score", *[f"hole_{n}" for n in range(1, 8)]]
    cells = [f"coalesce(length({name}) || ':' || {name}, '-')" for name in given]
    said = ", ".join([*cells, *["'-'"] * 29])  # the exports have 7 of 36 holes
    return {
        "eligible_rounds": _with(*TO_SCOPE) + """
            select raw_score_id, league_id, raw_score, player as player_username,
                   cast(day as varchar) as event_end_date
            from scope where counts""",
        "prior_round_count": _with(*TO_SCOPE, HISTORY) + """
            select raw_score_id, e.n as earlier_rounds
            from earlier e join scope r using (raw_score_id)
            where r.player is not null""",
        "handicap_rounds": _with(*TO_SCOPE, HISTORY) + """
            select raw_score_id, recency, used as used_raw_score, cast(used_day as varchar) as used_date
            from history where recency <= depth""",
        "handicaps": _with(*TO_HANDICAPS) + """
            select raw_score_id, raw_score, next_one as next_handicap, listed as next_raw_scores_considered,
                   league_id, player as player_username, cast(day as varchar) as event_end_date,
                   carried as handicap, carried_list as raw_scores_considered, recency as handicap_rank
            from handicap_table""",
        "current_handicap": _with(*TO_HANDICAPS) + """
            select league_id, player as player_username, next_one as next_handicap,
                   listed as next_raw_scores_considered
            from handicap_table where recency = 1""",
        "scored_rounds": _with(*TO_EVENTS) + """
            select s.raw_score_id, s.league_id, e.event_name, cast(e.event_end_date as varchar) as event_end_date,
                   g.league_name, s.raw_score
            from raw_scores s join live_events e using (event_id) join leagues g on g.league_id = s.league_id""",
        "event_placing": _with(*TO_ADJUSTED) + """
            select raw_score_id, adjusted as adjusted_score, place, ties as tie_count, field as num_players
            from ranked""",
        "payout_shares": _with(*TO_ADJUSTED) + """
            select raw_score_id, share / 1e9 as split_percentage from shared""",
        "payout_table": _with(*TO_ADJUSTED) + """
            select field as n_players, p as position, round(weight, 9) as weight, billionths / 1e9 as percentage,
                   round(share * 100, 4) as payout_percent
            from (select distinct field from ranked) fields left join ladder on n = field""",
        "payout_large_fields": _with(ctes("raw_scores", "league_events")) + """,
            counted as (select r.league_id, year(event_end_date) as year, raw_score, count(*) as tie_count
                        from raw_scores r join league_events using (event_id) where raw_score is not null group by all),
            placed as (select *, 1 + coalesce(sum(tie_count) over (partition by league_id, year order by raw_score
                                  rows between unbounded preceding and 1 preceding), 0) as place,
                              sum(tie_count) over (partition by league_id, year) as group_size from counted),
            shared as (select *, (select coalesce(sum(pow(0.64, i)), 0) from range(cast(ceil(group_size / 3.0) as bigint)) t(i)
                                  where i >= place - 1 and i < place - 1 + tie_count)
                                 / (select sum(pow(0.64, i)) from range(cast(ceil(group_size / 3.0) as bigint)) t(i)) / tie_count as part
                       from placed)
            select league_id, year, raw_score, cast(place as bigint) as place, tie_count, cast(group_size as bigint) as group_size,
                   round(part, 9) as share, case when group_size <= 3000 then round(part, 9) else 0.0 end as limited_share
            from shared""",
        "adjusted_scores": _with(*TO_ADJUSTED) + """
            select raw_score_id, event_id, league_id, league_name, cast(day as varchar) as event_end_date,
                   year, division, player_name, player_username, raw_score, handicap,
                   adjusted as adjusted_score, place, cast(points as double) as points,
                   cast(payout as double) as payout, cast(running as double) as season_points_as_of_event
            from adjusted_table""",
        "season_event_summary": _with(*TO_SEASON) + """
            select event_id, league_id, league_name, event_name, cast(day as varchar) as event_end_date, year,
                   num_players, average_raw_score, newness as event_rank_in_league
            from season_events""",
        "season_players_summary": _with(*TO_SEASON) + """
            select player_username, player_name, league_id, league_name, division,
                   cast(last_played as varchar) as last_played_date, average_raw_score, events_played,
                   cast(season_points as double) as season_points, season_place,
                   cast(season_winnings as double) as season_winnings, next_one as next_handicap,
                   listed as next_handicap_scores
            from season_players""",
        "season_log": _with(*TO_SEASON) + """,
            grid as (
                select p.player_username, p.player_name, p.division as standing, a.raw_score_id,
                       p.league_id, p.league_name, e.event_id, e.event_name, e.day, e.year, a.division, a.raw_score, a.handicap, a.adjusted, a.place, a.points,
                       a.payout, a.running
                from season_players p join season_events e using (league_id)
                left join adjusted_table a on a.event_id = e.event_id and a.player_username = p.player_username)
            select player_username, player_name, league_id, league_name, event_id, event_name,
                   cast(day as varchar) as event_end_date, year,
                   last_value(division ignore nulls) over (
                       partition by player_username, player_name, standing, league_id, year
                       order by day, event_id, division is null, raw_score_id
                       rows between unbounded preceding and current row) as division, raw_score,
                   coalesce(handicap, 0) as handicap, adjusted as adjusted_score, place,
                   cast(points as double) as points, cast(payout as double) as payout,
                   cast(coalesce(last_value(running ignore nulls) over (
                       partition by player_username, player_name, standing, league_id, year
                       order by day, event_id, running is null, raw_score_id
                       rows between unbounded preceding and current row), 0) as double)
                       as season_points_as_of_event
            from grid""",
        "season_hole_scores": _with(ctes("hole_scores"), *TO_SEASON) + """
            select a.player_username, a.player_name,
                   a.player_name || ' (' || a.player_username || ')' as player_display_name,
                   a.league_id, a.league_name, o.hole_number, o.hole_score, e.event_name,
                   cast(e.day as varchar) as event_end_date, e.year
            from adjusted_table a join season_events e using (event_id) join hole_scores o using (raw_score_id)""",
        "imported_event_urls": _with(ctes("league_events")) + """
            select distinct export_url from league_events where is_imported""",
        "league_lookup": _with(ctes("leagues")) + """
            select league_name as name, league_is_handicap as is_handicap,
                   'https://example.org/leagues/building' as url,
                   cast(league_cash_percentage as double) as cash_percentage,
                   cast(league_entry_fee as double) as entry_fee,
                   handicap_rounds_considered
            from leagues where league_id = 'BUILDING' limit 1""",
        "finished_events": _with(ctes("league_events")) + f"""
            select event_id from league_events
            where event_end_date is null or event_end_date < date '{PLAN_AS_OF}'""",
        "pending_exports": _with(ctes("candidates", "league_events")) + """
            select export_url, league_id from candidates
            where suffix(export_url, 'leaderboard/export')
              and not exists (from league_events e where e.is_imported and e.export_url = candidates.export_url)""",
        "import_plan": _with(ctes("candidates", "stored_events")) + f"""
            select c.export_url, s.event_id is null as is_new,
                   case when not coalesce(c.event_end_date < date '{PLAN_AS_OF}', true) then 'metadata_only'
                        when coalesce(s.is_imported, false) then 'skip' else 'full' end as action,
                   coalesce(s.event_id, sha256(c.export_url)) as event_id
            from candidates c left join stored_events s using (export_url)
            where suffix(c.export_url, 'leaderboard/export')""",
        "apply_event_updates": _with(*TO_EVENTS) + f"""
            select {EVENT_COLUMNS}, off_handicap as is_excluded_from_handicap, no_handicap as is_no_handicap_applied,
                   off_points as is_excluded_from_points, cast(points_multiplier as double) as points_multiplier,
                   cast(buy_in_override_ammt as double) as buy_in_override_ammt,
                   case when month(event_end_date) in (4, 5, 6, 7, 10, 12) then '2001-08-01 00:00:00'
                        else '2001-01-01 00:00:00' end as update_time
            from live_events""",
        "mark_imported": _with(ctes("league_events")) + f"""
            select event_id, is_imported or event_end_date < date '{PLAN_AS_OF}' as is_imported
            from league_events""",
        "update_file_metadata": _with(ctes("league_events")) + """
            select event_id,
                   case when month(event_end_date) = 3 then 'moved/' || file_name else file_name end as file_name,
                   case when month(event_end_date) <> 3 then file_path end as file_path
            from league_events""",
        "update_league": _with(ctes("leagues")) + """
            select league_id, league_name, cast(league_entry_fee + case when league_is_handicap then 1 else 0 end as double)
                       as league_entry_fee, handicap_rounds_considered
            from leagues""",
        "prune_raw_scores": _with(ctes("raw_scores", "league_events")) + """
            select raw_score_id, event_id from raw_scores
            where event_id in (select event_id from league_events where month(event_end_date) <> 3)""",
        "prune_hole_scores": _with(ctes("raw_scores", "league_events", "hole_scores")) + """
            select raw_score_id, hole_number, hole_score from hole_scores
            where raw_score_id in (
                select raw_score_id from raw_scores
                where event_id in (select event_id from league_events where month(event_end_date) <> 3))""",
        "conform": _with(ctes("hole_scores")) + """
            select cast(null as varchar) as hole_score_id, raw_score_id, hole_number,
                   case when hole_score % 10 <> 0 then hole_score end as hole_score
            from hole_scores""",
        "orphan_raw_scores": _with(ctes("raw_scores")) + """
            select league_id, count(*) as count from raw_scores where event_id like '%-03-01' group by 1""",
        "clean_scores": _with(ctes("exports"), CLEAN) + """
            select raw_score_id, event_id, league_id, nullif(trim(division), '') as division,
                   trim(name) as player_name, nullif(trim(username), '') as player_username, total as raw_score
            from cells where trim(name) <> ''""",
        "hole_unpivot": _with(ctes("exports")) + """,
            long as (unpivot (select raw_score_id, hole_1, hole_2, hole_3, hole_4, hole_5, hole_6, hole_7 from exports)
                     on columns('hole_.*') into name hole value cell),
            typed as (select raw_score_id, cast(substr(hole, 6) as bigint) as hole_number,
                             cast(trunc(try_cast(cell as double)) as bigint) as hole_score from long)
            select * from typed where hole_score <> 0""",
        "event_rows": _with(ctes("exports", "league_events")) + f"""
            select sha256(e.export_url) as event_id, e.league_id,
                   replace(e.league_id || '-league', '-', ' ') as event_name,
                   cast(e.event_end_date as varchar) as event_end_date, e.export_url,
                   count(x.name) as num_players,
                   cast(e.event_end_date as varchar) || ' 08:00:00' as download_date, false as is_imported
            from league_events e join exports x using (event_id)
            where e.event_end_date >= date '2001-06-01'
            group by 1, 2, 3, 4, 5, 7, 8""",
        "event_by_url": _with(ctes("league_events")) + """
            select event_id, is_imported from league_events
            where export_url = 'https://example.org/events/BUILDING-2001-03-01/leaderboard/export'""",
        "league_urls": _with(ctes("leagues")) + """
            select 'https://example.org/leagues/building' as url union all
            select 'https://example.org/more/building'""",
        "scanned_exports": _with(ctes("awkward_exports")) + f"""
            select league_id, {", ".join(f"nullif({name}, '') as {name}" for name in given)} from awkward_exports""",
        "round_ids": _with(ctes("exports")) + f""",
            counted as (select file_path, concat_ws('|', {said}) as content, 2 * count(*) as copies
                        from exports where trim(name) <> '' group by all)
            select file_path, sha256(concat_ws('|', file_path, cast(unnest(range(1, copies + 1)) as varchar), content))
                       as raw_score_id
            from counted""",
        "league_configs": _with(ctes("config_cells")) + """
            select segment as league_name, 'https://example.org/' || segment || '|x' as league_urls,
                   cast(players as double) as league_entry_fee, segment > 'B' as league_is_handicap,
                   cast(0 as bigint) as handicap_rounds_considered
            from (select c_mktsegment as segment, count(*) as players from customer group by 1) all_segments
            where segment not in ('MACHINERY', 'FURNITURE')""",
        "file_name_parts": _with(ctes("exports")) + """
            select distinct file_path, replace(league_id || '-league', '-', ' ') as event_name,
                   regexp_extract(event_id, '[0-9]{4}-[0-9]{2}-[0-9]{2}$') || ' 08:00:00' as download_date
            from exports""",
        "parse_url_list": _with(ctes("leagues")) + """
            select league_id, url
            from (select league_id, trim(unnest(string_split(league_urls, '|'))) as url from leagues) parts
            where url <> ''""",
        "format_url_list": _with(ctes("leagues")) + """
            select league_id, 'https://example.org/leagues/' || lower(league_id) || '|https://example.org/more/'
                   || lower(league_id) as league_urls
            from leagues""",
        "parse_flags": """
            select conv_id, turn, coalesce(lower(trim(text)) in ('1', 'true', 'yes', 'y', 'on'), false) as flag,
                   case when role = 'user' then true when turn % 2 = 1 then false end as by_user
            from conversations""",
        "page_links": _with(ctes("mixed_pages")) + r""",
            bare as (select page_id, regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gsi') as html from mixed_pages),
            tags as (select page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1, 'si') as hrefs from bare),
            links as (select page_id, unnest(hrefs) as link, generate_subscripts(hrefs, 1) - 1 as position from tags)
            select page_id, replace(link, '&amp;', '&') as link, min(position) as position from links
            where link like '/events%' and contains(link, '/leaderboard') group by 1, 2""",
        "awkward_links": """
            select page_id, '/events/' || page_id || unnest(['/leaderboard', '/leaderboard?a=1&b=23&copy=4é<', '/leaderboard/last'])
                       as link,
                   cast(unnest([0, 1, 2]) as bigint) as position
            from pages""",
        "iso_end_dates": """
            select page_id, cast(case page_id % 6 when 4 then date_trunc('week', day) when 5 then null else day end as date)::varchar
                       as event_end_date
            from (select page_id, cast(date '1999-12-25' + cast(page_id % 4000 as integer) as date) as day from pages) days""",
        "page_links_resolved": _with(ctes("mixed_pages")) + r""",
            bare as (select page_id, url, regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gsi') as html from mixed_pages),
            tags as (select page_id, url, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1, 'si') as hrefs from bare),
            links as (select page_id, url, unnest(hrefs) as link, generate_subscripts(hrefs, 1) - 1 as position from tags)
            select page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || replace(link, '&amp;', '&') as export_url,
                   min(position) as position
            from links where contains(link, '/events') and contains(link, '/leaderboard') group by 1, 2""",
        "event_links": r"""
            with bare as (select page_id, regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gsi') as html from pages
                          where 2020 + page_id % 7 >= 2023),
            tags as (select page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1, 'si') as hrefs from bare),
            links as (select page_id, unnest(hrefs) as link, generate_subscripts(hrefs, 1) - 1 as position from tags)
            select page_id, 'https://example.org/events/leaderboard' || replace(link, '&amp;', '&') as url,
                   min(position) as position
            from links group by 1, 2""",
        "page_end_dates": """
            select page_id, case when page_id % 3 = 0 then '2024-0' || cast(1 + page_id % 9 as varchar) || '-15' end
                       as event_end_date
            from pages""",
        "misfits": _with(ctes("raw_scores", "league_events")) + """,
            older as (select *, event_id in (select event_id from league_events where month(event_end_date) <> 3) as stays
                      from raw_scores where league_id <> 'BUILDING')
            select 'note' as "column", 'unknown column' as reason, count(*) as cells, count(*) filter (stays) as "left",
                   count(*) as noted
            from older where division = 'Division 1' and player_name is not null
            union all
            select 'raw_score', 'no bigint', count(*), count(*) filter (stays), count(*) from older where raw_score % 10 = 3""",
        "pruned_counts": _with(ctes("raw_scores", "hole_scores", "league_events")) + """,
            kept as (select raw_score_id from raw_scores
                     where event_id in (select event_id from league_events where month(event_end_date) <> 3))
            select 'raw_scores' as table_name, (select count(*) from raw_scores) - (select count(*) from kept) as pruned
            union all
            select 'hole_scores', count(*) from hole_scores where raw_score_id not in (select raw_score_id from kept)""",
        "whole_run": _with(ctes("exports", "league_events", "config_cells"), CLEAN) + """,
            long as (unpivot (select raw_score_id, hole_1, hole_2, hole_3, hole_4, hole_5, hole_6, hole_7 from exports)
                     on columns('hole_.*') into name hole value cell),
            typed as (select raw_score_id, cast(trunc(try_cast(cell as double)) as bigint) as hole_score from long),
            played as (select raw_score_id, count(*) as holes, sum(hole_score) as strokes
                       from typed where hole_score <> 0 group by 1),
            rounds as (select c.raw_score_id, c.league_id, c.event_id, c.total, year(e.event_end_date) as year
                       from cells c join league_events e using (event_id)
                       where trim(c.name) <> '' and e.event_end_date < date '2001-08-01')
            select league_id, year, count(*) as rounds, cast(sum(total) as bigint) as total,
                   cast(sum(holes) as bigint) as holes, cast(sum(strokes) as bigint) as strokes,
                   count(distinct event_id) as events, '2001-08-01 00:00:00' as updated,
                   (select count(*) from config_cells where segment not in ('MACHINERY', 'FURNITURE')) as leagues
            from rounds left join played using (raw_score_id) group by 1, 2""",
    }
