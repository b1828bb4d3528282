"""Derived inputs on the driver's TPC-H-like test tables.

The test tables hold no football data, so match data is derived from them with
SQL that runs unchanged in Spark and in DuckDB (the correctness oracle).  Each
template names its inputs as ``{table}`` placeholders: Spark binds them to
DataFrames through ``spark.sql(sql, **frames)``; the oracle formats them to the
plain view names.

V_PREDICTIONS / V_FIXTURES / V_ROUNDS follow FIXTURES.md.  The others build
landed inputs (extractor responses, video metadata, a video list, manual
overrides, a re-resolved batch) from the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

V_PREDICTIONS = """
select concat(lpad(cast(o_custkey as varchar(20)),11,'0'),'_',lpad(cast(o_orderkey as varchar(20)),8,'0')) as prediction_id,
       lpad(cast(o_custkey as varchar(20)),11,'0') as video_id,
       cast(o_orderdate as date) as publish_date,
       case when o_orderkey % 4 = 0 then cast(o_orderdate as date) + cast(o_orderkey % 30 as int) end as match_date,
       concat('FC ', replace(hn.n_name,'NATION','Nación')) as home_team,
       lower(an.n_name) as away_team,
       c_mktsegment as competition,
       case when o_orderkey % 5 = 0 then 'knockout' when (o_orderkey*3) % 30 = 0 then 'knockout' else 'single' end as match_type,
       cast(20 + (o_orderkey*7) % 51 as int) as pred_home_win_pct,
       cast(case when o_orderkey % 5 = 0 then 0 else (o_orderkey*3) % 30 end as int) as pred_draw_pct,
       cast(80 - (o_orderkey*7) % 51 - case when o_orderkey % 5 = 0 then 0 else (o_orderkey*3) % 30 end as int) as pred_away_win_pct,
       case when o_orderkey % 10 = 7 then null when o_orderstatus='F' then 'H' when o_orderstatus='O' then 'A' else 'D' end as actual_result
from {orders} join {customer} on o_custkey=c_custkey
join {nation} hn on hn.n_nationkey = c_nationkey
join {nation} an on an.n_nationkey = (o_orderkey % 25)
where hn.n_nationkey <> an.n_nationkey
"""

V_FIXTURES = """
select ((l_orderkey*10+l_linenumber)*100000+l_partkey)*10000+l_suppkey as fixture_seq,
       c_mktsegment as competition, hn.n_name as home_team, an.n_name as away_team,
       case when l_linenumber=7 then null else cast(cast(l_quantity as int) % 5 as varchar(5)) end as home_score,
       cast(l_partkey % 4 as varchar(5)) as away_score,
       cast(l_shipdate as date) as event_date,
       case when l_returnflag='N' then 'Not Started' else 'Match Finished' end as status
from {lineitem} join {orders} on l_orderkey=o_orderkey join {customer} on o_custkey=c_custkey
join {supplier} on l_suppkey=s_suppkey
join {nation} hn on hn.n_nationkey=c_nationkey join {nation} an on an.n_nationkey=s_nationkey
where hn.n_nationkey <> an.n_nationkey
"""

V_ROUNDS = """
select event_type as competition, cast(ts as date) as season,
       cast(extract(hour from ts) as int) + 1
         + case when extract(hour from ts) >= 12 then cast(extract(day from ts) as int) % 4 else 0 end as round_no,
       count(*) as n_events,
       cast(sum(case when value > 20 then 1 else 0 end) as bigint) as n_finished
from {events} group by 1,2,3
"""

# Extractor responses, one per event: two prediction objects per array, with
# fenced (id%7=0), broken (1), object-not-array (2), no competition key (3),
# decimal / quoted percentages (4), empty array (5) and JSON-null quote (6).
# Of those with two objects: two arrays with words between them (id%13=1), a
# no-break space in front (3), a key that repeats (5), a number in place of the
# first object (7), a percentage that is no number (9) or null (11).
_ELEM0 = """concat('{{"match_date": "', case when event_id % 2 = 0 then cast(cast(ts as date) as string) else '' end, '", ',
  '"home_team": "NATION_', cast(event_id % 25 as string), '", ',
  '"away_team": "nation_', cast((event_id + 3) % 25 as string), '", ',
  case when event_id % 7 = 3 then '' else concat('"competition": "', event_type, '", ') end,
  '"pred_home_win_pct": ', case when event_id % 13 = 9 then '"abc"'
                                else concat(cast(20 + event_id % 51 as string), case when event_id % 7 = 4 then '.9' else '' end) end, ', ',
  '"pred_draw_pct": ', case when event_id % 7 = 4 then concat('"', cast((event_id * 3) % 30 as string), '"')
                            else cast((event_id * 3) % 30 as string) end, ', ',
  '"pred_away_win_pct": ', case when event_id % 13 = 11 then 'null'
                                else cast(80 - event_id % 51 - (event_id * 3) % 30 + case when event_id % 11 = 0 then 5 else 0 end as string) end, ', ',
  '"raw_quote": ', case when event_id % 7 = 6 then 'null' else concat('"q', cast(event_id as string), '"') end, '}}')"""

_ELEM1 = """concat('{{"match_date": "", "home_team": "nation_', cast((user_id + 1) % 25 as string),
  '", "away_team": "FC Nación_', cast(user_id % 25 as string), '", ',
  case when event_id % 7 = 3 then '' else concat('"competition": "', event_type, '", ') end,
  '"pred_home_win_pct": ', cast(10 + user_id % 61 as string),
  ', "pred_draw_pct": ', case when user_id % 4 = 0 then '0' else '25' end,
  ', "pred_away_win_pct": ', cast(90 - user_id % 61 - case when user_id % 4 = 0 then 0 else 25 end as string),
  ', "raw_quote": "r', cast(user_id as string), '"}}')"""

RESPONSES = """
select concat('ev', lpad(cast(event_id as string), 9, '0')) as video_id,
       concat('https://youtu.be/ev', lpad(cast(event_id as string), 9, '0')) as video_url,
       cast(ts as date) as publish_date,
       case event_id % 7
         when 5 then '[]'
         when 1 then concat('[{{"home_team": "NATION_', cast(event_id % 25 as string), '", ')
         when 2 then concat('{{"error": "', event_type, '"}}')
         else concat(case when event_id % 7 = 0 then concat('```json', chr(10)) else '' end,
                     case when event_id % 13 = 3 then chr(160) else '' end,
                     '[', case when event_id % 13 = 7 then '7' else """ + _ELEM0 + """ end,
                     case event_id % 13 when 1 then '] and also [' when 5 then ', {{"k": 1, "k": 2}}, ' else ', ' end,
                     """ + _ELEM1 + """, ']',
                     case when event_id % 7 = 0 then concat(chr(10), '```') else '' end)
       end as raw_response
from {{events}}
""".replace("{{events}}", "{events}")

METADATA = """
select lpad(cast(o_orderkey as string), 11, '0') as video_id,
       case when o_orderkey % 9 = 0 then '{{"items": []}}'
            else concat('{{"items": [{{"snippet": {{"publishedAt": "', cast(cast(o_orderdate as date) as string), 'T',
                        lpad(cast(o_orderkey % 24 as string), 2, '0'), ':00:00Z", "title": "', o_orderpriority, '"}}}}]}}')
       end as metadata_json
from {orders}
"""

VIDEO_LIST = """
select case when o_orderkey % 10 = 3 then concat('https://example.com/watch?id=', cast(o_orderkey as string))
            when o_orderkey % 2 = 0 then concat('https://www.youtube.com/watch?v=', lpad(cast(o_orderkey as string), 11, '0'),
                                                '&t=', cast(o_orderkey % 60 as string), 's')
            else concat('https://youtu.be/', lpad(cast(o_orderkey as string), 11, '0')) end as video_url
from {orders}
"""

PAGE_URLS = """
select page_id,
       case when page_id % 2 = 0 then concat('https://youtu.be/', lpad(cast(page_id as string), 11, '0'))
            else url end as url
from {pages}
"""

# A manual line for every order: whole goals, whole decimals, or (two of three) goals
# that are no number; some padded with spaces, some with a date, a valid or an
# invalid match type, and a second line for every fourth order.
OVERRIDES = """
select case when o_orderkey % 200 = 0 then concat(' ', pid, ' ') else pid end as prediction_id,
       case when o_orderkey % 3 <> 0 then 'x' else concat(cast((o_orderkey + line) % 4 as varchar(5)),
            case when o_orderkey % 7 = 0 then '.0' else '' end) end as home_goals,
       case when o_orderkey % 3 <> 0 then '1' else cast(o_custkey % 3 as varchar(5)) end as away_goals,
       case when o_orderkey % 100 = 0 then cast(cast(o_orderdate as date) + 2 as string) end as match_date,
       case when o_orderkey % 150 = 0 then 'knockout' when o_orderkey % 250 = 0 then 'bogus' end as match_type,
       cast(o_orderkey * 2 + line as bigint) as line_no
from (select o_orderkey, o_custkey, o_orderdate, line,
             concat(lpad(cast(o_custkey as varchar(20)),11,'0'),'_',lpad(cast(o_orderkey as varchar(20)),8,'0')) as pid
      from (select *, 0 as line from {orders} union all
            select *, 1 as line from {orders} where o_orderkey % 4 = 0) l) o
"""

# A later batch: of the stored predictions it holds those re-resolved (newer fetch), re-run but still
# pending (null fetch) or stale (older fetch), and a new prediction beside every second of them.
WHOLE_BATCH = """
select case when n.is_new = 1 then concat(prediction_id, '_n') else prediction_id end as prediction_id,
       video_id, publish_date, match_date, home_team, away_team, competition, match_type,
       pred_home_win_pct, pred_draw_pct, pred_away_win_pct,
       case k % 3 when 0 then 'A' when 1 then null else 'H' end as actual_result,
       case k % 3 when 0 then timestamp '2026-02-01 12:00:00' when 1 then null
                  else timestamp '2025-12-01 12:00:00' end as fetched_at
from (select *, cast(substring(prediction_id, 13, 8) as bigint) as k from {v_predictions}) t
join (select 0 as is_new union all select 1 as is_new) n on n.is_new <= t.k % 2
"""

# The same of the predictions published in every third month; the other months it leaves alone.
NEW_BATCH = WHOLE_BATCH.replace("{v_predictions}", "{v_predictions}\n      where extract(month from publish_date) % 3 = 0")

# Events of landed result pages, flat: fixtures by the season and half month they fall in. A page that is
# ``emptied`` lands without its events (three rounds in a row, or a single one); one that is ``early`` has
# landed before as well, with nothing finished. The season labels are those of the results source.
V_PAGE_EVENTS = """
select competition, case when competition = 'FURNITURE' and season = '1994-1995' then '1994' else season end as season,
       round_no, home_team, away_team, home_score, away_score, event_date, status, fixture_seq,
       (cast(substring(season, 1, 4) as int) + cast(floor(round_no / 3) as int)) % 8 = 0 or round_no % 10 = 4 as emptied,
       round_no % 5 = 2 as early
from (select *, case when competition = 'MACHINERY' then cast(y as varchar(4))
                     when m >= 8 then concat(cast(y as varchar(4)), '-', cast(y + 1 as varchar(4)))
                     else concat(cast(y - 1 as varchar(4)), '-', cast(y as varchar(4))) end as season,
             cast(1 + ((m + 4) % 12) * 2 + case when extract(day from event_date) > 15 then 1 else 0 end as int) as round_no
      from (select *, cast(extract(year from event_date) as int) as y, cast(extract(month from event_date) as int) as m
            from {v_fixtures}) f) g
"""

STORED_FETCHED_AT = "2026-01-05 00:00:00"
RUN_FETCHED_AT = "2026-03-01 00:00:00"
RUN_DATE = "2026-03-01"
PENDING_AS_OF = "1998-01-01"
GAINED_FROM = "1995-01-01"          # fixtures of this day and later have landed since the last version


def oracle_sql(template: str, **names: str) -> str:
    """The template with every placeholder replaced by a plain view name."""
    fields = {t: t for t in TABLES}
    fields.update(names)
    return template.format(**fields)


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _run(spark: SparkSession, template: str, frames: dict[str, DataFrame]) -> DataFrame:
    needed = {k: v for k, v in frames.items() if "{" + k + "}" in template}
    return spark.sql(template, **needed)


def view(spark: SparkSession, sf_dir: str, template: str, **extra: DataFrame) -> DataFrame:
    names = [t for t in TABLES if "{" + t + "}" in template]
    frames = load_tables(spark, sf_dir, names)
    frames.update(extra)
    return _run(spark, template, frames)


def predictions(spark, sf_dir):
    return view(spark, sf_dir, V_PREDICTIONS)


def fixtures(spark, sf_dir):
    return view(spark, sf_dir, V_FIXTURES)


def rounds(spark, sf_dir):
    return view(spark, sf_dir, V_ROUNDS)


def responses(spark, sf_dir):
    return view(spark, sf_dir, RESPONSES)


def metadata(spark, sf_dir):
    return view(spark, sf_dir, METADATA)


def video_list(spark, sf_dir):
    return view(spark, sf_dir, VIDEO_LIST)


def page_urls(spark, sf_dir):
    return view(spark, sf_dir, PAGE_URLS)


def overrides(spark, sf_dir):
    return view(spark, sf_dir, OVERRIDES)


# "join ... on is_new <= k % 2" is a nested loop; in Spark each row generates its one or two rows
_PAIRED = "join (select 0 as is_new union all select 1 as is_new) n on n.is_new <= t.k % 2"
_GENERATED = "lateral view explode(case when t.k % 2 >= 1 then array(0, 1) when t.k % 2 >= 0 then array(0) end) n as is_new"


def _batch(spark, sf_dir, template):
    return view(spark, sf_dir, template.replace(_PAIRED, _GENERATED), v_predictions=predictions(spark, sf_dir))


def new_batch(spark, sf_dir):
    return _batch(spark, sf_dir, NEW_BATCH)


def whole_batch(spark, sf_dir):
    return _batch(spark, sf_dir, WHOLE_BATCH)


def result_pages(spark, sf_dir):
    """``V_PAGE_EVENTS`` nested into pages, as they land."""
    flat = view(spark, sf_dir, V_PAGE_EVENTS, v_fixtures=fixtures(spark, sf_dir))
    event = F.struct("fixture_seq", F.col("home_team").alias("strHomeTeam"), F.col("away_team").alias("strAwayTeam"),
                     F.col("event_date").cast("string").alias("dateEvent"), F.col("status").alias("strStatus"),
                     F.col("home_score").alias("intHomeScore"), F.col("away_score").alias("intAwayScore"))
    nested = flat.groupBy("competition", "season", "round_no", "emptied", "early").agg(F.array_sort(F.collect_list(event)).alias("e"))
    kept = ["strHomeTeam", "strAwayTeam", "dateEvent", "strStatus", "intHomeScore", "intAwayScore"]
    events = F.transform("e", lambda x: F.struct(*[x[c].alias(c) for c in kept]))
    unplayed = F.transform("e", lambda x: F.struct(*[(F.lit("Not Started") if c == "strStatus" else x[c]).alias(c) for c in kept]))
    now = nested.select("competition", "season", "round_no", F.lit("2026-02-01 00:00:00").cast("timestamp").alias("landed_at"),
                        F.when(~F.col("emptied"), events).alias("events"))
    before = nested.where("early").select("competition", "season", "round_no", F.lit("2026-01-01 00:00:00").cast("timestamp").alias("landed_at"), unplayed.alias("events"))
    return now.unionByName(before)
