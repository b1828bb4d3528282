"""DuckDB oracle SQL for the queries in ``__spark_entry__``.

Each oracle is written independently of the Spark plan, in plain SQL over the
driver's tables: the derived inputs are the shared templates of
``pitchcast.sources.testviews`` (inlined as CTEs); the operator itself is
re-stated directly (theta join on names, row_number for first picks, explicit
arithmetic for scores and levels).  Double-valued aggregates follow the same
exact-integer formulas as the Spark side, so results agree bit for bit.
"""

from __future__ import annotations

from pitchcast.sources import testviews as tv

T0 = tv.STORED_FETCHED_AT
RUN_TS = tv.RUN_FETCHED_AT
RUN_DATE = tv.RUN_DATE
AS_OF = tv.PENDING_AS_OF


def _dbl(x) -> str:
    return f"cast({x} as double)"


def canon(x: str) -> str:
    s = f"lower(trim({x}))"
    for accented, plain in zip("áéíóúñüç", "aeiounuc"):
        s = f"replace({s}, '{accented}', '{plain}')"
    s = f"regexp_replace({s}, '[^a-z0-9 ]', '', 'g')"
    s = f"replace({s}, 'nacion', 'nation')"
    s = f"array_to_string(list_filter(string_split({s}, ' '), lambda w: w not in ('', 'de', 'del')), ' ')"
    s = f"trim(regexp_replace({s}, '^(real|atletico|club|rc|fc|sd|cd) ', ''))"
    return f"(case {s} when 'nation7' then 'nation23' else {s} end)"


def season(comp: str, day: str) -> str:
    day = f"coalesce({day}, date '{RUN_DATE}')"
    return (f"(case when {comp} = 'MACHINERY' then strftime({day}, '%Y') "
            f"when {comp} = 'FURNITURE' and {day} between date '1994-08-01' and date '1995-07-31' then '1994' "
            f"else concat(year({day} - interval 7 month), '-', year({day} + interval 5 month)) end)")


def result_code(h: str, a: str) -> str:
    return (f"(case when {h} > {a} then 'H' when {h} < {a} then 'A' "
            f"when {h} is not null and {a} is not null then 'D' end)")


def brier(h="pred_home_win_pct", d="pred_draw_pct", a="pred_away_win_pct", mt="match_type",
          r="actual_result") -> str:
    ph, pd_, pa = (f"({_dbl(x)} / {_dbl(100.0)})" for x in (h, d, a))
    ind = lambda c: f"(case when {r} = '{c}' then {_dbl(1.0)} else {_dbl(0.0)} end)"
    sq = lambda x: f"(({x}) * ({x}))"
    three = f"round((({sq(f'{ph} - {ind(chr(72))}')} + {sq(f'{pd_} - {ind(chr(68))}')}) + {sq(f'{pa} - {ind(chr(65))}')}) / {_dbl(3.0)}, 4)"
    tot = f"({ph} + {pa})"
    two = (f"(case when {tot} <= 0 then {_dbl(0.0)} else round(({sq(f'{ph} / {tot} - {ind(chr(72))}')} + "
           f"{sq(f'{pa} / {tot} - {ind(chr(65))}')}) / {_dbl(2.0)}, 4) end)")
    return f"(case when {r} in ('H','D','A') then (case when {mt} = 'knockout' then {two} else {three} end) end)"


def hit() -> str:
    """1 if the result's percentage is the greatest of the three (a tie counts)."""
    told = ("(map {'H': pred_home_win_pct, 'D': pred_draw_pct, 'A': pred_away_win_pct})[actual_result]")
    return (f"(case when {told} = greatest(pred_home_win_pct, pred_draw_pct, pred_away_win_pct) then 1 else 0 end)")


def units(b="brier_score") -> str:
    return f"cast(round({b} * 10000.0) as bigint)"


def mean_u(n="n", s1="s1") -> str:
    return f"(case when {n} > 0 then cast({s1} as double) / (cast({n} as double) * {_dbl(10000.0)}) end)"


def std_u(n="n", s1="s1", s2="s2") -> str:
    num = f"cast(cast({n} as hugeint) * cast({s2} as hugeint) - cast({s1} as hugeint) * cast({s1} as hugeint) as double)"
    return (f"(case when {n} > 1 then sqrt({num} / (cast({n} as double) * (cast({n} as double) - {_dbl(1.0)}))) "
            f"/ {_dbl(10000.0)} end)")


def pct_round(hits="hits", n="n") -> str:
    return f"(case when {n} > 0 then cast((2000 * cast({hits} as bigint) + {n}) // (2 * {n}) as double) / {_dbl(10.0)} end)"


def sums(b="brier_score") -> str:
    return (f"count({b}) as n, cast(sum({units(b)}) as bigint) as s1, "
            f"cast(sum(cast({units(b)} as hugeint) * cast({units(b)} as hugeint)) as hugeint) as s2")


def gauge(v: str, w: int) -> str:
    return f"least({w}, cast(trunc({v} / {_dbl(0.30)} * {_dbl(float(w))}) as integer))"


def trend(v: str) -> str:
    return (f"greatest(0, least(cast(trunc(({v} - {_dbl(0.10)}) / ({_dbl(0.30)} - {_dbl(0.10)}) * {_dbl(7.0)}) as integer), 7))")


def ctes(**extra: str) -> str:
    """The WITH prefix: derived test views plus extra named CTEs."""
    base = {
        "v_predictions": tv.oracle_sql(tv.V_PREDICTIONS),
        "v_fixtures": tv.oracle_sql(tv.V_FIXTURES),
        "stored": f"""select prediction_id, video_id, publish_date, match_date, home_team, away_team, competition,
               match_type, cast(null as integer) as leg_number, pred_home_win_pct, pred_draw_pct, pred_away_win_pct,
               actual_result, cast(null as integer) as home_goals, cast(null as integer) as away_goals,
               {brier()} as brier_score,
               case when actual_result is not null then timestamp '{T0}' end as fetched_at
        from v_predictions""",
    }
    base.update(extra)
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in base.items()) + "\n"


VIDEO_ID_RE = r"(?:v=|youtu\.be/)([A-Za-z0-9_-]{11})"
SUPPORTED = "'MACHINERY', 'BUILDING', 'AUTOMOBILE', 'FURNITURE'"
AGGREGATE = "'MACHINERY', 'BUILDING'"
ROW_COLUMNS = ("prediction_id, video_id, publish_date, match_date, home_team, away_team, competition, match_type, "
               "leg_number, pred_home_win_pct, pred_draw_pct, pred_away_win_pct, actual_result, home_goals, "
               "away_goals, brier_score, fetched_at")


def _first(src: str, cols: str = "*") -> str:
    return (f"select {cols} from (select *, row_number() over (partition by prediction_id order by fixture_seq) as rn "
            f"from {src}) t where rn = 1")


def resolution(pred_source: str = "v_predictions") -> dict[str, str]:
    """CTEs that resolve ``pred_source`` against v_fixtures (theta join on names)."""
    fcols = "fixture_seq, hg, ag, event_date"
    return {
        "p": f"""select *, {canon('home_team')} as hc, {canon('away_team')} as ac,
                   {season('competition', 'coalesce(match_date, publish_date)')} as season,
                   case when match_date is not null then match_date - 1 else publish_date end as lo,
                   case when match_date is not null then match_date + 1 else publish_date + 45 end as hi
                 from {pred_source} where competition in ({SUPPORTED})""",
        "plan": "select distinct competition, season from p",
        "f0": f"""select fixture_seq, competition, {season('competition', 'event_date')} as season,
                    {canon('home_team')} as fh, {canon('away_team')} as fa,
                    try_cast(home_score as integer) as hg, try_cast(away_score as integer) as ag, event_date
                  from v_fixtures where status = 'Match Finished'""",
        "f": "select f0.* from f0 join plan on f0.competition = plan.competition and f0.season = plan.season",
        "pn": "select competition, hc as name from p union select competition, ac as name from p",
        "xn": "select competition, fh as name from f union select competition, fa as name from f",
        "nm": """select pn.competition, pn.name as pred_name, xn.name as fix_name from pn join xn
                 on pn.competition = xn.competition
                 and (pn.name = xn.name or contains(xn.name, pn.name) or contains(pn.name, xn.name))""",
        "cand": f"""select p.prediction_id, {', '.join('f.' + c for c in fcols.split(', '))} from p
                    join nm nh on nh.competition = p.competition and nh.pred_name = p.hc
                    join nm na on na.competition = p.competition and na.pred_name = p.ac
                    join f on f.competition = p.competition and f.fh = nh.fix_name and f.fa = na.fix_name
                    where f.hg is not null and f.ag is not null
                      and (p.lo is null or f.event_date is null or f.event_date between p.lo and p.hi)""",
        "single": _first("cand", f"prediction_id, fixture_seq, hg as home_goals, ag as away_goals, "
                                 f"{result_code('hg', 'ag')} as actual_result, event_date"),
        "ap": f"select * from p where match_type = 'knockout' and competition in ({AGGREGATE})",
        "o1": f"""select ap.prediction_id, {', '.join('f.' + c for c in fcols.split(', '))} from ap
                  join nm nh on nh.competition = ap.competition and nh.pred_name = ap.hc
                  join nm na on na.competition = ap.competition and na.pred_name = ap.ac
                  join f on f.competition = ap.competition and f.fh = nh.fix_name and f.fa = na.fix_name""",
        "o2": f"""select ap.prediction_id, {', '.join('f.' + c for c in fcols.split(', '))} from ap
                  join nm nh on nh.competition = ap.competition and nh.pred_name = ap.ac
                  join nm na on na.competition = ap.competition and na.pred_name = ap.hc
                  join f on f.competition = ap.competition and f.fh = nh.fix_name and f.fa = na.fix_name""",
        "l1": _first("o1"),
        "l2": _first("(select o2.* from o2 join l1 on o2.prediction_id = l1.prediction_id "
                     "where o2.fixture_seq <> l1.fixture_seq) x"),
        "legs": """select l1.prediction_id, l1.fixture_seq as leg1_seq, l2.fixture_seq as leg2_seq,
                     l1.hg as h1, l1.ag as a1, l2.hg as h2, l2.ag as a2, l2.event_date,
                     (l1.hg is not null and l1.ag is not null and l2.hg is not null and l2.ag is not null) as usable
                   from l1 join l2 on l1.prediction_id = l2.prediction_id""",
        "two": """select prediction_id, leg1_seq, leg2_seq,
                    case when usable then h1 + a2 end as home_goals,
                    case when usable then a1 + h2 end as away_goals,
                    case when usable and h1 + a2 > a1 + h2 then 'H' when usable and h1 + a2 < a1 + h2 then 'A' end
                      as actual_result,
                    event_date,
                    case when not usable then 'unusable' when h1 + a2 = a1 + h2 then 'tied' else 'resolved' end
                      as status
                  from legs""",
        "res": """select p.prediction_id,
                    case when t.prediction_id is not null then 'aggregate' else 'single' end as source,
                    case when t.prediction_id is not null then t.home_goals else s.home_goals end as home_goals,
                    case when t.prediction_id is not null then t.away_goals else s.away_goals end as away_goals,
                    case when t.prediction_id is not null then t.actual_result else s.actual_result end as actual_result,
                    coalesce(case when t.prediction_id is not null then t.event_date else s.event_date end,
                             p.match_date) as match_date
                  from p left join (select * from two where status = 'resolved') t on t.prediction_id = p.prediction_id
                  left join single s on s.prediction_id = p.prediction_id
                  where t.prediction_id is not null or s.prediction_id is not null""",
    }


def overrides_ctes() -> dict[str, str]:
    return {
        "ovr": tv.oracle_sql(tv.OVERRIDES),
        "ov": """select trim(prediction_id) as prediction_id, cast(cast(home_goals as double) as integer) as home_goals,
                   cast(away_goals as integer) as away_goals,
                   trim(match_date) as match_date, trim(match_type) as match_type
                 from ovr where home_goals <> 'x'
                 qualify row_number() over (partition by trim(prediction_id) order by line_no desc) = 1""",
    }


def _lenient(x: str) -> str:
    return f"cast(try_strptime({x}, '%Y-%m-%d') as date)"


def _attached(pred_source: str, with_overrides: bool) -> str:
    """Rows of ``pred_source`` after override / resolution, scored (17 columns)."""
    if with_overrides:
        ovj = "left join ov on ov.prediction_id = x.prediction_id"
        has = "ov.prediction_id is not null"
        md = f"case when coalesce(ov.match_date <> '', false) then {_lenient('ov.match_date')} else x.match_date end"
        mt = "case when ov.match_type in ('single', 'knockout') then ov.match_type else x.match_type end"
        og, oa = "ov.home_goals", "ov.away_goals"
    else:
        ovj, has, md, mt, og, oa = "", "false", "x.match_date", "x.match_type", "null", "null"
    inner = f"""select x.prediction_id, x.video_id, x.publish_date,
          case when {has} then {md} when r.prediction_id is not null then r.match_date else x.match_date end as match_date,
          x.home_team, x.away_team, x.competition,
          case when {has} then {mt} else x.match_type end as match_type,
          cast(null as integer) as leg_number, x.pred_home_win_pct, x.pred_draw_pct, x.pred_away_win_pct,
          case when {has} then {result_code(og, oa)} else r.actual_result end as actual_result,
          cast(case when {has} then {og} else r.home_goals end as integer) as home_goals,
          cast(case when {has} then {oa} else r.away_goals end as integer) as away_goals,
          case when {has} or r.prediction_id is not null then timestamp '{RUN_TS}' end as fetched_at
        from {pred_source} x left join res r on r.prediction_id = x.prediction_id {ovj}"""
    return (f"select prediction_id, video_id, publish_date, match_date, home_team, away_team, competition, "
            f"match_type, leg_number, pred_home_win_pct, pred_draw_pct, pred_away_win_pct, actual_result, "
            f"home_goals, away_goals, {brier()} as brier_score, fetched_at from ({inner}) a")


def _new_batch(template: str = tv.NEW_BATCH) -> dict[str, str]:
    return {
        "nb0": tv.oracle_sql(template, v_predictions="v_predictions"),
        "nb": f"""select prediction_id, video_id, publish_date, match_date, home_team, away_team, competition,
                    match_type, cast(null as integer) as leg_number, pred_home_win_pct, pred_draw_pct,
                    pred_away_win_pct, actual_result, cast(null as integer) as home_goals,
                    cast(null as integer) as away_goals, {brier()} as brier_score, fetched_at from nb0""",
        "u": f"select {ROW_COLUMNS}, 0 as is_new from stored union all select {ROW_COLUMNS}, 1 as is_new from nb",
        "d": """select * from (select *, row_number() over (partition by prediction_id
                  order by fetched_at desc nulls last, is_new desc) as rn from u) t where rn = 1""",
    }


def _rows_ctes() -> dict[str, str]:
    ev = "concat('ev', lpad(cast(e as varchar), 9, '0'))"
    return {
        "ev": "select event_id as e, user_id as u, ts, event_type from events where event_id % 7 in (0, 3, 4, 6) and event_id % 13 not in (1, 5)",
        "rows0": f"""
          select concat({ev}, '_000') as prediction_id, {ev} as video_id, cast(ts as date) as publish_date,
                 case when e % 2 = 0 and e % 13 <> 7 then cast(ts as date) end as match_date,
                 case when e % 13 = 7 then '' else concat('NATION_', cast(e % 25 as varchar)) end as home_team,
                 case when e % 13 = 7 then '' else concat('nation_', cast((e + 3) % 25 as varchar)) end as away_team,
                 case when e % 7 = 3 or e % 13 = 7 then 'Unknown' else event_type end as competition,
                 cast(case e % 13 when 7 then 0 when 9 then null else 20 + e % 51 end as integer) as pred_home_win_pct,
                 cast(case e % 13 when 7 then 0 else (e * 3) % 30 end as integer) as pred_draw_pct,
                 cast(case e % 13 when 7 then 0 when 11 then null
                      else 80 - e % 51 - (e * 3) % 30 + case when e % 11 = 0 then 5 else 0 end end as integer) as pred_away_win_pct,
                 case when e % 13 = 7 then '' when e % 7 = 6 then null else concat('q', cast(e as varchar)) end as raw_quote,
                 case e % 13 when 7 then 'element' when 9 then 'percentage' when 11 then 'percentage' end as reject_reason
          from ev
          union all
          select concat({ev}, '_001'), {ev}, cast(ts as date), cast(null as date),
                 concat('nation_', cast((u + 1) % 25 as varchar)), concat('FC Nación_', cast(u % 25 as varchar)),
                 case when e % 7 = 3 then 'Unknown' else event_type end,
                 cast(10 + u % 61 as integer), cast(case when u % 4 = 0 then 0 else 25 end as integer),
                 cast(90 - u % 61 - case when u % 4 = 0 then 0 else 25 end as integer),
                 concat('r', cast(u as varchar)), null
          from ev""",
        "rows": f"""select *, cast(null as integer) as leg_number, concat('https://youtu.be/', video_id) as video_url,
                     date '{RUN_DATE}' as extracted_at,
                     case when pred_draw_pct = 0 then 'knockout' else 'single' end as match_type,
                     pred_home_win_pct + pred_draw_pct + pred_away_win_pct as pred_sum,
                     pred_home_win_pct + pred_draw_pct + pred_away_win_pct = 100 as pred_sum_ok,
                     reject_reason is not null as reject
                   from rows0""",
    }


def _page_ctes() -> dict[str, str]:
    """Landed pages, flat, and the rounds that the walk reaches (as windows; the library folds)."""
    return {
        "pe": tv.oracle_sql(tv.V_PAGE_EVENTS, v_fixtures="v_fixtures"),
        "pc": f"""select competition, season, round_no, count(*) filter (where not emptied) as n,
                    count(*) filter (where not emptied and status = 'Match Finished') as fin from pe group by all""",
        "pw": """select k.competition, k.season, cast(s.range as integer) as round_no, coalesce(pc.n, 0) as n, coalesce(pc.fin, 0) as fin
                 from (select distinct competition, season from pc) k cross join range(1, 25) s
                 left join pc on pc.competition = k.competition and pc.season = k.season and pc.round_no = s.range""",
        "pf": """select *, case when sum(case when n = 0 then 1 else 0 end) over (partition by competition, season order by round_no
                      rows between 2 preceding and current row) = 3 or (n > 0 and fin = 0) then 1 else 0 end as stop from pw""",
        "pk": """select competition, season, round_no, fin as n_finished from (
                   select *, sum(stop) over (partition by competition, season order by round_no) as stops from pf) c
                 where stops = 0 and fin > 0""",
    }


def _stats_sources() -> dict[str, str]:
    return {
        "sc": "select * from stored where brier_score is not null",
        "mm": f"select cast(date_trunc('month', publish_date) as date) as month, {sums()} from sc group by 1",
        "mq": f"""select month, {mean_u()} as avg, n, (month(month) - 1) % 3 + 1 as pos,
                    concat(year(month), '-Q', quarter(month)) as quarter from mm where month is not null""",
        "qq": f"""select quarter,
                    ((coalesce(max(case when pos = 1 then avg end), {_dbl(0.0)})
                      + coalesce(max(case when pos = 2 then avg end), {_dbl(0.0)}))
                      + coalesce(max(case when pos = 3 then avg end), {_dbl(0.0)})) / cast(count(*) as double) as avg_brier,
                    cast(sum(n) as bigint) as n
                  from mq group by quarter""",
        "quarters": f"""select quarter, avg_brier, n,
                    ((coalesce(lag(avg_brier, 2) over w, {_dbl(0.0)}) + coalesce(lag(avg_brier, 1) over w, {_dbl(0.0)}))
                      + avg_brier) / cast(least(row_number() over w, 3) as double) as rolling_avg,
                    cast(n as double) / cast((select sum(n) from mm) as double) * {_dbl(100.0)} as share_pct,
                    {gauge('avg_brier', 20)} as gauge_level,
                    {gauge('avg_brier', 20)} > 13 as above_threshold,
                    {trend('avg_brier')} as trend_level
                  from qq window w as (order by quarter)""",
        "summary": f"""select n as total_predictions, coalesce({mean_u()}, {_dbl(0.0)}) as all_time_avg_brier,
                      coalesce({std_u()}, {_dbl(0.0)}) as std_brier,
                      coalesce({pct_round()}, {_dbl(0.0)}) as accuracy_pct,
                      coalesce(n >= 100 and {mean_u()} < {_dbl(0.20)}, false)
                        as is_superforecaster
                    from (select {sums()}, sum({hit()}) as hits from sc) m""",
        "summary2": f"""select *, case when std_brier < {_dbl(0.08)} then 'low' when std_brier > {_dbl(0.14)} then 'high'
                       else 'medium' end as consistency from summary""",
        "bins": f"""select least(14, greatest(0, cast(trunc(brier_score / {_dbl(0.025)}) as integer))) as bin,
                      brier_score from sc""",
        "hagg": f"select {sums()}, max(bin) as last_bin from bins",
    }


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    st = _stats_sources()
    q["summary_stats"] = ctes(**st) + "select * from summary2"
    q["score_predictions"] = ctes() + f"select prediction_id, match_type, actual_result, {brier()} as brier_score from v_predictions"
    q["brier_3way"] = ctes() + (f"select prediction_id, {brier(mt=chr(39) + 'single' + chr(39))} as brier_3way "
                                "from v_predictions where actual_result is not null")
    q["brier_2way"] = ctes() + (f"select prediction_id, {brier(mt=chr(39) + 'knockout' + chr(39))} as brier_2way "
                                "from v_predictions where actual_result is not null")
    q["scored_rows"] = ctes() + "select * from stored where brier_score is not null"
    q["list_pending"] = ctes() + (f"select prediction_id, competition, home_team, away_team, match_type, match_date, "
                                  f"publish_date from stored where actual_result is null and publish_date is not null "
                                  f"and publish_date <= date '{AS_OF}'")
    q["classify_match_type"] = ctes() + ("select prediction_id, pred_draw_pct, case when pred_draw_pct = 0 then "
                                         "'knockout' when pred_draw_pct is not null then 'single' end as match_type "
                                         "from v_predictions")
    q["result_code"] = ctes() + (f"select fixture_seq, try_cast(home_score as integer) as home_goals, "
                                 f"try_cast(away_score as integer) as away_goals, "
                                 f"{result_code('try_cast(home_score as integer)', 'try_cast(away_score as integer)')}"
                                 f" as actual_result from v_fixtures")
    q["competition_breakdown"] = ctes(**st) + f"""
        select competition, substring(coalesce(competition, 'None'), 1, 22) as competition_label,
               {mean_u()} as avg_brier, n,
               cast(n as double) / cast(sum(n) over () as double) * {_dbl(100.0)} as share_pct,
               {gauge(mean_u(), 16)} as gauge_level, {gauge(mean_u(), 16)} > 10 as above_threshold
        from (select competition, {sums()} from sc group by competition) m"""
    q["accuracy_by_competition"] = ctes(**st) + f"""
        select competition, n, hits, {pct_round()} as accuracy_pct
        from (select competition, count(brier_score) as n, cast(sum({hit()}) as bigint) as hits
              from sc group by competition) m"""
    q["monthly_trend"] = ctes(**st) + (f"select month, {mean_u()} as avg_brier_score, n as prediction_count "
                                       f"from mm where month is not null")
    q["quarterly_trend"] = ctes(**st) + "select * from quarters"
    q["trend_direction"] = ctes(**st) + """
        select n_quarters, first_avg, last_avg,
               case when last_avg < first_avg then 'improving' else 'worsening' end as direction
        from (select count(*) as n_quarters, arg_min(avg_brier, quarter) as first_avg,
                     arg_max(avg_brier, quarter) as last_avg
              from (select *, row_number() over (order by quarter desc) as r from quarters) t where r <= 3) a
        where n_quarters > 0"""
    lo = f"({_dbl(0.0)} + cast(s.bin as double) * {_dbl(0.025)})"
    q["brier_histogram"] = ctes(**st) + f"""
        select s.bin, {lo} as bin_lo, {lo} + {_dbl(0.025)} as bin_hi, coalesce(c.cnt, 0) as n,
               cast(coalesce(c.cnt, 0) as double) / cast(h.n as double) * {_dbl(100.0)} as pct,
               cast(trunc(cast(coalesce(c.cnt, 0) as double)
                          / cast(max(coalesce(c.cnt, 0)) over () as double) * {_dbl(24.0)}) as integer) as bar_level
        from (select cast(range as integer) as bin from range(0, 15)) s
        left join (select bin, count(*) as cnt from bins group by bin) c on c.bin = s.bin
        join hagg h on s.bin <= h.last_bin"""
    pos = lambda v: (f"greatest(0, least(67, cast(round_even(({v} - {_dbl(0.0)}) / (ruler_hi - {_dbl(0.0)}) "  # noqa: E731
                     f"* {_dbl(67.0)}, 0) as integer)))")
    q["distribution_markers"] = ctes(**st) + f"""
        select mean, std, mean - std as lo_value, mean + std as hi_value, ruler_hi,
               {pos('mean - std')} as lo_pos, {pos('mean')} as mean_pos, {pos('mean + std')} as hi_pos
        from (select mean, std, greatest({_dbl(0.0)} + cast(last_bin + 1 as double) * {_dbl(0.025)},
                                         mean + std + {_dbl(0.025)}) as ruler_hi
              from (select {mean_u()} as mean, coalesce({std_u()}, {_dbl(0.0)}) as std, last_bin
                    from hagg where n > 0) a) b"""
    q["benchmark_comparison"] = ctes(**st) + f"""
        select b.benchmark, b.value, s.all_time_avg_brier as model_brier, s.all_time_avg_brier - b.value as delta,
               s.all_time_avg_brier < b.value as model_better
        from summary s join (values ('naive_baseline', {_dbl(0.2222)}), ('bookmaker', {_dbl(0.19)}),
                                    ('threshold', {_dbl(0.20)})) b(benchmark, value) on true"""
    recent = ("select prediction_id, publish_date, home_team, away_team, pred_home_win_pct, pred_draw_pct, "
              "pred_away_win_pct, actual_result, brier_score from stored where brier_score is not null "
              "order by publish_date desc nulls last, prediction_id desc limit 15")
    q["recent_predictions"] = ctes() + recent
    q["recent_display"] = ctes(recent=recent) + f"""
        select prediction_id, coalesce(strftime(publish_date, '%Y-%m-%d'), '') as date_label,
               substring(coalesce(home_team, 'None'), 1, 13) as home_label,
               substring(coalesce(away_team, 'None'), 1, 13) as away_label,
               concat_ws('/', cast(pred_home_win_pct as varchar), cast(pred_draw_pct as varchar),
                         cast(pred_away_win_pct as varchar)) as probs,
               actual_result, brier_score, brier_score > {_dbl(0.20)} as above_threshold
        from recent"""
    q["parse_video_id"] = ctes(pu=tv.oracle_sql(tv.PAGE_URLS)) + (
        "select page_id, nullif(regexp_extract(url, '" + VIDEO_ID_RE + "', 1), '') as video_id from pu")
    q["normalise_team"] = ctes() + f"""
        select name, {canon('name')} as canonical from (
          select home_team as name from v_predictions union select away_team from v_predictions
          union select home_team from v_fixtures union select away_team from v_fixtures) n"""
    r = resolution()
    q["team_name_map"] = ctes(**r) + "select competition, pred_name, fix_name from nm"
    q["infer_season"] = ctes() + (f"select prediction_id, competition, "
                                  f"{season('competition', 'coalesce(match_date, publish_date)')} as season "
                                  f"from v_predictions")
    q["fetch_plan"] = ctes(**r) + "select competition, season from plan"
    q["unsupported_competitions"] = ctes() + (f"select distinct competition from v_predictions "
                                              f"where competition is null or competition not in ({SUPPORTED})")
    q["round_cutoff"] = ctes(vr=tv.oracle_sql(tv.V_ROUNDS)) + f"""
        , walk as (
          select k.competition, k.season, cast(s.range as integer) as round_no,
                 coalesce(v.n_events, 0) as n, coalesce(v.n_finished, 0) as fin
          from (select distinct competition, season from vr) k
          cross join range(1, 25) s
          left join vr v on v.competition = k.competition and v.season = k.season and v.round_no = s.range),
        flags as (
          select *, case when sum(case when n = 0 then 1 else 0 end) over (partition by competition, season
                      order by round_no rows between 2 preceding and current row) = 3
                      or (n > 0 and fin = 0) then 1 else 0 end as stop
          from walk),
        cum as (
          select *, sum(stop) over (partition by competition, season order by round_no
                                    rows between unbounded preceding and current row) as stops from flags)
        select competition, season, round_no, fin as n_finished from cum where stops = 0 and fin > 0"""
    q["resolve_single_leg"] = ctes(**r) + "select * from single"
    q["resolve_two_leg"] = ctes(**r) + "select * from two"
    q["tied_aggregates"] = ctes(**r) + ("select prediction_id, leg1_seq, leg2_seq, home_goals as team1_total, "
                                        "away_goals as team2_total from two where status = 'tied'")
    q["resolve_results"] = ctes(**r) + "select * from res"
    ov = overrides_ctes()
    q["conform_overrides"] = ctes(**ov) + "select * from ov"
    q["apply_overrides"] = ctes(**ov) + f"""
        select prediction_id, home_goals, away_goals, actual_result, match_date, match_type,
               pred_home_win_pct, pred_draw_pct, pred_away_win_pct, {brier()} as brier_score
        from (select v.prediction_id, ov.home_goals, ov.away_goals,
                     {result_code('ov.home_goals', 'ov.away_goals')} as actual_result,
                     case when coalesce(ov.match_date <> '', false) then {_lenient('ov.match_date')}
                          else v.match_date end as match_date,
                     case when ov.match_type in ('single', 'knockout') then ov.match_type else v.match_type end
                       as match_type,
                     v.pred_home_win_pct, v.pred_draw_pct, v.pred_away_win_pct
              from v_predictions v join ov on v.prediction_id = ov.prediction_id) a"""
    q["attach_results"] = ctes(**r, **ov) + _attached("v_predictions", True)
    rp = resolution("pending")
    q["refresh_pending"] = ctes(pending="select * from stored where actual_result is null", **rp) + (
        f"select {ROW_COLUMNS} from stored where actual_result is not null union all "
        + _attached("pending", False))
    q["new_videos"] = ctes(vl=tv.oracle_sql(tv.VIDEO_LIST)) + (
        "select video_id, min(video_url) as video_url from (select nullif(regexp_extract(video_url, '"
        + VIDEO_ID_RE + "', 1), '') as video_id, video_url from vl) i "
        "where video_id is not null and video_id not in (select video_id from stored where video_id is not null) "
        "group by video_id")
    nb = _new_batch()
    q["dedupe_latest"] = ctes(**nb) + "select prediction_id, actual_result, fetched_at, is_new from d"
    q["upsert_predictions"] = ctes(**nb) + f"select {ROW_COLUMNS} from d"
    counters = """
        select (select count(*) from stored) as existing_rows,
               (select count(distinct video_id) from stored) as existing_videos,
               (select count(*) from nb) as new_rows,
               (select count(*) from d where brier_score is not null) as scored,
               (select count(*) from d where brier_score is null) as pending"""
    q["run_counters"] = ctes(**_new_batch(tv.WHOLE_BATCH)) + counters
    q["transcript_assembly"] = """
        with ranked as (select conv_id, turn, role, text, case role when 'assistant' then 1 when 'user' then 2 end as rk
                        from conversations where role in ('assistant', 'user')),
             best as (select conv_id, min(rk) as rk from ranked group by conv_id)
        select r.conv_id, min(r.role) as lang, string_agg(r.text, ' ' order by r.turn) as transcript
        from ranked r join best b on r.conv_id = b.conv_id and r.rk = b.rk group by r.conv_id"""
    q["extraction_requests"] = f"""
        select doc_id, cast(k + 1 as integer) as request_no, cast(n as integer) as n_requests, req as request,
               truncated, cast(length(req) as integer) as request_chars
        from (select doc_id, k, n, concat('Extract all match predictions from this transcript:', chr(10), chr(10),
                                          substring(text, k * 50000 + 1, 50000)) as req,
                     length(text) > 50000 as truncated
              from (select doc_id, text, n, unnest(range(n)) as k
                    from (select doc_id, text, greatest(1, (coalesce(length(text), 0) + 49999)
                                                           // 50000) as n from documents) c) p) d"""
    q["parse_responses"] = """
        select video_id, parse_error is null as parse_ok, parse_error,
               cast(case when parse_error is null and r <> 5 then 2 else 0 end as integer) as n_predictions
        from (select concat('ev', lpad(cast(event_id as varchar), 9, '0')) as video_id, event_id % 7 as r,
                     case when event_id % 7 = 2 then 'not_array' when event_id % 7 = 1 then 'json' when event_id % 7 = 5 then null
                          when event_id % 13 in (1, 5) then 'json' end as parse_error from events) e"""
    rows = _rows_ctes()
    q["build_prediction_rows"] = ctes(**rows) + f"""
        select prediction_id, video_id, video_url, publish_date, match_date, home_team, away_team, competition, match_type,
               leg_number, pred_home_win_pct, pred_draw_pct, pred_away_win_pct, pred_sum, pred_sum_ok, raw_quote,
               extracted_at, reject, reject_reason from rows"""
    q["pred_sum_check"] = ctes(**rows) + """
        select competition, count(*) as n, count(*) filter (where pred_sum_ok) as n_sum_ok,
               count(*) filter (where not pred_sum_ok) as n_sum_bad from rows where not reject group by competition"""
    elem = """concat('{"away_team":"nation_', cast((event_id + 3) % 25 as varchar), '",',
                     case when event_id % 7 = 3 then '' else concat('"competition":"', event_type, '",') end,
                     '"home_team":"NATION_', cast(event_id % 25 as varchar), '","match_date":"',
                     case when event_id % 2 = 0 then cast(cast(ts as date) as varchar) else '' end,
                     '","pred_away_win_pct":', case when event_id % 13 = 11 then 'null' else
                       cast(80 - event_id % 51 - (event_id * 3) % 30 + case when event_id % 11 = 0 then 5 else 0 end as varchar) end,
                     ',"pred_draw_pct":', case when event_id % 7 = 4 then concat('"', cast((event_id * 3) % 30 as varchar), '"')
                                               else cast((event_id * 3) % 30 as varchar) end,
                     ',"pred_home_win_pct":', case when event_id % 13 = 9 then '"abc"' else concat(cast(20 + event_id % 51 as varchar),
                       case when event_id % 7 = 4 then '.9' else '' end) end,
                     ',"raw_quote":', case when event_id % 7 = 6 then 'null' else concat('"q', cast(event_id as varchar), '"') end, '}')"""
    q["rejected_rows"] = f"""
        select concat('ev', lpad(cast(event_id as varchar), 9, '0')) as video_id, cast(null as integer) as pos,
               case when event_id % 7 = 2 then 'not_array' else 'json' end as reject_reason, cast(null as varchar) as element
        from events where event_id % 7 in (1, 2) or (event_id % 7 <> 5 and event_id % 13 in (1, 5))
        union all
        select concat('ev', lpad(cast(event_id as varchar), 9, '0')), 0, case when event_id % 13 = 7 then 'element' else 'percentage' end,
               case when event_id % 13 = 7 then '7' else {elem} end
        from events where event_id % 7 in (0, 3, 4, 6) and event_id % 13 in (7, 9, 11)"""
    pages = _page_ctes()
    q["rounds_from_pages"] = ctes(**pages) + "select competition, season, round_no, n_finished from pk"
    q["landed_fixtures"] = ctes(**pages, **resolution()) + f"""
        , pl as (select competition, season, row_number() over (order by publish_date nulls last, prediction_id) as plan_no
                 from (select *, row_number() over (partition by competition, season order by publish_date nulls last, prediction_id) as r from p) x
                 where r = 1)
        select row_number() over (order by plan_no, pe.round_no, fixture_seq) as fixture_seq, pe.competition, pe.season, pe.round_no,
               home_team, away_team, home_score, away_score, event_date, status
        from pe join pk on pk.competition = pe.competition and pk.season = pe.season and pk.round_no = pe.round_no
        join pl on pl.competition = pe.competition and pl.season = pe.season
        where not emptied and status = 'Match Finished'"""
    rd = resolution("pending")
    gained = f"fixture_seq in (select fixture_seq from v_fixtures where event_date >= date '{tv.GAINED_FROM}')"
    q["refresh_delta"] = ctes(pending="select * from stored where actual_result is null", **rd,
                              concerned=f"select prediction_id from cand where {gained} union select prediction_id from o1 where {gained} "
                                        f"union select prediction_id from o2 where {gained}",
                              few="select pending.* from pending join concerned on pending.prediction_id = concerned.prediction_id") + (
        "select * from (" + _attached("few", False) + ") a where actual_result is not null")
    q["video_list_csv"] = ctes(vl=tv.oracle_sql(tv.VIDEO_LIST)) + "select video_url from vl where right(video_url, 1) <> '7'"
    q["overrides_csv"] = q["conform_overrides"]
    q["published_table"] = q["upsert_predictions"]
    q["publish_counters"] = ctes(**nb) + counters
    q["dry_run"] = "select (select count(*) from (" + ctes() + "select * from stored)) as rows_left, c.* from (" + q["publish_counters"] + ") c"
    q["report_cube"] = ctes(**st) + f"""
        select competition, cast(date_trunc('month', publish_date) as date) as month,
               least(14, greatest(0, cast(trunc(brier_score / {_dbl(0.025)}) as integer))) as bin, count(*) as n,
               cast(sum(round(brier_score * 10000)) as bigint) as s1,
               cast(sum(round(brier_score * 10000) * round(brier_score * 10000)) as bigint) as s2,
               cast(sum({hit()}) as bigint) as hits from sc group by all"""
    q["extract_job"] = ctes(vl=tv.oracle_sql(tv.VIDEO_LIST)) + f"""
        , todo as (select video_id, min(video_url) as video_url
                   from (select nullif(regexp_extract(video_url, '{VIDEO_ID_RE}', 1), '') as video_id, video_url from vl) i
                   where video_id is not null
                     and video_id not in (select video_id from stored where cast(video_id as bigint) % 3 = 0) group by video_id),
        seg as (select lpad(cast(conv_id as varchar), 11, '0') as video_id, role, text, turn,
                       min(case role when 'assistant' then 1 else 2 end) over (partition by conv_id) = case role when 'assistant' then 1 else 2 end as best
                from conversations where role in ('assistant', 'user')),
        tr as (select video_id, min(role) as lang, string_agg(text, ' ' order by turn) as t from seg where best group by video_id)
        select video_id, video_url, publish_date, title, lang, cast(k + 1 as integer) as request_no, cast(n as integer) as n_requests,
               concat('Extract all match predictions from this transcript:', chr(10), chr(10), substring(t, k * 50000 + 1, 50000)) as request
        from (select *, unnest(range(n)) as k
              from (select todo.video_id, video_url, cast(cast(o_orderdate as date) as varchar) as publish_date, o_orderpriority as title,
                           lang, t, greatest(1, (length(t) + 49999) // 50000) as n
                    from todo join tr on tr.video_id = todo.video_id
                    join orders on lpad(cast(o_orderkey as varchar), 11, '0') = todo.video_id where o_orderkey % 9 <> 0) a) b"""
    q["video_metadata"] = """
        select lpad(cast(o_orderkey as varchar), 11, '0') as video_id,
               cast(cast(o_orderdate as date) as varchar) as publish_date, o_orderpriority as title
        from orders where o_orderkey % 9 <> 0"""
    return q
