"""Resolve predictions against finished fixtures, apply overrides, score.

Plan shape (see README "Resolution at scale"):

* canonical names are computed once per distinct name of a competition and joined
  back, by broadcast where the names are few, by a shuffle where they are many
  (inline, once per row and branch, where nothing is materialised); fuzzy equality
  is an equi-join through ``names.name_map`` (no nested loop);
* fixtures are first reduced to the first per (teams, day), predictions to the
  distinct questions they ask (names, interval); the answers are joined back;
* the date rule becomes an interval per question and a 46-day bucket per
  fixture, so the candidate join is an equi-join on
  (competition, home key, away key, bucket) plus a residual range test, with
  both sides bounded per key by the days of a bucket;
* "first fixture in source order" is ``min_by(field, fixture_seq)``, a hash
  aggregate with map-side partial aggregation;
* two-leg ties only need the two earliest fixtures per (competition, home,
  away), a ``row_number() <= 2`` that Spark turns into a map-side group limit;
* an empty canonical name matches every team: it has one key of its own, under
  which each fixture stands too, instead of being expanded to every team.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..dims import Dictionaries
from ..functions.dates import infer_season, lenient_date
from ..functions.scoring import brier_score, result_code
from ..functions.text import canonical_name, strip_ws
from ..session import materialize as _materialize
from ..session import release_materialized, scratch_inputs
from ..sources.schema import conform
from .names import name_map

BUCKET_DAYS = 46  # wider than the 45-day window: an interval touches <= 2 buckets
# buckets of a fixture without a date, and of the first fixture of all days; no day's bucket is this low
NO_DATE_BUCKET = -1_000_000_000
EVERY_DAY_BUCKET = -2_000_000_000

TEAMS = ["home_team", "away_team"]
FIXTURE_FIELDS = ["fixture_seq", "_hg", "_ag", "event_date"]


# --------------------------------------------------------------------------- inputs

def _dating(preds: DataFrame) -> tuple[Column, Column, Column]:
    """(is_dated, parsed match date, season reference date).

    With a raw ``match_date_text`` column (fresh extraction), a non-empty but
    unparsable text still counts as dated (the date rule is then skipped).
    """
    if "match_date_text" in preds.columns:
        txt = F.col("match_date_text")
        dated = F.coalesce(txt != "", F.lit(False))
        mdate = lenient_date(txt)
        ref = F.when(dated, mdate).otherwise(F.col("publish_date"))
    else:
        dated = F.col("match_date").isNotNull()
        mdate = F.col("match_date")
        ref = F.coalesce(F.col("match_date"), F.col("publish_date"))
    return dated, mdate, ref


def dated_predictions(preds: DataFrame, d: Dictionaries, run_date: str) -> DataFrame:
    """Adds the season and the admissible fixture-date interval."""
    dated, mdate, ref = _dating(preds)
    pub = F.col("publish_date")
    lo = F.when(dated, F.date_sub(mdate, dims.DATED_TOLERANCE_DAYS)).otherwise(pub)
    hi = F.when(dated, F.date_add(mdate, dims.DATED_TOLERANCE_DAYS)).otherwise(
        F.date_add(pub, dims.UNDATED_WINDOW_DAYS))
    return preds.select(
        "*",
        infer_season(F.col("competition"), ref, run_date, d).alias("_season"),
        mdate.alias("_mdate"),
        lo.alias("_lo"), hi.alias("_hi"))


def prepare_predictions(preds: DataFrame, d: Dictionaries, run_date: str) -> DataFrame:
    """Adds canonical names, season and the admissible fixture-date interval."""
    return dated_predictions(preds, d, run_date).select(
        "*", *[canonical_name(F.col(c), d).alias(out) for c, out in zip(TEAMS, ("_hc", "_ac"))])


def finished_fixtures(fixtures: DataFrame, d: Dictionaries, run_date: str,
                      kept_rounds: DataFrame | None = None) -> DataFrame:
    """Finished fixtures with parsed scores and a season."""
    fx = fixtures.where(F.col("status") == d.finished_status)
    if kept_rounds is not None:
        if "round_no" not in fixtures.columns:
            raise ValueError("the round cut-off needs a round_no in each fixture")
        fx = fx.join(kept_rounds.select("competition", "season", "round_no"),
                     ["competition", "season", "round_no"], "left_semi")
    season = infer_season(F.col("competition"), F.col("event_date"), run_date, d)
    if "season" in fixtures.columns:
        season = F.coalesce(F.col("season").cast("string"), season)
    return fx.select(
        "fixture_seq", "competition", season.alias("season"), *TEAMS,
        F.col("home_score").cast("string").try_cast("int").alias("_hg"),
        F.col("away_score").cast("string").try_cast("int").alias("_ag"),
        "event_date")


def prepare_fixtures(fixtures: DataFrame, d: Dictionaries, run_date: str,
                     kept_rounds: DataFrame | None = None) -> DataFrame:
    """Finished fixtures with canonical names, parsed scores and a season."""
    fx = finished_fixtures(fixtures, d, run_date, kept_rounds)
    return fx.select(*[c for c in fx.columns if c not in TEAMS],
                     *[canonical_name(F.col(c), d).alias(out) for c, out in zip(TEAMS, ("_fh", "_fa"))])


def supported(df: DataFrame, d: Dictionaries) -> DataFrame:
    return df.where(F.col("competition").isin(*d.leagues.keys()))


def unsupported_competitions(preds: DataFrame, d: Dictionaries) -> DataFrame:
    """Distinct competitions with no league id: they stay pending."""
    return (preds.where(~F.col("competition").isin(*d.leagues.keys()) | F.col("competition").isNull())
            .select("competition").distinct())


def fetch_plan(prepared: DataFrame, d: Dictionaries) -> DataFrame:
    """Distinct (competition, season) to load fixtures for."""
    return supported(prepared, d).select("competition", F.col("_season").alias("season")).distinct()


def fixtures_in_plan(fx: DataFrame, plan: DataFrame) -> DataFrame:
    return fx.join(plan, ["competition", "season"], "left_semi")


# --------------------------------------------------------------------------- round cut-off

def round_cutoff(rounds: DataFrame, d: Dictionaries) -> DataFrame:
    """Rounds whose finished fixtures are loaded, per (competition, season).

    Walk rounds 1..max: an empty round extends a streak and the third
    consecutive empty round stops the walk; a round with events but none
    finished stops it too.  Rounds before the stop contribute their finished
    events.  Input: (competition, season, round_no, n_events, n_finished).
    """
    max_r = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in d.max_rounds.items() for x in kv]),
                         F.col("competition")) if d.max_rounds else F.lit(None).cast("int"),
        F.lit(d.default_max_rounds))
    keys = rounds.select("competition", "season").distinct()
    spine = keys.select("competition", "season",
                        F.explode(F.sequence(F.lit(1), max_r)).alias("round_no"))
    walk = spine.join(rounds, ["competition", "season", "round_no"], "left")
    n = F.coalesce(F.col("n_events"), F.lit(0))
    fin = F.coalesce(F.col("n_finished"), F.lit(0))
    w = Window.partitionBy("competition", "season").orderBy("round_no")
    empty = F.when(n == 0, 1).otherwise(0)
    third_empty = F.sum(empty).over(w.rowsBetween(-(dims.EMPTY_ROUND_STREAK - 1), 0)) == dims.EMPTY_ROUND_STREAK
    stop = F.when(third_empty | ((n > 0) & (fin == 0)), 1).otherwise(0)
    walked = walk.select("competition", "season", "round_no", fin.alias("n_finished"), stop.alias("_stop"))
    return (walked.withColumn("_stops", F.sum("_stop").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .where((F.col("_stops") == 0) & (F.col("n_finished") > 0))
            .select("competition", "season", "round_no", "n_finished"))


# --------------------------------------------------------------------------- candidates

def _spelled_names(p: DataFrame, fx: DataFrame, d: Dictionaries) -> DataFrame:
    """(of_fixture, competition, raw, name): each spelling of a team on either side once, with its canonical name."""
    def spelled(df, of_fixture):
        return df.select(F.lit(of_fixture).alias("of_fixture"), "competition", F.explode(F.array(*TEAMS)).alias("raw"))

    each = spelled(p, False).unionByName(spelled(fx, True)).distinct()
    return each.select("*", canonical_name(F.col("raw"), d).alias("name"))


def _with_names(df: DataFrame, spelled: DataFrame, outs: tuple[str, str]) -> DataFrame:
    """``df`` with the canonical names of its teams in place of their spellings."""
    for c, out in zip(TEAMS, outs):
        df = df.join(spelled.select("competition", F.col("raw").alias(c), F.col("name").alias(out)), ["competition", c], "left")
    return df.drop(*TEAMS)


def _by_name(p: DataFrame, fx: DataFrame, d: Dictionaries, materialize: bool):
    """(predictions, fixtures, name map) with canonical names, from dated predictions and finished fixtures.

    With ``materialize`` the names of both sides are collected and canonicalised once and stored beside their pairs
    (those have no ``of_fixture``), so that the planner knows their size: it broadcasts a small vocabulary, and
    shuffles by name where it is large. Every competition is known here.
    """
    if not materialize:
        p, fx = (df.select("*", *[canonical_name(F.col(c), d).alias(out) for c, out in zip(TEAMS, outs)]).drop(*TEAMS)
                 for df, outs in ((p, ("_hc", "_ac")), (fx, ("_fh", "_fa"))))
        return p, fx, _names(p, fx)
    of_fixture = F.col("of_fixture")
    spelled = _materialize(_spelled_names(p, fx, d), "names")
    names = spelled.select("of_fixture", "competition", "name")
    pairs = name_map(names.where(~of_fixture & (F.col("name") != "")), names.where(of_fixture))
    stored = _materialize(spelled.unionByName(pairs.withColumnRenamed("pred_name", "name"), allowMissingColumns=True), "name-map")
    release_materialized(p.sparkSession, scratch_inputs(spelled))
    nm = stored.where(of_fixture.isNull()).select("competition", F.col("name").alias("pred_name"), "fix_name")
    return (_with_names(p, stored.where(~of_fixture), ("_hc", "_ac")),
            _with_names(fx, stored.where(of_fixture), ("_fh", "_fa")), nm)


def _names(p: DataFrame, fx: DataFrame) -> DataFrame:
    """The name map of both sides; a prediction's empty name has a key of its own and needs no pairs."""
    pn = (p.select("competition", F.col("_hc").alias("name"))
          .unionByName(p.select("competition", F.col("_ac").alias("name"))))
    xn = (fx.select("competition", F.col("_fh").alias("name"))
          .unionByName(fx.select("competition", F.col("_fa").alias("name"))))
    return name_map(pn.where(F.col("name") != ""), xn)


ANY = "*"   # join key of "every team"; a team's key is "=" and its name, so no name can be it


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / F.lit(BUCKET_DAYS))


def _day_bucket(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _team_keys(name: str) -> Column:
    """The keys a fixture side is found under: its name, and "every team"."""
    return F.array(F.concat(F.lit("="), F.col(name)), F.lit(ANY))


def _with_keys(q: DataFrame, nm: DataFrame, name: str, out: str) -> DataFrame:
    """``q`` with the fixture keys of its names: those the name map pairs with the name, or for an empty
    name, which every name contains, the one key of every team."""
    named = nm.where(F.col("pred_name") != "").select("competition", F.col("pred_name").alias(name), "fix_name")
    key = F.when(F.col(name) == "", F.lit(ANY)).otherwise(F.concat(F.lit("="), F.col("fix_name")))
    return (q.join(named, ["competition", name], "left").withColumn(out, key)
            .where(F.col(out).isNotNull()).drop("fix_name"))


def _first(df: DataFrame, by: list[str]) -> DataFrame:
    """The fixture with the smallest ``fixture_seq`` per ``by``.

    One ``min_by`` per fixed-width field (all ordered by the same, unique
    sequence, so they pick the same fixture): fixed-width buffers keep this a
    hash aggregate with partial aggregation, where a struct-valued ``min_by``
    would fall back to a sort aggregate.
    """
    seq = F.col("fixture_seq")
    return df.groupBy(*by).agg(
        *[F.min_by(F.col(c), seq).alias(c) for c in FIXTURE_FIELDS if c not in ("fixture_seq", *by)],
        F.min(seq).alias("fixture_seq"))


def _answers(p: DataFrame, answers: DataFrame, on: list[str]) -> DataFrame:
    """(prediction_id, answer fields) for the predictions whose question has an answer."""
    a = answers.select(*[F.col(c).alias("q" + c) if c in on else F.col(c) for c in answers.columns])
    cond = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col("q" + c)) for c in on])
    return p.select("prediction_id", *on).join(a, cond).drop(*on, *["q" + c for c in on])


# --------------------------------------------------------------------------- matching

def first_fixtures(fx: DataFrame) -> DataFrame:
    """Usable fixtures reduced to the first per (competition, home key, away key, day).

    Fixtures that agree on these are interchangeable for "the first in source
    order", so a pair of teams keeps one row a day however many fixtures it has.
    ``_b`` is the day's bucket, ``NO_DATE_BUCKET`` for undated fixtures (they
    suit every interval) or ``EVERY_DAY_BUCKET`` for the first of all days,
    which a prediction without a usable date takes; ``_day`` is the day to test.
    """
    usable = fx.where(F.col("_hg").isNotNull() & F.col("_ag").isNotNull())
    daily = _first(usable, ["competition", "_fh", "_fa", "event_date"])
    days = F.array(
        F.struct(F.coalesce(_bucket(F.col("event_date")), _day_bucket(NO_DATE_BUCKET)).alias("_b"),
                 F.col("event_date").alias("_day")),
        F.struct(_day_bucket(EVERY_DAY_BUCKET).alias("_b"), F.lit(None).cast("date").alias("_day")))
    wide = (daily.withColumn("_kh", F.explode(_team_keys("_fh"))).withColumn("_ka", F.explode(_team_keys("_fa")))
            .select("competition", "_kh", "_ka", *FIXTURE_FIELDS, F.inline(days)))
    return _first(wide, ["competition", "_kh", "_ka", "_b", "_day"])


def single_leg_questions(p: DataFrame) -> DataFrame:
    """What the predictions ask, each question once: names and interval of days."""
    return p.select("competition", "_hc", "_ac", "_lo", "_hi").distinct()


def single_leg_candidates(q: DataFrame, fx: DataFrame, nm: DataFrame) -> DataFrame:
    """(question, fixture) pairs that pass names, date rule and usable scores.

    Both sides of the join are bounded per key by days, not rows: at most one
    fixture a day, at most one question per interval. The pairs grow with the
    distinct questions.
    """
    dated = F.array_distinct(F.array(_bucket(F.col("_lo")), _bucket(F.col("_hi")), _day_bucket(NO_DATE_BUCKET)))
    probes = F.when(F.col("_lo").isNull(), F.array(_day_bucket(EVERY_DAY_BUCKET))).otherwise(dated)
    asked = _with_keys(_with_keys(q, nm, "_hc", "_kh"), nm, "_ac", "_ka").withColumn("_b", F.explode(probes))
    return (asked.join(first_fixtures(fx), ["competition", "_kh", "_ka", "_b"])
            .where(F.col("_day").isNull() | F.col("_day").between(F.col("_lo"), F.col("_hi")))
            .select(*q.columns, *FIXTURE_FIELDS))


def resolve_single_leg(p: DataFrame, fx: DataFrame, nm: DataFrame) -> DataFrame:
    """(prediction_id, fixture_seq, home_goals, away_goals, actual_result, event_date)."""
    q = single_leg_questions(p)
    found = _first(single_leg_candidates(q, fx, nm), q.columns)
    first = _first(_answers(p, found, q.columns), ["prediction_id"])
    return first.select(
        "prediction_id", "fixture_seq", F.col("_hg").alias("home_goals"), F.col("_ag").alias("away_goals"),
        result_code(F.col("_hg"), F.col("_ag")).alias("actual_result"), "event_date")


def _two_earliest(fx: DataFrame) -> DataFrame:
    """The two earliest fixtures per (competition, home key, away key): first per pair of teams,
    a map-side group limit, then of those per key."""
    def two(df, *keys):
        w = Window.partitionBy("competition", *keys).orderBy("fixture_seq")
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2).drop("_rn")

    pairs = two(fx.select("competition", "_fh", "_fa", *FIXTURE_FIELDS), "_fh", "_fa")
    wide = (pairs.withColumn("_kh", F.explode(_team_keys("_fh"))).withColumn("_ka", F.explode(_team_keys("_fa")))
            .select("competition", "_kh", "_ka", *FIXTURE_FIELDS))
    return two(wide, "_kh", "_ka")


def resolve_two_leg(p: DataFrame, fx: DataFrame, nm: DataFrame, d: Dictionaries) -> DataFrame:
    """Aggregate resolution of knockout ties in the aggregate competitions.

    leg1 = first fixture in the predicted orientation; leg2 = first fixture in
    the reversed orientation other than leg1 (no date rule, scores not
    prechecked).  Returns one row per candidate having both legs, with
    ``status`` in {resolved, tied, unusable}.
    """
    on = ["competition", "_hc", "_ac"]
    cand = p.where((F.col("match_type") == "knockout")
                   & F.col("competition").isin(*d.aggregate_competitions))
    q = cand.select(*on).distinct()
    earliest = _two_earliest(fx)

    def orientation(home_col, away_col):
        asked = _with_keys(_with_keys(q, nm, home_col, "_kh"), nm, away_col, "_ka")
        return asked.join(earliest, ["competition", "_kh", "_ka"]).select(*on, *FIXTURE_FIELDS)

    def leg(df, n, by):
        return _first(df, by).withColumnsRenamed({c: f"l{n}_{c}" for c in FIXTURE_FIELDS})

    # the first leg's fields stay beside the second leg's candidates: each orientation is read once, and both
    # read the same columns of the earliest fixtures, which are then computed once
    leg1 = leg(orientation("_hc", "_ac"), 1, on)
    back = orientation("_ac", "_hc").join(leg1, on).where(F.col("fixture_seq") != F.col("l1_fixture_seq"))
    both = leg(back, 2, [*on, *[f"l1_{c}" for c in FIXTURE_FIELDS]])
    legs = _answers(cand, both, on).dropDuplicates(["prediction_id"])
    h1, a1, h2, a2 = (F.col("l1__hg"), F.col("l1__ag"), F.col("l2__hg"), F.col("l2__ag"))
    usable = h1.isNotNull() & a1.isNotNull() & h2.isNotNull() & a2.isNotNull()
    t1, t2 = h1 + a2, a1 + h2
    status = F.when(~usable, "unusable").when(t1 == t2, "tied").otherwise("resolved")
    return legs.select(
        "prediction_id",
        F.col("l1_fixture_seq").alias("leg1_seq"), F.col("l2_fixture_seq").alias("leg2_seq"),
        F.when(usable, t1).alias("home_goals"), F.when(usable, t2).alias("away_goals"),
        F.when(usable & (t1 != t2), result_code(t1, t2)).alias("actual_result"),
        F.col("l2_event_date").alias("event_date"),
        status.alias("status"))


def resolve_results(p: DataFrame, fx: DataFrame, d: Dictionaries, nm: DataFrame | None = None) -> DataFrame:
    """Dispatch: a resolved aggregate wins, anything else (incl. a tie) falls
    through to the single-leg matcher.  One row per resolved prediction."""
    nm = _names(p, fx) if nm is None else nm
    agg = resolve_two_leg(p, fx, nm, d).where(F.col("status") == "resolved")
    one = resolve_single_leg(p, fx, nm)
    a = agg.select("prediction_id", *[F.col(c).alias("a_" + c) for c in
                                      ("home_goals", "away_goals", "actual_result", "event_date")])
    s = one.select("prediction_id", *[F.col(c).alias("s_" + c) for c in
                                      ("home_goals", "away_goals", "actual_result", "event_date")])
    j = p.select("prediction_id", "_mdate").join(a, "prediction_id", "left").join(s, "prediction_id", "left")
    is_agg = F.col("a_actual_result").isNotNull()
    pick = lambda c: F.when(is_agg, F.col("a_" + c)).otherwise(F.col("s_" + c))
    return (j.where(is_agg | F.col("s_actual_result").isNotNull())
            .select("prediction_id",
                    F.when(is_agg, F.lit("aggregate")).otherwise(F.lit("single")).alias("source"),
                    pick("home_goals").alias("home_goals"), pick("away_goals").alias("away_goals"),
                    pick("actual_result").alias("actual_result"),
                    F.coalesce(pick("event_date"), F.col("_mdate")).alias("match_date")))


PREPARED = ["prediction_id", "competition", "match_type", *TEAMS, "_season", "_mdate", "_lo", "_hi"]


def _prepared(whole: DataFrame, fixtures: DataFrame, d: Dictionaries, run_date: str,
              kept_rounds: DataFrame | None, materialize: bool):
    """(predictions, fixtures, name map) of resolution from dated predictions (``whole``: all columns)."""
    p = supported(whole, d).select(*PREPARED)
    fx = fixtures_in_plan(finished_fixtures(fixtures, d, run_date, kept_rounds), fetch_plan(p, d))
    if materialize:
        fx = _materialize(fx, "prepared-fixtures")
    return _by_name(p, fx, d, materialize)


def prepared_inputs(preds: DataFrame, fixtures: DataFrame, d: Dictionaries, run_date: str,
                    kept_rounds: DataFrame | None = None, materialize: bool = True):
    """(prepared predictions, fixtures restricted to the fetch plan, name map).

    Each of the three feeds several branches (single leg, both two-leg
    orientations, dispatch).  With ``materialize`` they are computed at once and
    written to the reliable checkpoint folder (``spark.checkpoint.dir``): the
    canonicalisation runs once per name instead of once per row and branch, and a lost
    executor re-reads the files instead of recomputing the lineage.  Without it
    they stay lazy, and each branch computes them again.
    """
    p = supported(dated_predictions(preds, d, run_date), d).select(*PREPARED)
    if materialize:
        p = _materialize(p, "prepared-predictions")
    return _prepared(p, fixtures, d, run_date, kept_rounds, materialize)


# --------------------------------------------------------------------------- overrides

def conform_overrides(raw: DataFrame) -> DataFrame:
    """Trimmed ids, blanks dropped, the last line per id wins.

    Line order is the ``line_no`` column, of any type with an order.  Without it there is no order between
    lines, so an id that occurs twice raises.  Goals are whole numbers, also
    written as decimals (``2.0``); a line with other goals is no override and
    stands in ``rejected_overrides``.
    """
    return _override_rows(raw).where(_usable_goals()).transform(_last_lines)


def rejected_overrides(raw: DataFrame) -> DataFrame:
    """The override lines whose goals are not whole numbers, as they were read."""
    return _override_rows(raw).where(~_usable_goals()).select("prediction_id", "raw_home_goals", "raw_away_goals")


def _usable_goals() -> Column:
    return F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()


def _whole(c: str) -> Column:
    v = F.col(c).cast("string").try_cast("decimal(20,6)")
    return F.when((v == F.floor(v)) & v.between(0, 2**31 - 1), v.cast("int"))


def _override_rows(raw: DataFrame) -> DataFrame:
    df = raw if "line_no" in raw.columns else raw.withColumn("line_no", F.lit(None).cast("bigint"))
    opt = lambda c: (strip_ws(F.col(c).cast("string")) if c in raw.columns
                     else F.lit(None).cast("string"))
    rows = df.select(
        strip_ws(F.col("prediction_id").cast("string")).alias("prediction_id"),
        _whole("home_goals").alias("home_goals"), _whole("away_goals").alias("away_goals"),
        opt("match_date").alias("match_date"), opt("match_type").alias("match_type"), "line_no",
        F.col("home_goals").cast("string").alias("raw_home_goals"),
        F.col("away_goals").cast("string").alias("raw_away_goals"))
    return rows.where(F.col("prediction_id").isNotNull() & (F.col("prediction_id") != ""))


def _last_lines(rows: DataFrame) -> DataFrame:
    # the last line per id: a hash aggregate over the fixed-width line number,
    # then a semi-join back (a struct/string max_by would need a sort aggregate)
    last = rows.groupBy("prediction_id").agg(F.max("line_no").alias("_last"), F.count("*").alias("_n"))
    last = last.select(F.col("prediction_id").alias("_id"), F.when(
        F.col("_last").isNull() & (F.col("_n") > 1),
        F.raise_error(F.concat(F.lit("override lines without line_no repeat the id "), F.col("prediction_id"))).cast(rows.schema["line_no"].dataType))
        .otherwise(F.col("_last")).alias("_last"))
    return (rows.join(last, (F.col("prediction_id") == F.col("_id")) & F.col("line_no").eqNullSafe(F.col("_last")), "left_semi")
            .select("prediction_id", "home_goals", "away_goals", "match_date", "match_type"))


def _override_columns(base_match_date: Column, base_match_type: Column):
    hg, ag = F.col("ov_home_goals"), F.col("ov_away_goals")
    md = F.col("ov_match_date")
    mt = F.col("ov_match_type")
    return {
        "home_goals": hg, "away_goals": ag, "actual_result": result_code(hg, ag),
        "match_date": F.when(F.coalesce(md != "", F.lit(False)), lenient_date(md)).otherwise(base_match_date),
        "match_type": F.when(mt.isin("single", "knockout"), mt).otherwise(base_match_type),
    }


def _ov(overrides: DataFrame) -> DataFrame:
    return overrides.select("prediction_id", F.lit(True).alias("ov_present"),
                            *[F.col(c).alias("ov_" + c) for c in
                              ("home_goals", "away_goals", "match_date", "match_type")])


def apply_overrides(preds: DataFrame, overrides: DataFrame) -> DataFrame:
    """Rows that have an override, with the override's result and a new score."""
    j = preds.join(_ov(overrides), "prediction_id")
    c = _override_columns(F.col("match_date"), F.col("match_type"))
    out = j.select("prediction_id", *[v.alias(k) for k, v in c.items()],
                   "pred_home_win_pct", "pred_draw_pct", "pred_away_win_pct")
    return out.withColumn("brier_score", brier_score("pred_home_win_pct", "pred_draw_pct", "pred_away_win_pct",
                                                     "match_type", "actual_result"))


# --------------------------------------------------------------------------- attach

def attach_results(preds: DataFrame, fixtures: DataFrame, d: Dictionaries, run_date: str,
                   fetched_at: str, overrides: DataFrame | None = None,
                   kept_rounds: DataFrame | None = None, materialize: bool = True) -> DataFrame:
    """Override, else resolved fixture, else pending; then score.  17 columns.

    With ``materialize`` the input is evaluated once, by the write of its prepared copy, which carries all its columns.
    """
    whole = dated_predictions(preds, d, run_date)
    if materialize:
        whole = _materialize(whole, "prepared-predictions")
    return _attach(whole, preds.columns, fixtures, d, run_date, fetched_at, overrides, kept_rounds, materialize)


def _attach(whole: DataFrame, columns: list[str], fixtures: DataFrame, d: Dictionaries, run_date: str, fetched_at: str,
            overrides: DataFrame | None, kept_rounds: DataFrame | None, materialize: bool) -> DataFrame:
    """``attach_results`` of dated predictions, whose own columns are ``columns``."""
    p, fx, nm = _prepared(whole, fixtures, d, run_date, kept_rounds, materialize)
    res = resolve_results(p, fx, d, nm)
    base = whole.withColumnRenamed("_mdate", "_own_mdate")
    j = base.join(res.select("prediction_id", *[F.col(c).alias("r_" + c) for c in
                                                ("home_goals", "away_goals", "actual_result", "match_date")]),
                  "prediction_id", "left")
    if overrides is not None:
        j = j.join(_ov(overrides), "prediction_id", "left")
        has_ov = F.coalesce(F.col("ov_present"), F.lit(False))
    else:
        has_ov = F.lit(False)
        for c in ("home_goals", "away_goals", "match_date", "match_type"):
            j = j.withColumn("ov_" + c, F.lit(None).cast("string" if c.startswith("match") else "int"))
    resolved = F.col("r_actual_result").isNotNull()
    ovc = _override_columns(F.col("_own_mdate"), F.col("match_type"))

    def pick(name, resolved_col, pending_col):
        return F.when(has_ov, ovc[name]).when(resolved, resolved_col).otherwise(pending_col)

    out = j.select(
        *[c for c in columns if c not in ("match_date", "match_type", "actual_result", "home_goals",
                                                  "away_goals", "brier_score", "fetched_at")],
        pick("home_goals", F.col("r_home_goals"), F.lit(None).cast("int")).alias("home_goals"),
        pick("away_goals", F.col("r_away_goals"), F.lit(None).cast("int")).alias("away_goals"),
        pick("actual_result", F.col("r_actual_result"), F.lit(None).cast("string")).alias("actual_result"),
        pick("match_date", F.col("r_match_date"), F.col("_own_mdate")).alias("match_date"),
        F.when(has_ov, ovc["match_type"]).otherwise(F.col("match_type")).alias("match_type"),
        F.when(has_ov | resolved, F.lit(fetched_at).cast("timestamp")).alias("fetched_at"))
    out = out.withColumn("brier_score", brier_score("pred_home_win_pct", "pred_draw_pct", "pred_away_win_pct",
                                                    "match_type", "actual_result"))
    return conform(out)


# --------------------------------------------------------------------------- refresh

def gained_questions(p: DataFrame, gained: DataFrame, d: Dictionaries, nm: DataFrame | None = None) -> DataFrame:
    """Ids of the predictions for which one of the ``gained`` fixtures is a candidate (a delta join).

    ``p`` and ``gained`` are prepared. Both go through the keys of the full resolution, (competition, home key, away
    key, bucket), so the work grows with the pending questions and the new fixtures, not with all fixtures.
    """
    nm = _names(p, gained) if nm is None else nm
    q = single_leg_questions(p)
    one = _answers(p, single_leg_candidates(q, gained, nm).select(*q.columns).distinct(), q.columns)
    on = ["competition", "_hc", "_ac"]
    cand = p.where((F.col("match_type") == "knockout") & F.col("competition").isin(*d.aggregate_competitions))
    pairs = _two_earliest(gained).select("competition", "_kh", "_ka").distinct()
    asked = cand.select(*on).distinct()
    legs = [_with_keys(_with_keys(asked, nm, home, "_kh"), nm, away, "_ka").join(pairs, ["competition", "_kh", "_ka"], "left_semi").select(*on)
            for home, away in (("_hc", "_ac"), ("_ac", "_hc"))]
    two = _answers(cand, legs[0].unionByName(legs[1]).distinct(), on)
    return one.unionByName(two).distinct()


def refresh(pending: DataFrame, fixtures: DataFrame, gained: DataFrame, d: Dictionaries, run_date: str, fetched_at: str,
            overrides: DataFrame | None = None, materialize: bool = True) -> DataFrame:
    """The pending rows that get a result now (17 columns): only those that ``gained`` fixtures or an override concern are resolved.

    ``fixtures`` are all loaded fixtures, the gained ones included; the first in source order still decides.
    """
    whole = dated_predictions(pending, d, run_date)
    if materialize:
        whole = _materialize(whole, "prepared-pending")
    p, new, nm = _prepared(whole, gained, d, run_date, None, materialize)
    ids = gained_questions(p, new, d, nm)
    if overrides is not None:
        ids = ids.unionByName(overrides.select("prediction_id")).distinct()
    concerned = whole.join(ids, "prediction_id", "left_semi")
    if materialize:
        concerned = _materialize(concerned, "concerned")
        copies = {path for df in (whole, new, nm) for path in scratch_inputs(df)}     # nothing below reads these
        release_materialized(whole.sparkSession, copies)
    rows = _attach(concerned, pending.columns, fixtures, d, run_date, fetched_at, overrides, None, materialize)
    return rows.where(F.col("actual_result").isNotNull())
