"""Landed result pages -> finished fixtures in one global source order.

A page is what the results API returns for one round: (competition, season, round_no, landed_at, events), the
events nested in their order.  A page may land many times; its newest copy counts.  Which rounds are loaded
is an order-dependent walk per (competition, season): a fold over at most ``max_rounds`` entries.

Source order is plan order, then round, then place on the page.  The sequence is dense and global, but no task
numbers the fixtures: a page's finished events are numbered on the page, rounds start at the prefix sum of the
counts within their season, seasons at the prefix sum over the plan (a row per season asked for), and the
starts are added back by a join on the page's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..dims import Dictionaries
from ..functions.dates import lenient_date
from .resolve import supported

PAGE = ["competition", "season", "round_no"]


def latest_pages(pages: DataFrame) -> DataFrame:
    """The newest copy of each page (of copies that landed together, any fixed one)."""
    w = Window.partitionBy(*PAGE).orderBy(F.col("landed_at").desc_nulls_last(), F.xxhash64("events").desc())
    return pages.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _finished(d: Dictionaries) -> Column:
    return F.filter("events", lambda e: e["strStatus"] == d.finished_status)


def max_rounds(d: Dictionaries) -> Column:
    if not d.max_rounds:
        return F.lit(d.default_max_rounds)
    known = F.create_map(*[F.lit(x) for kv in d.max_rounds.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.col("competition")), F.lit(d.default_max_rounds))


def rounds_from_pages(pages: DataFrame, d: Dictionaries) -> DataFrame:
    """(competition, season, round_no, n_finished) of the rounds that are loaded; one copy of each page.

    The walk goes through rounds 1, 2, ...: a round without events (or without a page) extends a
    streak, and the third in a row ends it; a round with events of which none is finished ends it too.
    """
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    counts = pages.select(*PAGE, F.struct(size(F.col("events")).alias("n"), size(_finished(d)).alias("fin")).alias("c"))
    nested = (counts.where(F.col("round_no").between(1, max_rounds(d)))
              .groupBy("competition", "season").agg(F.map_from_entries(F.collect_list(F.struct("round_no", "c"))).alias("rounds")))
    none = F.array().cast("array<struct<round_no:int,n_finished:bigint>>")
    start = F.struct(F.lit(0).alias("streak"), F.lit(False).alias("over"), none.alias("kept"))

    def step(acc: Column, r: Column) -> Column:
        page = F.try_element_at(F.col("rounds"), r)
        n, fin = F.coalesce(page["n"], F.lit(0)), F.coalesce(page["fin"], F.lit(0))
        streak = F.when(n == 0, acc["streak"] + 1).otherwise(F.lit(0))
        over = acc["over"] | (streak >= dims.EMPTY_ROUND_STREAK) | ((n > 0) & (fin == 0))
        entry = F.array(F.struct(r.alias("round_no"), fin.cast("bigint").alias("n_finished")))
        kept = F.when(~over & (fin > 0), F.concat(acc["kept"], entry)).otherwise(acc["kept"])
        return F.struct(streak.alias("streak"), over.alias("over"), kept.alias("kept"))

    walk = F.aggregate(F.sequence(F.lit(1), max_rounds(d)), start, step, lambda acc: acc["kept"])
    return nested.select("competition", "season", F.inline(walk))


def ordered_plan(prepared: DataFrame, d: Dictionaries) -> DataFrame:
    """The fetch plan with ``plan_no``: (competition, season) in the order in which the rows first ask for it.

    Rows come in order of publication (unknown dates last), then id.
    """
    first = F.min(F.struct(F.col("publish_date").isNull().alias("undated"), "publish_date", "prediction_id")).alias("first")
    asked = supported(prepared, d).groupBy("competition", F.col("_season").alias("season")).agg(first)
    # a row per season asked for, of the dictionary's competitions
    return asked.select("competition", "season", F.row_number().over(Window.orderBy("first")).cast("bigint").alias("plan_no"))


def page_starts(kept: DataFrame, plan: DataFrame) -> DataFrame:
    """(competition, season, round_no, start): how many finished fixtures come before the page."""
    units = kept.groupBy("competition", "season").agg(F.sum("n_finished").alias("n")).join(plan, ["competition", "season"])
    before = Window.orderBy("plan_no").rowsBetween(Window.unboundedPreceding, -1)
    units = units.select("competition", "season", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("unit_start"))
    within = Window.partitionBy("competition", "season").orderBy("round_no").rowsBetween(Window.unboundedPreceding, -1)
    rounds = kept.select(*PAGE, F.coalesce(F.sum("n_finished").over(within), F.lit(0)).alias("round_start"))
    return rounds.join(units, ["competition", "season"]).select(*PAGE, (F.col("unit_start") + F.col("round_start")).alias("start"))


def landed_fixtures(pages: DataFrame, plan: DataFrame, d: Dictionaries) -> DataFrame:
    """The finished fixtures of the plan's seasons, each with its dense ``fixture_seq`` (from 1), ready for resolution.

    ``pages`` may hold several copies of a page; ``plan`` is (competition, season, plan_no).
    """
    asked = latest_pages(pages.join(plan.select("competition", "season"), ["competition", "season"], "left_semi"))
    starts = page_starts(rounds_from_pages(asked, d), plan)
    events = asked.join(starts, PAGE).select(*PAGE, "start", F.posexplode(_finished(d)).alias("pos", "e"))
    return events.select(
        (F.col("start") + F.col("pos") + 1).alias("fixture_seq"), "competition", "season", "round_no",
        F.col("e.strHomeTeam").alias("home_team"), F.col("e.strAwayTeam").alias("away_team"),
        F.col("e.intHomeScore").alias("home_score"), F.col("e.intAwayScore").alias("away_score"),
        lenient_date("e.dateEvent").alias("event_date"), F.col("e.strStatus").alias("status"))


def gained_fixtures(pages_before: DataFrame, pages: DataFrame, plan: DataFrame, d: Dictionaries) -> DataFrame:
    """Of ``landed_fixtures(pages, plan, d)``, those that were not loaded from ``pages_before``.

    A page counts as gained if its newest copy is another one than before, or if the walk did not reach its
    round before (a finished round may open the way to rounds that landed long ago).
    """
    def loaded(some):
        newest = latest_pages(some.join(plan.select("competition", "season"), ["competition", "season"], "left_semi"))
        return newest.join(rounds_from_pages(newest, d), PAGE).select(*PAGE, F.xxhash64("landed_at", "events").alias("copy"))

    gained = loaded(pages).join(loaded(pages_before), [*PAGE, "copy"], "left_anti")
    return landed_fixtures(pages, plan, d).join(gained, PAGE, "left_semi")
