"""Landed result pages: the walk over rounds, one global order, and what a new page gains."""

import datetime as dt
import random

import pytest

from pitchcast import dims
from pitchcast.operators import pages as P
from pitchcast.operators import resolve as V
from pitchcast.sources.readers import PAGE_SCHEMA

from conftest import collect

D = dims.Dictionaries(leagues={"Cup": 1, "League": 2}, single_year=("Cup",), season_overrides={}, max_rounds={"Cup": 6}, default_max_rounds=9)
DONE, OPEN = "Match Finished", "Not Started"


def page(comp, season, no, statuses, landed=1, tag=""):
    events = None if statuses is None else [(f"{tag}h{no}.{k}", f"a{no}.{k}", "2025-03-05", s, "1", "0") for k, s in enumerate(statuses)]
    return comp, season, no, dt.datetime(2026, 1, landed), events


def frame(spark, rows):
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def walked(rounds, most):
    """The rounds to load, by the plain loop."""
    kept, streak = [], 0
    for r in range(1, most + 1):
        events = rounds.get(r) or []
        if not events:
            streak += 1
            if streak == 3:
                break
            continue
        streak = 0
        finished = [e for e in events if e == DONE]
        if not finished:
            break
        kept.append((r, len(finished)))
    return kept


def test_rounds_fold_against_a_plain_walk(spark):
    r = random.Random(4)
    units = {}
    for u in range(60):
        comp = r.choice(["Cup", "League"])
        units[comp, f"s{u}"] = {no: r.choice([None, [], [DONE], [DONE, OPEN], [DONE, DONE]] + [[OPEN]] * (r.random() < .3))
                                for no in range(1, 12) if r.random() < .8}
    rows = [page(c, s, no, st) for (c, s), rounds in units.items() for no, st in rounds.items()]
    got = sorted(collect(P.rounds_from_pages(frame(spark, rows), D), "competition", "season", "round_no", "n_finished"))
    assert got == sorted((c, s, no, n) for (c, s), rounds in units.items() for no, n in walked(rounds, 6 if c == "Cup" else 9))


def test_latest_copy_of_a_page_counts(spark):
    rows = [page("League", "x", 1, [OPEN], 1), page("League", "x", 1, [DONE, OPEN], 3), page("League", "x", 1, [], 2)]
    assert collect(P.rounds_from_pages(P.latest_pages(frame(spark, rows)), D), "round_no", "n_finished") == [(1, 1)]
    assert P.latest_pages(frame(spark, [])).count() == 0


def plan(spark, *units):
    return spark.createDataFrame([(c, s, k + 1) for k, (c, s) in enumerate(units)], "competition string, season string, plan_no long")


@pytest.mark.parametrize("parts", [1, 7])
def test_one_dense_order_over_plan_round_and_place(spark, parts):
    r = random.Random(5)
    units = [("League", "2024-2025"), ("Cup", "2025"), ("League", "2025-2026")]
    rows = [page(c, s, no, [r.choice([DONE, OPEN]) if k else DONE for k in range(r.randrange(1, 9))]) for c, s in units for no in range(1, 10)]
    rows += [page("Other", "2025", 1, [DONE])]
    r.shuffle(rows)
    order = [units[1], units[2], units[0]]
    got = collect(P.landed_fixtures(frame(spark, rows).repartition(parts), plan(spark, *order), D))
    want = []
    for c, s in order:
        for _, _, no, _, events in sorted((x for x in rows if x[:2] == (c, s) and x[2] <= (6 if c == "Cup" else 9)), key=lambda x: x[2]):
            want += [(c, s, no, e[0]) for e in events if e[3] == DONE]
    got.sort(key=lambda x: x["fixture_seq"])
    assert [x["fixture_seq"] for x in got] == list(range(1, len(want) + 1))
    assert [(x["competition"], x["season"], x["round_no"], x["home_team"]) for x in got] == want
    assert {x["event_date"] for x in got} == {dt.date(2025, 3, 5)}


def test_plan_order_is_the_order_of_first_asking(spark):
    rows = [("b", "Cup", dt.date(2025, 5, 1), None), ("a", "League", dt.date(2025, 5, 1), None), ("0", "League", None, dt.date(2023, 9, 1)),
            ("c", "League", dt.date(2025, 3, 1), dt.date(2024, 9, 1)), ("d", "Unknown", dt.date(2020, 1, 1), None)]
    preds = spark.createDataFrame([(i, c, "x", "y", "single", p, m) for i, c, p, m in rows],
                                  "prediction_id string, competition string, home_team string, away_team string, match_type string, publish_date date, match_date date")
    got = sorted(collect(P.ordered_plan(V.prepare_predictions(preds, D, "2026-01-01"), D), "plan_no", "competition", "season"))
    assert [x[:2] + x[2:] for x in got] == [(1, "League", "2024-2025"), (2, "Cup", "2025"), (3, "League", "2023-2024")]


def test_gained_fixtures_are_new_copies_and_newly_reached_rounds(spark):
    before = [page("League", "x", 1, [DONE]), page("League", "x", 2, [OPEN]), page("League", "x", 3, [DONE, DONE]), page("Cup", "y", 1, [DONE])]
    after = before + [page("League", "x", 2, [DONE, OPEN], 2), page("League", "x", 1, [DONE], 1)]       # the first page has landed again as it was
    p = plan(spark, ("League", "x"), ("Cup", "y"))
    got = collect(P.gained_fixtures(frame(spark, before), frame(spark, after), p, D), "round_no", "fixture_seq")
    assert sorted(got) == [(2, 2), (3, 3), (3, 4)]           # round 3 had landed, but the walk ended at round 2
    assert P.gained_fixtures(frame(spark, after), frame(spark, after), p, D).count() == 0
    assert P.gained_fixtures(frame(spark, []), frame(spark, []), p, D).count() == 0
