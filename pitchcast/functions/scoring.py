"""Result codes and Brier scores as Column expressions.

The arithmetic follows the original per-row formulas operation by operation
(probability = pct / 100.0, squares as x*x, sum left to right, round to 4), so
the doubles agree bit for bit with a SQL engine evaluating the same formula.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def result_code(home_goals, away_goals) -> Column:
    h, a = _col(home_goals), _col(away_goals)
    return (F.when(h > a, F.lit("H"))
            .when(h < a, F.lit("A"))
            .when(h.isNotNull() & a.isNotNull(), F.lit("D")))


def classify_match_type(draw_pct) -> Column:
    d = _col(draw_pct)
    return F.when(d == 0, F.lit("knockout")).when(d.isNotNull(), F.lit("single"))


def _indicator(actual: Column, code: str) -> Column:
    return F.when(actual == code, F.lit(1.0)).otherwise(F.lit(0.0))


def _sq(x: Column) -> Column:
    return x * x


def _prob(pct) -> Column:
    return _col(pct) / F.lit(100.0)


def brier_3way(home_pct, draw_pct, away_pct, actual) -> Column:
    a = _col(actual)
    total = (_sq(_prob(home_pct) - _indicator(a, "H"))
             + _sq(_prob(draw_pct) - _indicator(a, "D"))
             + _sq(_prob(away_pct) - _indicator(a, "A")))
    return F.round(total / F.lit(3.0), 4)


def brier_2way(home_pct, away_pct, actual) -> Column:
    """Home/away renormalised to 1; a non-positive total scores 0.0."""
    a = _col(actual)
    ph, pa = _prob(home_pct), _prob(away_pct)
    total = ph + pa
    score = F.round((_sq(F.try_divide(ph, total) - _indicator(a, "H"))
                     + _sq(F.try_divide(pa, total) - _indicator(a, "A"))) / F.lit(2.0), 4)
    return F.when(total <= 0, F.lit(0.0)).otherwise(score)


def brier_score(home_pct, draw_pct, away_pct, match_type, actual) -> Column:
    """Null unless the result is H/D/A; knockout -> 2-way, anything else -> 3-way."""
    a = _col(actual)
    return F.when(
        a.isin("H", "D", "A"),
        F.when(_col(match_type) == "knockout", brier_2way(home_pct, away_pct, a))
         .otherwise(brier_3way(home_pct, draw_pct, away_pct, a)))


def top_pick_hit(home_pct, draw_pct, away_pct, actual) -> Column:
    """1 when the realised outcome had a probability >= both others (ties hit)."""
    h, d, w, a = _col(home_pct), _col(draw_pct), _col(away_pct), _col(actual)
    return (F.when((a == "H") & (h >= d) & (h >= w), 1)
            .when((a == "D") & (d >= h) & (d >= w), 1)
            .when((a == "A") & (w >= h) & (w >= d), 1)
            .otherwise(0))
