"""Date helpers: lenient parsing, season inference, quarter labels, levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims
from ..dims import Dictionaries
from .text import _col


def lenient_date(s) -> Column:
    """``%Y-%m-%d`` with 1- or 2-digit month/day; anything else -> null."""
    return F.to_date(F.try_to_timestamp(_col(s), F.lit("yyyy-M-d")))


def infer_season(competition, ref_date, run_date, d: Dictionaries = dims.PRODUCTION) -> Column:
    """Season label of a competition at a reference date.

    ``ref_date`` is a DATE column (null = unparsable); ``run_date`` stands in
    for "today" so the job is reproducible.
    """
    comp = _col(competition)
    day = F.coalesce(_col(ref_date), F.lit(run_date).cast("date"))
    y = F.year(day)
    season = (F.when(comp.isin(*d.single_year), y.cast("string"))
              .when(F.month(day) >= 8, F.concat_ws("-", y.cast("string"), (y + 1).cast("string")))
              .otherwise(F.concat_ws("-", (y - 1).cast("string"), y.cast("string"))))
    if not d.season_overrides:
        return season
    return reduce(
        lambda acc, kv: F.when((comp == kv[0][0]) & (season == kv[0][1]), F.lit(kv[1])).otherwise(acc),
        d.season_overrides.items(), season)


def quarter_label(day) -> Column:
    day = _col(day)
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def gauge_level(value, width: int) -> Column:
    """Filled cells of a bar of ``width`` cells spanning 0..0.30 (truncating)."""
    return F.least(F.lit(width), (_col(value) / F.lit(dims.GAUGE_MAX) * F.lit(float(width))).cast("int"))


def gauge_threshold_cell(width: int) -> int:
    return int(dims.BENCHMARKS["threshold"] / dims.GAUGE_MAX * width)


def trend_level(value) -> Column:
    """0..7 level of a value on the 0.10..0.30 scale (truncating, clamped)."""
    span = F.lit(dims.TREND_HI) - F.lit(dims.TREND_LO)
    raw = ((_col(value) - F.lit(dims.TREND_LO)) / span * F.lit(float(dims.TREND_STEPS))).cast("int")
    return F.greatest(F.lit(0), F.least(raw, F.lit(dims.TREND_STEPS)))
