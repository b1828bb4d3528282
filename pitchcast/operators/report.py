"""Report sections over the prediction table, each a small DataFrame.

Every section starts from ``scored(table)`` (a pushed-down ``brier_score is not
null`` filter) and does one aggregation with map-side partial aggregation, or
rolls up ``report_cube``, which the report job computes once for all of them.
The windows that run without a partition are over months or quarters.
Means and deviations use exact integer sums (functions.exact).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions.dates import gauge_level, gauge_threshold_cell, quarter_label, trend_level
from ..functions.exact import mean_from_units, rounded_percent, stddev_from_units, unit_sums
from ..functions.scoring import top_pick_hit

def _hit():
    return top_pick_hit("pred_home_win_pct", "pred_draw_pct", "pred_away_win_pct", "actual_result")


def scored(table: DataFrame) -> DataFrame:
    return table.where(F.col("brier_score").isNotNull())


CUBE = ["competition", "month", "bin"]


def _keyed(table: DataFrame) -> DataFrame:
    return scored(table).withColumns({"month": F.trunc(F.col("publish_date"), "MM"), "bin": _bin_index()})


def report_cube(table: DataFrame) -> DataFrame:
    """All that the sections but ``recent`` need, in one scan: exact sums and hits per (competition, month, bin).

    The sums are whole numbers, so rolling them up gives the same bits as adding the rows. Each section
    function takes this cube in place of the table.
    """
    return _moments(_keyed(table), *CUBE)


def _is_cube(df: DataFrame) -> bool:
    return "s1" in df.columns


def _moments(df: DataFrame, *group) -> DataFrame:
    """n, s1, s2 and hits per group, of scored rows or rolled up from a cube."""
    if _is_cube(df):
        return df.groupBy(*group).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.sum(c).alias(c) for c in ("s1", "s2", "hits")])
    return df.groupBy(*group).agg(*unit_sums("brier_score"), F.sum(_hit()).alias("hits"))


def _source(table: DataFrame) -> DataFrame:
    """Scored rows with the cube's keys, or the cube as it is."""
    return table if _is_cube(table) else _keyed(table)


def summary_stats(table: DataFrame) -> DataFrame:
    """Count, mean, sample std, top-pick accuracy, badge and consistency band."""
    m = _moments(_source(table))
    mean = F.coalesce(mean_from_units("n", "s1"), F.lit(0.0))
    std = F.coalesce(stddev_from_units("n", "s1", "s2"), F.lit(0.0))
    out = m.select(
        F.col("n").alias("total_predictions"),
        mean.alias("all_time_avg_brier"),
        std.alias("std_brier"),
        F.coalesce(rounded_percent("hits", "n"), F.lit(0.0)).alias("accuracy_pct"),
        F.coalesce((F.col("n") >= dims.SUPERFORECASTER_MIN_N)
                   & (mean_from_units("n", "s1") < F.lit(dims.BENCHMARKS["threshold"])),
                   F.lit(False)).alias("is_superforecaster"))
    band = (F.when(F.col("std_brier") < F.lit(dims.CONSISTENCY_LOW_BELOW), "low")
            .when(F.col("std_brier") > F.lit(dims.CONSISTENCY_HIGH_ABOVE), "high").otherwise("medium"))
    return out.withColumn("consistency", band)


def accuracy_by_competition(table: DataFrame) -> DataFrame:
    m = _moments(_source(table), "competition")
    return m.select("competition", F.col("n"), F.col("hits").cast("bigint").alias("hits"),
                    rounded_percent("hits", "n").alias("accuracy_pct"))


def competition_breakdown(table: DataFrame) -> DataFrame:
    """Mean and n per competition (null group kept), share of all scored rows,
    16-cell gauge level; ordered by mean, then name."""
    m = _moments(_source(table), "competition")
    avg = mean_from_units("n", "s1")
    total = m.agg(F.sum("n")).scalar()      # competitions are free text: no window gathers them in one task
    thr = gauge_threshold_cell(16)
    out = m.select(
        "competition",
        F.substring(F.coalesce(F.col("competition"), F.lit("None")), 1,
                    dims.COMPETITION_DISPLAY_WIDTH).alias("competition_label"),
        avg.alias("avg_brier"), "n",
        (F.col("n") / total * F.lit(100.0)).alias("share_pct"),
        gauge_level(avg, 16).alias("gauge_level"),
        (gauge_level(avg, 16) > thr).alias("above_threshold"))
    return out.orderBy(F.col("avg_brier").asc(), F.col("competition").asc_nulls_last())


def _monthly_with_total(table: DataFrame) -> DataFrame:
    """Per month (null month = rows without publish_date) + the scored total."""
    m = _moments(_source(table), "month").drop("hits")
    return m.withColumn("total", F.sum("n").over(Window.partitionBy()))


def monthly_trend(table: DataFrame) -> DataFrame:
    m = _monthly_with_total(table).where(F.col("month").isNotNull())
    return (m.select("month", mean_from_units("n", "s1").alias("avg_brier_score"),
                     F.col("n").alias("prediction_count"))
            .orderBy("month"))


def quarterly_trend(table: DataFrame) -> DataFrame:
    """Unweighted mean of the monthly means per quarter, summed n, a 3-row
    moving average (missing quarters are not filled), share of all scored rows,
    20-cell gauge and 0..7 trend level."""
    m = (_monthly_with_total(table).where(F.col("month").isNotNull())
         .withColumn("avg", mean_from_units("n", "s1"))
         .withColumn("pos", (F.month("month") - 1) % 3 + 1))
    slot = lambda i: F.coalesce(F.max(F.when(F.col("pos") == i, F.col("avg"))), F.lit(0.0))
    q = (m.groupBy(quarter_label(F.col("month")).alias("quarter"))
         .agg(((slot(1) + slot(2)) + slot(3)).alias("_sum"), F.count("*").alias("_k"),
              F.sum("n").alias("n"), F.max("total").alias("total")))
    q = q.withColumn("avg_brier", F.col("_sum") / F.col("_k").cast("double"))
    w = Window.orderBy("quarter")
    lag1, lag2 = F.lag("avg_brier", 1).over(w), F.lag("avg_brier", 2).over(w)
    k = F.least(F.row_number().over(w), F.lit(3)).cast("double")
    rolling = ((F.coalesce(lag2, F.lit(0.0)) + F.coalesce(lag1, F.lit(0.0))) + F.col("avg_brier")) / k
    thr = gauge_threshold_cell(20)
    return (q.select("quarter", "avg_brier", "n",
                     rolling.alias("rolling_avg"),
                     (F.col("n") / F.col("total") * F.lit(100.0)).alias("share_pct"),
                     gauge_level(F.col("avg_brier"), 20).alias("gauge_level"),
                     (gauge_level(F.col("avg_brier"), 20) > thr).alias("above_threshold"),
                     trend_level(F.col("avg_brier")).alias("trend_level"))
            .orderBy("quarter"))


def trend_direction(quarterly: DataFrame) -> DataFrame:
    """Improving iff the latest of the last <= 3 quarters beats the earliest."""
    w = Window.orderBy(F.col("quarter").desc())
    last3 = quarterly.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 3)
    agg = last3.agg(F.count("*").alias("n_quarters"),
                    F.min_by("avg_brier", "quarter").alias("first_avg"),
                    F.max_by("avg_brier", "quarter").alias("last_avg"))
    return (agg.where(F.col("n_quarters") > 0)
            .withColumn("direction", F.when(F.col("last_avg") < F.col("first_avg"), "improving")
                        .otherwise("worsening")))


def _bin_index():
    raw = ((F.col("brier_score") - F.lit(dims.HIST_LO)) / F.lit(dims.HIST_BIN_WIDTH)).cast("int")
    return F.least(F.lit(_n_bins() - 1), F.greatest(F.lit(0), raw))


def _n_bins() -> int:
    return int((dims.HIST_HI - dims.HIST_LO) / dims.HIST_BIN_WIDTH)


def _hist_counts(table: DataFrame) -> DataFrame:
    """Per-bin counts as an array, plus the moments for the markers."""
    b = _moments(_source(table), "bin")          # a row per bin
    counts = [F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)) for i in range(_n_bins())]
    return b.agg(F.array(*counts).alias("counts"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("s1").alias("s1"),
                 F.sum("s2").alias("s2"), F.max("bin").alias("last_bin"))


def brier_histogram(table: DataFrame) -> DataFrame:
    """Bins of width 0.025 on [0, 0.375) (overflow into the last bin); inner
    empty bins kept, trailing empty bins dropped; pct of n and 24-cell level."""
    h = _hist_counts(table)
    rows = h.select("n", "last_bin", F.posexplode("counts").alias("bin", "cnt"))
    rows = rows.where(F.col("bin") <= F.col("last_bin"))
    mx = F.max("cnt").over(Window.partitionBy())
    lo = F.lit(dims.HIST_LO) + F.col("bin").cast("double") * F.lit(dims.HIST_BIN_WIDTH)
    return (rows.select(
        F.col("bin").cast("int").alias("bin"),
        lo.alias("bin_lo"), (lo + F.lit(dims.HIST_BIN_WIDTH)).alias("bin_hi"),
        F.col("cnt").alias("n"),
        (F.col("cnt") / F.col("n") * F.lit(100.0)).alias("pct"),
        (F.col("cnt") / mx * F.lit(float(dims.HIST_BAR_WIDTH))).cast("int").alias("bar_level"))
        .orderBy("bin"))


def distribution_markers(table: DataFrame) -> DataFrame:
    """mean - std, mean, mean + std and their positions on the 68-cell ruler."""
    h = _hist_counts(table).where(F.col("n") > 0)
    mean = mean_from_units("n", "s1")
    std = F.coalesce(stddev_from_units("n", "s1", "s2"), F.lit(0.0))
    m = h.select(mean.alias("mean"), std.alias("std"),
                 (F.lit(dims.HIST_LO) + (F.col("last_bin") + 1).cast("double")
                  * F.lit(dims.HIST_BIN_WIDTH)).alias("_hist_hi"))
    m = m.withColumn("ruler_hi", F.greatest(F.col("_hist_hi"),
                                            F.col("mean") + F.col("std") + F.lit(dims.HIST_BIN_WIDTH)))
    last = dims.RULER_WIDTH - 1

    def pos(v):
        r = F.bround((v - F.lit(dims.HIST_LO)) / (F.col("ruler_hi") - F.lit(dims.HIST_LO)) * F.lit(float(last)), 0)
        return F.greatest(F.lit(0), F.least(F.lit(last), r.cast("int")))

    lo_v, hi_v = F.col("mean") - F.col("std"), F.col("mean") + F.col("std")
    return m.select("mean", "std", lo_v.alias("lo_value"), hi_v.alias("hi_value"), "ruler_hi",
                    pos(lo_v).alias("lo_pos"), pos(F.col("mean")).alias("mean_pos"), pos(hi_v).alias("hi_pos"))


def benchmark_comparison(table: DataFrame) -> DataFrame:
    """Model mean against the fixed reference Brier levels (one row each)."""
    s = summary_stats(table)
    marks = F.array(*[F.struct(F.lit(k).alias("benchmark"), F.lit(v).alias("value"))
                      for k, v in dims.BENCHMARKS.items()])
    e = s.select("all_time_avg_brier", F.explode(marks).alias("b"))
    return e.select("b.benchmark", "b.value", F.col("all_time_avg_brier").alias("model_brier"),
                    (F.col("all_time_avg_brier") - F.col("b.value")).alias("delta"),
                    (F.col("all_time_avg_brier") < F.col("b.value")).alias("model_better"))


def recent_predictions(table: DataFrame, k: int = dims.RECENT_LIMIT) -> DataFrame:
    """The k most recent scored predictions (top-k, no global sort)."""
    return (scored(table)
            .orderBy(F.col("publish_date").desc_nulls_last(), F.col("prediction_id").desc())
            .limit(k)
            .select("prediction_id", "publish_date", "home_team", "away_team",
                    "pred_home_win_pct", "pred_draw_pct", "pred_away_win_pct",
                    "actual_result", "brier_score"))


def recent_display(recent: DataFrame) -> DataFrame:
    """Display fields of the recent list: ISO date or '', 13-char names,
    'H/D/A' triple, and the > 0.20 flag."""
    w = dims.TEAM_DISPLAY_WIDTH
    return recent.select(
        "prediction_id",
        F.coalesce(F.date_format("publish_date", "yyyy-MM-dd"), F.lit("")).alias("date_label"),
        F.substring(F.coalesce(F.col("home_team"), F.lit("None")), 1, w).alias("home_label"),
        F.substring(F.coalesce(F.col("away_team"), F.lit("None")), 1, w).alias("away_label"),
        F.concat_ws("/", F.col("pred_home_win_pct").cast("string"), F.col("pred_draw_pct").cast("string"),
                    F.col("pred_away_win_pct").cast("string")).alias("probs"),
        "actual_result", "brier_score",
        (F.col("brier_score") > F.lit(dims.BENCHMARKS["threshold"])).alias("above_threshold"))


def section_tables(table: DataFrame, cube: DataFrame | None = None) -> dict[str, DataFrame]:
    """All report sections, keyed by section name (the report sink).

    With a stored ``cube`` (``report_cube``), only ``recent``, a top-k, reads the table.
    """
    cube = report_cube(table) if cube is None else cube
    q = quarterly_trend(cube)
    recent = recent_predictions(table)
    return {
        "summary": summary_stats(cube),
        "benchmarks": benchmark_comparison(cube),
        "distribution": brier_histogram(cube),
        "markers": distribution_markers(cube),
        "competition": competition_breakdown(cube),
        "accuracy": accuracy_by_competition(cube),
        "monthly": monthly_trend(cube),
        "quarterly": q,
        "trend": trend_direction(q),
        "recent": recent_display(recent),
    }
