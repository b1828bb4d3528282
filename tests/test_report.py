import datetime as dt
import statistics

import pandas as pd

from pitchcast.operators import report as R
from pitchcast.sources.schema import conform

from conftest import collect


def scored_table(spark, rows):
    df = spark.createDataFrame(rows, "prediction_id string, competition string, publish_date date, "
                                     "pred_home_win_pct int, pred_draw_pct int, pred_away_win_pct int, "
                                     "actual_result string, brier_score double")
    return conform(df)


ROWS = [
    ("a", "LaLiga", dt.date(2025, 1, 10), 50, 25, 25, "H", 0.1250),
    ("b", "LaLiga", dt.date(2025, 1, 20), 40, 40, 20, "D", 0.2400),
    ("c", "UCL", dt.date(2025, 2, 5), 20, 30, 50, "H", 0.4467),
    ("d", "UCL", dt.date(2025, 4, 1), 60, 0, 40, "A", 0.3600),
    ("e", None, None, 30, 30, 40, "A", 0.1800),
    ("f", "LaLiga", dt.date(2025, 7, 1), 30, 30, 40, None, None),
]


def test_summary(spark):
    s = collect(R.summary_stats(scored_table(spark, ROWS)))[0]
    vals = [r[-1] for r in ROWS if r[-1] is not None]
    assert s["total_predictions"] == 5
    assert abs(s["all_time_avg_brier"] - statistics.mean(vals)) < 1e-12
    assert abs(s["std_brier"] - statistics.stdev(vals)) < 1e-12
    assert s["accuracy_pct"] == 60.0      # a, b (tie counts), e hit; c, d miss
    assert s["is_superforecaster"] is False
    assert s["consistency"] == "medium"


def test_summary_empty_table(spark):
    s = collect(R.summary_stats(scored_table(spark, [ROWS[-1]])))[0]
    assert (s["total_predictions"], s["all_time_avg_brier"], s["std_brier"], s["accuracy_pct"],
            s["is_superforecaster"]) == (0, 0.0, 0.0, 0.0, False)


def test_quarterly_is_mean_of_monthly_means(spark):
    t = scored_table(spark, ROWS)
    q = {r["quarter"]: r for r in collect(R.quarterly_trend(t))}
    monthly = pd.DataFrame([(r[2].replace(day=1), r[-1]) for r in ROWS if r[-1] is not None and r[2]],
                           columns=["m", "b"]).groupby("m")["b"].mean()
    q1 = (monthly[dt.date(2025, 1, 1)] + monthly[dt.date(2025, 2, 1)]) / 2
    assert abs(q["2025-Q1"]["avg_brier"] - q1) < 1e-12
    assert q["2025-Q1"]["n"] == 3 and q["2025-Q2"]["n"] == 1
    assert abs(q["2025-Q2"]["rolling_avg"] - (q1 + 0.36) / 2) < 1e-12
    assert abs(q["2025-Q1"]["share_pct"] - 60.0) < 1e-9       # 3 of the 5 scored rows
    trend = collect(R.trend_direction(R.quarterly_trend(t)))[0]
    assert trend["direction"] == "worsening" and trend["n_quarters"] == 2


def test_histogram_keeps_inner_and_drops_trailing_empty_bins(spark):
    h = collect(R.brier_histogram(scored_table(spark, ROWS)).orderBy("bin"), "bin", "n")
    counts = dict(h)
    assert max(counts) == 14                      # 0.4467 overflows into the last bin
    assert counts[5] == 1 and counts[9] == 1 and counts[7] == 1 and counts[14] == 2   # 0.36 and the overflow 0.4467
    assert sum(counts.values()) == 5 and counts[0] == 0
    h2 = collect(R.brier_histogram(scored_table(spark, ROWS[:2])).orderBy("bin"), "bin")
    assert h2[-1] == (9,)                         # trailing empty bins dropped


def test_competition_breakdown_and_markers(spark):
    t = scored_table(spark, ROWS)
    comp = {r["competition"]: r for r in collect(R.competition_breakdown(t))}
    assert comp["LaLiga"]["n"] == 2 and abs(comp["LaLiga"]["avg_brier"] - 0.1825) < 1e-12
    assert comp[None]["competition_label"] == "None"
    assert comp["UCL"]["above_threshold"] is True and comp["LaLiga"]["above_threshold"] is False
    m = collect(R.distribution_markers(t))[0]
    assert 0 <= m["lo_pos"] <= m["mean_pos"] <= m["hi_pos"] <= 67


def test_recent_is_top_k_by_date_then_id(spark):
    r = collect(R.recent_predictions(scored_table(spark, ROWS), k=3), "prediction_id")
    assert r == [("d",), ("c",), ("b",)]
    disp = collect(R.recent_display(R.recent_predictions(scored_table(spark, ROWS), k=1)))[0]
    assert disp["probs"] == "60/0/40" and disp["date_label"] == "2025-04-01" and disp["above_threshold"]


def test_sections_from_the_cube_equal_those_from_the_table(spark):
    t = scored_table(spark, ROWS + [("g", "LaLiga", dt.date(2025, 1, 31), 34, 33, 33, "D", 0.2223), ("h", None, dt.date(2024, 12, 1), 90, 5, 5, "H", 0.0042)])
    for some in (t, t.limit(0)):
        cube = R.report_cube(some)
        for section in (R.summary_stats, R.competition_breakdown, R.accuracy_by_competition, R.monthly_trend, R.quarterly_trend,
                        R.brier_histogram, R.distribution_markers, R.benchmark_comparison):
            assert sorted(map(tuple, section(cube).collect()), key=repr) == sorted(map(tuple, section(some).collect()), key=repr), section.__name__
            assert section(cube).dtypes == section(some).dtypes


def test_report_job_scans_the_table_once(spark, tmp_path):
    from pitchcast.plans.jobs import report_job
    path = str(tmp_path / "t")
    scored_table(spark, ROWS).write.parquet(path)
    sections = report_job(spark.read.parquet(path))
    assert {n for n, df in sections.items() if any(path in f for f in df.inputFiles())} == {"recent"}
    plan = sections["competition"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
