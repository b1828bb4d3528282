import datetime as dt
import json

from pitchcast.operators import resolve as V
from pitchcast.sources.readers import read_fixture_events, read_overrides, read_video_list
from pitchcast.sources.schema import PREDICTION_COLUMNS, PREDICTION_SCHEMA, conform

from conftest import collect


def test_fixture_events_json(spark, tmp_path):
    path = tmp_path / "fixtures.json"
    events = [
        {"fixture_seq": 1, "competition": "LaLiga", "season": "2024-2025", "round_no": 1, "strHomeTeam": "Real Madrid",
         "strAwayTeam": "Barcelona", "dateEvent": "2025-3-5", "strStatus": "Match Finished",
         "intHomeScore": "2", "intAwayScore": "1"},
        {"fixture_seq": 2, "competition": "LaLiga", "season": "2024-2025", "round_no": 1, "strHomeTeam": "Betis",
         "strAwayTeam": "Sevilla", "dateEvent": "", "strStatus": "Not Started",
         "intHomeScore": None, "intAwayScore": None},
    ]
    path.write_text("\n".join(json.dumps(e) for e in events))
    fx = read_fixture_events(spark, str(path))
    rows = collect(fx.orderBy("fixture_seq"))
    assert rows[0]["event_date"] == dt.date(2025, 3, 5) and rows[0]["home_team"] == "Real Madrid"
    assert rows[1]["event_date"] is None and rows[1]["status"] == "Not Started"
    prepared = collect(V.prepare_fixtures(fx, V.dims.PRODUCTION, "2026-03-01"))
    assert [(r["fixture_seq"], r["season"], r["_hg"], r["_fh"]) for r in prepared] == [(1, "2024-2025", 2, "madrid")]


def test_overrides_csv_last_line_wins(spark, tmp_path):
    path = tmp_path / "overrides.csv"
    path.write_text("prediction_id,home_goals,away_goals,match_date,match_type\n"
                    " p1 ,1,0,,\n p2,2,2,2025-03-01,knockout\n,3,3,,\np1,0,4,,single\n")
    ov = V.conform_overrides(read_overrides(spark, str(path)))
    got = {r["prediction_id"]: r for r in collect(ov)}
    assert set(got) == {"p1", "p2"}
    assert (got["p1"]["home_goals"], got["p1"]["away_goals"], got["p1"]["match_type"]) == (0, 4, "single")
    assert got["p2"]["match_date"] == "2025-03-01"


def test_overrides_over_several_files(spark, tmp_path):
    """Lines count in the order of file names, then of their place; the last line per id wins, however Spark cuts the files."""
    folder = tmp_path / "overrides"
    folder.mkdir()
    lines = "".join(f"q{k % 50},{k},1\n" for k in range(400))
    (folder / "b.csv").write_text("prediction_id,home_goals,away_goals\np1,2,0\np2,5,5\n" + lines + "p2,1,1\n")
    (folder / "a.csv").write_text("prediction_id,home_goals,away_goals\np1,9,9\np2,8,8\np3,7,7\n" + "".join(f"p3,{k},0\n" for k in range(300)))
    for size in ("128m", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "700" else "4m")
        try:
            got = {r["prediction_id"]: (r["home_goals"], r["away_goals"]) for r in collect(V.conform_overrides(read_overrides(spark, str(folder))))}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert (got["p1"], got["p2"], got["p3"]) == ((2, 0), (1, 1), (299, 0))
        assert [got[f"q{k}"] for k in range(50)] == [(350 + k, 1) for k in range(50)]


def test_overrides_missing_required_column_is_ignored(spark, tmp_path):
    path = tmp_path / "overrides.csv"
    path.write_text("prediction_id,home_goals\np1,1\n")
    assert read_overrides(spark, str(path)) is None
    assert read_overrides(spark, str(tmp_path / "absent.csv")) is None


def test_video_list_requires_column(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("url\nx\n")
    try:
        read_video_list(spark, str(path))
        assert False, "expected an error"
    except ValueError:
        pass


def test_conform_coerces_and_fills(spark):
    df = spark.createDataFrame([("a", "2025-3-5", "45", "x", "2026-01-01 10:00:00", "extra")],
                               "prediction_id string, match_date string, pred_home_win_pct string, "
                               "home_goals string, fetched_at string, video_url string")
    out = conform(df)
    assert out.columns == PREDICTION_COLUMNS and out.schema == PREDICTION_SCHEMA
    r = collect(out)[0]
    assert r["match_date"] == dt.date(2025, 3, 5) and r["pred_home_win_pct"] == 45 and r["home_goals"] is None
    assert r["fetched_at"] == dt.datetime(2026, 1, 1, 10, 0) and r["brier_score"] is None
