import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from pitchcast import dims
from pitchcast.operators import store as S
from pitchcast.plans import jobs as J
from pitchcast.sources.readers import read_predictions
from pitchcast.streaming import incremental as I

from conftest import collect

PARAMS = J.RunParams(run_date="2026-03-01", fetched_at="2026-03-01 00:00:00", dictionaries=dims.PRODUCTION)
FIX_SCHEMA = ("fixture_seq long, competition string, home_team string, away_team string, home_score string, "
              "away_score string, event_date date, status string")


def pred(home, away, pcts=(50, 25, 25), date="2025-03-15", comp="LaLiga"):
    return {"match_date": date, "home_team": home, "away_team": away, "competition": comp,
            "pred_home_win_pct": pcts[0], "pred_draw_pct": pcts[1], "pred_away_win_pct": pcts[2]}


def fixtures(spark):
    return spark.createDataFrame([
        (1, "LaLiga", "Real Madrid", "Barcelona", "2", "1", dt.date(2025, 3, 15), "Match Finished"),
        (2, "LaLiga", "Sevilla", "Betis", "0", "0", dt.date(2025, 4, 2), "Match Finished"),
    ], FIX_SCHEMA)


def test_extract_job(spark):
    videos = spark.createDataFrame([("https://youtu.be/AAAAAAAAAAA",), ("https://youtu.be/BBBBBBBBBBB",)],
                                   "video_url string")
    table = spark.createDataFrame([("BBBBBBBBBBB",)], "video_id string")
    meta = spark.createDataFrame([("AAAAAAAAAAA", json.dumps(
        {"items": [{"snippet": {"publishedAt": "2025-03-10T10:00:00Z", "title": "t"}}]}))],
        "video_id string, metadata_json string")
    segs = spark.createDataFrame([("AAAAAAAAAAA", "es", 1, "hola"), ("AAAAAAAAAAA", "es", 2, "mundo"),
                                  ("BBBBBBBBBBB", "es", 1, "x")], "video_id string, lang string, seq long, text string")
    got = collect(J.extract_job(videos, table, meta, segs), "video_id", "publish_date", "transcript")
    assert got == [("AAAAAAAAAAA", "2025-03-10", "hola mundo")]


def test_incremental_runs_are_idempotent(spark, tmp_path):
    landing, base, ckpt = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "ckpt")
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps({"video_id": "AAAAAAAAAAA", "publish_date": "2025-03-10",
                                                "raw_response": json.dumps([pred("Real Madrid", "Barcelona"),
                                                                            pred("Girona", "Celta")])}) + "\n")
    fx = fixtures(spark)
    I.run_available(spark, str(landing), base, fx, PARAMS, ckpt)
    t1 = {r["prediction_id"]: r for r in collect(read_predictions(spark, base))}
    assert set(t1) == {"AAAAAAAAAAA_000", "AAAAAAAAAAA_001"}
    assert t1["AAAAAAAAAAA_000"]["actual_result"] == "H" and t1["AAAAAAAAAAA_001"]["actual_result"] is None

    # no new files, but a fixture has landed: the pending row is resolved
    more = fx.unionByName(spark.createDataFrame([(3, "LaLiga", "Girona", "Celta", "1", "4", dt.date(2025, 3, 15), "Match Finished")], FIX_SCHEMA))
    I.run_available(spark, str(landing), base, more, PARAMS, ckpt)
    assert collect(read_predictions(spark, base).orderBy("prediction_id"), "actual_result") == [("H",), ("A",)]
    I.run_available(spark, str(landing), base, more, PARAMS, ckpt)     # nothing new: no new version
    assert S.latest_version(spark, base).number == 2

    (landing / "b.json").write_text(json.dumps({"video_id": "BBBBBBBBBBB", "publish_date": "2025-03-30",
                                                "raw_response": "```json\n" + json.dumps(
                                                    [pred("Sevilla", "Real Betis", date="")]) + "\n```"}) + "\n")
    I.run_available(spark, str(landing), base, fx, PARAMS, ckpt)
    t3 = {r["prediction_id"]: r for r in collect(read_predictions(spark, base))}
    assert len(t3) == 3 and t3["BBBBBBBBBBB_000"]["actual_result"] == "D"
    assert t3["BBBBBBBBBBB_000"]["match_date"] == dt.date(2025, 4, 2)


def test_report_and_pending_jobs(spark, tmp_path):
    rows = J.rows_job(spark.createDataFrame([("CCCCCCCCCCC", "2025-03-10", json.dumps(
        [pred("Real Madrid", "Barcelona"), pred("Girona", "Celta")]))],
        "video_id string, publish_date string, raw_response string"))
    table = J.resolve_job(rows, spark.createDataFrame([], "prediction_id string, actual_result string, "
                                                          "match_date date").where(F.lit(False)),
                          fixtures(spark), PARAMS)
    sections = J.report_job(table, str(tmp_path / "report"))
    assert collect(sections["summary"])[0]["total_predictions"] == 1
    assert (tmp_path / "report" / "summary").exists()
    assert collect(J.pending_job(table, "2026-01-01"), "prediction_id") == [("CCCCCCCCCCC_001",)]


def test_publish_releases_scratch_copies(spark, tmp_path):
    import os

    from pitchcast import session
    rows = J.rows_job(spark.createDataFrame([("DDDDDDDDDDD", "2025-03-10", json.dumps([pred("Real Madrid", "Barcelona")]))],
                                            "video_id string, publish_date string, raw_response string"))
    empty = spark.createDataFrame([], "prediction_id string, actual_result string, match_date date")
    resolved = J.resolve_job(rows, empty, fixtures(spark), PARAMS)
    scratch = session.scratch_inputs(resolved)
    assert len(scratch) == 3                        # predictions, fixtures, name map
    path, counters = J.publish_job(spark, str(tmp_path / "table"), resolved, PARAMS)
    assert path.endswith("version=00000001.json")
    assert collect(counters)[0]["scored"] == 1
    assert not any(os.path.exists(p) for p in scratch) and not set(scratch) & set(session._SCRATCH)
    assert collect(read_predictions(spark, str(tmp_path / "table")), "actual_result") == [("H",)]


def test_replayed_micro_batch_is_a_no_op(spark, tmp_path):
    base = str(tmp_path / "table")
    batch = spark.createDataFrame([("EEEEEEEEEEE", "2025-03-10", json.dumps([pred("Real Madrid", "Barcelona")]))],
                                  "video_id string, publish_date string, raw_response string")
    first = I.process_batch(spark, batch, base, fixtures(spark), PARAMS)
    assert first.endswith("version=00000001.json")
    assert I.process_batch(spark, batch, base, fixtures(spark), PARAMS) is None     # replay: nothing new
    assert collect(read_predictions(spark, base), "prediction_id", "actual_result") == [("EEEEEEEEEEE_000", "H")]


def page(no, events, landed="2026-01-01 00:00:00", season="2024-2025", comp="LaLiga"):
    return {"competition": comp, "season": season, "round_no": no, "landed_at": landed, "events": [
        {"strHomeTeam": h, "strAwayTeam": a, "dateEvent": day, "strStatus": s, "intHomeScore": x, "intAwayScore": y} for h, a, day, s, x, y in events]}


def response(video, *preds, day="2025-03-10"):
    return {"video_id": video, "video_url": f"https://youtu.be/{video}", "publish_date": day, "raw_response": json.dumps(list(preds))}


class Landing:
    """Two landing folders, a table and the streams' checkpoints."""

    def __init__(self, spark, path):
        self.spark, self.path, self.base = spark, path, str(path / "table")
        for d in ("responses", "pages"):
            (path / d).mkdir()

    def put(self, source, name, *docs):
        (self.path / source / f"{name}.json").write_text("".join(json.dumps(x) + "\n" for x in docs))

    def run(self, **kw):
        return I.run_sources(self.spark, str(self.path / "responses"), str(self.path / "pages"), self.base, PARAMS, str(self.path / "ckpt"), **kw)

    def rows(self):
        return {r["prediction_id"]: r["actual_result"] for r in collect(read_predictions(self.spark, self.base))}

    def version(self):
        return S.latest_version(self.spark, self.base)


FINISHED = [("Real Madrid", "Barcelona", "2025-03-15", "Match Finished", "2", "1")]
LATER = [("Girona", "Celta", "2025-03-15", "Match Finished", "0", "3")]


def test_two_sources_one_run(spark, tmp_path, monkeypatch):
    land = Landing(spark, tmp_path)
    assert land.run() is None and land.version() is None
    land.put("responses", "a", response("AAAAAAAAAAA", pred("Real Madrid", "Barcelona"), pred("Girona", "Celta"), 7, pred("Betis", "Cádiz")),
             {"video_id": "XXXXXXXXXXX", "raw_response": "sorry"})
    land.put("pages", "p1", page(1, FINISHED), page(2, [(*LATER[0][:3], "Not Started", None, None)]))

    # a crash before the commit: the streams have moved on, the table has not; the next run makes it good
    create = S.files.create_exclusive
    monkeypatch.setattr(S.files, "create_exclusive", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        land.run()
    monkeypatch.setattr(S.files, "create_exclusive", create)
    assert land.version() is None
    assert land.run().endswith("version=00000001.json")
    assert land.rows() == {"AAAAAAAAAAA_000": "H", "AAAAAAAAAAA_001": None, "AAAAAAAAAAA_003": None}
    assert land.version().batches == {"responses": 0, "pages": 0}
    rejects = collect(spark.read.parquet(f"{land.base}/_rejects/batch=00000000"), "video_id", "pos", "reject_reason")
    assert sorted(rejects, key=repr) == [("AAAAAAAAAAA", 2, "element"), ("XXXXXXXXXXX", None, "json")]
    assert land.run() is None and land.version().number == 1                       # nothing landed: nothing is committed

    # the stream's own commit of its last batch is lost, so it hands that batch out again: the table knows its number
    for f in (tmp_path / "ckpt" / "responses" / "commits").iterdir():
        f.unlink()
    assert land.run() is None and land.version().number == 1

    # a page and an override without responses: only the pending rows they concern change
    stored = {r["prediction_id"]: tuple(r) for r in read_predictions(spark, land.base).collect()}
    land.put("pages", "p2", page(2, LATER, landed="2026-01-08 00:00:00"))
    ov = spark.createDataFrame([("AAAAAAAAAAA_003", "1", "1", 1)], "prediction_id string, home_goals string, away_goals string, line_no long")
    assert land.run(overrides=ov).endswith("version=00000002.json")
    now = {r["prediction_id"]: tuple(r) for r in read_predictions(spark, land.base).collect()}
    assert land.rows() == {"AAAAAAAAAAA_000": "H", "AAAAAAAAAAA_001": "A", "AAAAAAAAAAA_003": "D"}
    assert now["AAAAAAAAAAA_000"] == stored["AAAAAAAAAAA_000"] and land.version().batches == {"responses": 0, "pages": 1}

    # responses without pages; a video that is stored already is skipped
    land.put("responses", "b", response("BBBBBBBBBBB", pred("Celta", "Getafe")), response("AAAAAAAAAAA", pred("Celta", "Girona")))
    land.run()
    assert land.rows() == {"AAAAAAAAAAA_000": "H", "AAAAAAAAAAA_001": "A", "AAAAAAAAAAA_003": "D", "BBBBBBBBBBB_000": None}
    assert land.version().batches == {"responses": 1, "pages": 1}
