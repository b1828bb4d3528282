import datetime as dt
import json

from pyspark.sql import functions as F

from pitchcast.operators import extract as X
from pitchcast.sources.readers import parse_metadata

from conftest import collect

PRED = {"match_date": "2025-11-02", "home_team": "Getafe", "away_team": "Osasuna",
        "competition": "LaLiga", "pred_home_win_pct": 38, "pred_draw_pct": 33, "pred_away_win_pct": 29,
        "raw_quote": "un partido muy cerrado"}


def responses(spark, *texts):
    return spark.createDataFrame([(f"vid{i:08d}", t) for i, t in enumerate(texts)],
                                 "video_id string, raw_response string")


def test_parse_variants(spark):
    r = responses(spark, json.dumps([PRED]), "```json\n" + json.dumps([PRED]) + "\n```",
                  "not json", json.dumps({"error": "oops"}), "[]", json.dumps([PRED]) + " tail")
    got = collect(X.parse_responses(r).orderBy("video_id"), "parse_ok")
    assert got == [(True,), (True,), (False,), (False,), (True,), (False,)]


def test_rows_from_response(spark):
    second = {**PRED, "match_date": "", "pred_draw_pct": 0, "pred_home_win_pct": 60, "pred_away_win_pct": 20}
    third = {k: v for k, v in PRED.items() if k != "competition"}
    r = responses(spark, json.dumps([PRED, second, third]))
    rows = collect(X.build_prediction_rows(X.parse_responses(r)).orderBy("prediction_id"))
    assert [x["prediction_id"] for x in rows] == ["vid00000000_000", "vid00000000_001", "vid00000000_002"]
    a, b, c = rows
    assert a["pred_sum"] == 100 and a["pred_sum_ok"] and a["match_type"] == "single"
    assert a["match_date"] == dt.date(2025, 11, 2)
    assert b["match_type"] == "knockout" and b["pred_sum"] == 80 and not b["pred_sum_ok"]
    assert b["match_date"] is None and b["match_date_text"] is None
    assert c["competition"] == "Unknown"
    assert not any(x["reject"] for x in rows)


def test_defaults_absent_vs_null_and_truncation(spark):
    elem = {"home_team": None, "pred_home_win_pct": 45.9, "pred_draw_pct": "25"}
    r = responses(spark, json.dumps([elem, 7]))
    rows = collect(X.build_prediction_rows(X.parse_responses(r)).orderBy("prediction_id"))
    first, second = rows
    assert first["home_team"] is None          # JSON null stays null
    assert first["away_team"] == ""            # absent key -> ''
    assert first["pred_home_win_pct"] == 45    # truncation
    assert first["pred_draw_pct"] == 25        # quoted number
    assert first["pred_away_win_pct"] == 0     # absent -> 0
    assert first["raw_quote"] == ""
    assert second["reject"] is True            # element is not an object


def test_exactly_one_array(spark):
    one = json.dumps([PRED])
    texts = [one + one, one + " and also " + one, "\u00a0" + one + "\u3000", "\u2003```json\u00a0" + one + "\u00a0```\n", '[{"a": 1, "a": 2}]',
             '[1],"#end"],["x"', '[1],"v":2,"e":0},{"e":0', one + "," + one, "", None, "7", '"text"', '[NaN]', "  " + one + "  "]
    got = collect(X.parse_responses(responses(spark, *texts)).orderBy("video_id"), "parse_error")
    assert [e for e, in got] == ["json", "json", None, None, "json", "json", "json", "json", "empty", "empty", "not_array", "not_array", "json", None]


def test_rejects_have_a_reason_and_stay_out(spark):
    bad = [{**PRED, "pred_draw_pct": v} for v in ("33.5", None, "abc", [33], {}, 1e30, "")]
    good = [{**PRED, "pred_draw_pct": v} for v in ("33", " 33 ", 33.9, True)]
    r = responses(spark, json.dumps([PRED, 7, None, [PRED]] + bad + good), "nothing", "[]", '{"error": 1}')
    batch = X.extraction_batch(X.parse_responses(r)).cache()
    out = collect(X.rejected(batch).orderBy("video_id", "pos"), "video_id", "pos", "reject_reason")
    assert out == [("vid00000000", k, "element") for k in (1, 2, 3)] + [("vid00000000", k, "percentage") for k in range(4, 11)] + [
        ("vid00000001", None, "json"), ("vid00000003", None, "not_array")]
    kept = collect(X.accepted(batch).orderBy("prediction_id"), "prediction_id", "pred_draw_pct")
    assert kept == [("vid00000000_000", 33)] + [(f"vid00000000_{k:03d}", v) for k, v in zip(range(11, 15), (33, 33, 33, 1))]


def test_rows_carry_url_and_extraction_day(spark):
    df = spark.createDataFrame([("v", "https://youtu.be/v", json.dumps([PRED]))], "video_id string, video_url string, raw_response string")
    got = collect(X.build_prediction_rows(X.parse_responses(df), extracted_at="2026-03-01"), "video_url", "extracted_at")
    assert got == [("https://youtu.be/v", dt.date(2026, 3, 1))]


def test_index_over_all_elements_beyond_999(spark):
    r = responses(spark, json.dumps([PRED] * 1001))
    got = collect(X.build_prediction_rows(X.parse_responses(r)).where(F.col("prediction_id").endswith("_1000")))
    assert len(got) == 1


def test_transcripts_prefer_first_language_and_order(spark):
    segs = spark.createDataFrame([
        ("v1", "en", 0, "hello"), ("v1", "es", 2, "mundo"), ("v1", "es", 1, "hola"),
        ("v2", "en", 1, "b"), ("v2", "en", 0, "a"), ("v3", "fr", 0, "x"),
    ], "video_id string, lang string, seq long, text string")
    got = collect(X.assemble_transcripts(segs).orderBy("video_id"), "video_id", "lang", "transcript")
    assert got == [("v1", "es", "hola mundo"), ("v2", "en", "a b")]


def test_requests_cover_the_whole_text(spark):
    df = spark.createDataFrame([("t1", "ñ" * 10 + "z"), ("t2", "abc"), ("t3", ""), ("t4", None)],
                               "video_id string, transcript string")
    got = collect(X.extraction_requests(df, cap=5).orderBy("video_id", "request_no"),
                  "request", "truncated", "request_no", "n_requests")
    prefix = "Extract all match predictions from this transcript:\n\n"
    assert got == [(prefix + "ñ" * 5, True, 1, 3), (prefix + "ñ" * 5, True, 2, 3), (prefix + "z", True, 3, 3),
                   (prefix + "abc", False, 1, 1), (prefix, False, 1, 1), (None, None, 1, 1)]


def test_metadata_first_item_and_empty(spark):
    doc = {"items": [{"snippet": {"publishedAt": "2025-03-10T18:00:00Z", "title": "T1"}},
                     {"snippet": {"publishedAt": "2020-01-01T00:00:00Z", "title": "T2"}}]}
    df = spark.createDataFrame([("a", json.dumps(doc)), ("b", json.dumps({"items": []}))],
                               "video_id string, metadata_json string")
    assert collect(parse_metadata(df), "video_id", "publish_date", "title") == [("a", "2025-03-10", "T1")]


def test_transcript_runs_join_in_order(spark):
    segs = spark.createDataFrame([("v", "es", i, f"w{i}") for i in range(25)],
                                 "video_id string, lang string, seq long, text string")
    got = collect(X.assemble_transcripts(segs, chunk=4), "transcript")
    assert got == [(" ".join(f"w{i}" for i in range(25)),)]
