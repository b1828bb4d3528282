import pytest
import datetime as dt

from pyspark.sql import functions as F

from pitchcast.operators import store as S
from pitchcast.sources.readers import read_predictions, read_video_list
from pitchcast.sources.schema import PREDICTION_COLUMNS, conform

from conftest import collect

T1 = dt.datetime(2026, 1, 1)
T2 = dt.datetime(2026, 2, 1)


def table(spark, rows):
    df = spark.createDataFrame(rows, "prediction_id string, video_id string, actual_result string, "
                                     "fetched_at timestamp, publish_date date, brier_score double")
    return conform(df)


def test_dedupe_latest_nulls_last_and_new_wins_ties(spark):
    old = table(spark, [("a", "v1", "H", T1, None, 0.1), ("b", "v1", None, None, None, None),
                        ("c", "v2", "A", T2, None, 0.2)])
    new = table(spark, [("a", "v1", "A", T2, None, 0.3), ("b", "v1", "D", None, None, None),
                        ("c", "v2", None, None, None, None)])
    got = {r["prediction_id"]: (r["actual_result"], r["fetched_at"]) for r in collect(S.upsert(old, new))}
    assert got == {"a": ("A", T2), "b": ("D", None), "c": ("A", T2)}


def test_upsert_is_idempotent(spark):
    old = table(spark, [("a", "v1", "H", T1, None, 0.1)])
    new = table(spark, [("a", "v1", "A", T2, None, 0.3), ("b", "v2", None, None, None, None)])
    once = S.upsert(old, new)
    twice = S.upsert(once, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.columns == PREDICTION_COLUMNS


def test_versioned_write_and_read(spark, tmp_path):
    base = str(tmp_path / "predictions")
    assert read_predictions(spark, base).count() == 0
    t = table(spark, [("b", "v1", "H", T1, dt.date(2025, 1, 2), 0.1), ("a", "v1", None, None, None, None),
                      ("c", "v2", "A", T1, dt.date(2025, 1, 1), 0.2)])
    p1 = S.write_version(spark, t, base, partitions=2)
    assert p1.endswith("version=00000001.json")
    p2, _ = S.upsert_version(spark, table(spark, [("a", "v1", "D", T2, None, 0.5)]), base, partitions=2)
    assert p2.endswith("version=00000002.json")
    back = collect(S.ordered_for_write(read_predictions(spark, base).withColumn("month", S.month_of()), 1), "prediction_id", "actual_result")
    # canonical order: publish_date nulls last, then prediction_id
    assert back == [("c", "A"), ("b", "H"), ("a", "D")]
    # within a month the files are in that order as they lie
    assert collect(read_predictions(spark, base, ["2025-01"]), "prediction_id") == [("c",), ("b",)]
    assert collect(read_predictions(spark, base, ["none"]), "prediction_id") == [("a",)]


def by_month(n):
    return [(f"p{m:02d}{k}", f"v{k}", "H" if k % 2 else None, T1 if k % 2 else None, dt.date(2025, m, 3) if m else None, 0.1 if k % 2 else None)
            for m in range(0, 6) for k in range(n)]


def test_upsert_writes_only_touched_months(spark, tmp_path):
    base = str(tmp_path / "t")
    S.write_version(spark, table(spark, by_month(4)), base)
    first = S.latest_version(spark, base)
    stamps = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "data").rglob("part-*")}
    assert (first.rows, first.scored, set(first.months)) == (24, 12, {"none", "2025-01", "2025-02", "2025-03", "2025-04", "2025-05"})
    # a changed row of March; a new one of May; a row of February that has moved to a month the table does not have
    batch = table(spark, [("p030", "v0", "D", T2, dt.date(2025, 3, 3), 0.3), ("x", "v9", None, None, dt.date(2025, 5, 9), None),
                          ("p021", "v1", "A", T2, dt.date(2025, 8, 1), 0.4)])
    path, counters = S.upsert_version(spark, batch, base)
    now = S.latest_version(spark, base)
    assert {m for m in now.months if now.months[m] != first.months.get(m)} == {"2025-02", "2025-03", "2025-05", "2025-08"}
    written = {f.parent.name for f in (tmp_path / "t" / "data").rglob("part-*") if f not in stamps}
    assert written == {"month=2025-02", "month=2025-03", "month=2025-05", "month=2025-08"}
    assert all(f.stat().st_mtime_ns == t for f, t in stamps.items())                # nothing old is touched
    assert counters == {"existing_rows": 24, "existing_videos": 4, "new_rows": 3, "scored": 13, "pending": 12}
    whole = S.upsert(table(spark, by_month(4)), batch)
    assert sorted(map(tuple, read_predictions(spark, base).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert (now.rows, now.scored) == (25, 13)


def test_a_month_that_empties_leaves_the_version(spark, tmp_path):
    base = str(tmp_path / "t")
    S.write_version(spark, table(spark, [("a", "v", "H", T1, dt.date(2025, 1, 1), 0.1)]), base)
    S.upsert_version(spark, table(spark, [("a", "v", "A", T2, dt.date(2025, 2, 1), 0.1)]), base)
    assert set(S.latest_version(spark, base).months) == {"2025-02"} and read_predictions(spark, base).count() == 1


def test_dry_run_and_empty_batch(spark, tmp_path):
    base = str(tmp_path / "t")
    batch = table(spark, [("a", "v", "H", T1, dt.date(2025, 1, 1), 0.1)])
    path, counters = S.upsert_version(spark, batch, base, dry_run=True)
    assert path is None and counters["scored"] == 1 and S.latest_version(spark, base) is None
    S.upsert_version(spark, batch, base)
    path, counters = S.upsert_version(spark, table(spark, []), base, batches={"responses": 4})
    assert counters["existing_rows"] == 1 and counters["scored"] == 1
    now = S.latest_version(spark, base)
    assert (now.number, now.batches, now.rows) == (2, {"responses": 4}, 1) and read_predictions(spark, base).count() == 1


def test_list_pending(spark):
    t = table(spark, [("a", "v", None, None, dt.date(2025, 1, 1), None), ("b", "v", None, None, None, None),
                      ("c", "v", "H", T1, dt.date(2025, 1, 1), 0.1), ("d", "v", None, None, dt.date(2027, 1, 1), None)])
    assert collect(S.list_pending(t, "2026-01-01"), "prediction_id") == [("a",)]


def test_new_videos_and_video_list(spark, tmp_path):
    path = tmp_path / "videos.csv"
    path.write_text("video_url\nhttps://youtu.be/AAAAAAAAAAA\nhttps://www.youtube.com/watch?v=BBBBBBBBBBB\n"
                    "https://example.com/x\n\nhttps://youtu.be/AAAAAAAAAAA\n")
    videos = read_video_list(spark, str(path))
    existing = table(spark, [("p", "BBBBBBBBBBB", None, None, None, None)])
    assert collect(S.new_videos(videos, existing), "video_id") == [("AAAAAAAAAAA",)]


def test_run_counters(spark):
    old = table(spark, [("a", "v1", "H", T1, None, 0.1), ("b", "v1", None, None, None, None)])
    new = table(spark, [("c", "v2", "A", T2, None, 0.3)])
    got = collect(S.run_counters(old, new))[0]
    assert got == {"existing_rows": 2, "existing_videos": 1, "new_rows": 1, "scored": 2, "pending": 1}


def test_uncommitted_version_is_invisible(spark, tmp_path):
    base = str(tmp_path / "t")
    t = table(spark, [("a", "v1", "H", T1, None, 0.1)])
    S.write_version(spark, t, base)
    # a crashed writer left data files but no manifest
    S._write_months(spark, table(spark, [("z", "v9", None, None, None, None)]), base, None)
    assert collect(read_predictions(spark, base), "prediction_id") == [("a",)]
    path = S.write_version(spark, table(spark, [("b", "v2", "A", T2, None, 0.2)]), base)
    assert path.endswith("version=00000002.json")
    assert collect(read_predictions(spark, base), "prediction_id") == [("b",)]


def test_unreadable_commit_raises(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([("a_1", "a")], "prediction_id string, video_id string")
    S.write_version(spark, rows, base)
    (tmp_path / "t" / "_commits" / "version=00000002.json").write_text("{not json")
    with pytest.raises(ValueError):
        read_predictions(spark, base)


def test_second_writer_on_the_same_base_fails(spark, tmp_path):
    base = str(tmp_path / "t")
    one, two = (spark.createDataFrame([(k, k)], "prediction_id string, video_id string") for k in ("a", "b"))
    seen = S.latest_version(spark, base)
    S.write_version(spark, one, base, built_on=seen)
    with pytest.raises(S.StaleVersion):
        S.write_version(spark, two, base, built_on=seen)


def test_of_two_commits_of_one_number_one_fails(spark, tmp_path, monkeypatch):
    """Both writers have passed the check and written their files; the manifest's name decides."""
    base = str(tmp_path / "t")
    S.write_version(spark, table(spark, [("a", "v", None, None, dt.date(2025, 1, 1), None)]), base)
    seen = S.latest_version(spark, base)
    late = table(spark, [("late", "v", "H", T1, dt.date(2025, 1, 1), 0.1)])
    write = S._write_months

    def overtaken(*args):
        monkeypatch.setattr(S, "_write_months", write)
        done = write(*args)
        S.upsert_version(spark, table(spark, [("first", "v", "H", T1, dt.date(2025, 1, 1), 0.1)]), base, built_on=seen)
        return done

    monkeypatch.setattr(S, "_write_months", overtaken)
    with pytest.raises(S.StaleVersion):
        S.upsert_version(spark, late, base, built_on=seen)
    now = S.latest_version(spark, base)
    assert now.number == 2 and {r["prediction_id"] for r in read_predictions(spark, base).collect()} == {"a", "first"}
    folders = {f.split("/")[1] for f in [*seen.months.values(), *now.months.values()]}
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == folders       # the loser's files are gone


def test_counters_need_no_second_upsert(spark):
    old = table(spark, [("a", "v1", "H", T1, None, 0.1)])
    plan = S.run_counters(old, old)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "Join" not in plan


def test_stored_duplicates_go(spark):
    e = spark.createDataFrame([("a", "v"), ("a", "v"), ("b", "v")], "prediction_id string, video_id string")
    n = spark.createDataFrame([("c", "v")], "prediction_id string, video_id string")
    assert sorted(r["prediction_id"] for r in S.upsert(e, n).collect()) == ["a", "b", "c"]
