"""

Every query reads the driver's tables (through the derived views of
``pitchcast.sources.testviews``) in full and runs the library operator on
them; ``oracle_sql()`` re-states the same result in DuckDB SQL.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles as O  # noqa: E402
from pitchcast import dims  # noqa: E402
from pitchcast.functions.scoring import (  # noqa: E402
    brier_2way, brier_3way, brier_score, classify_match_type, result_code)
from pitchcast.functions.text import canonical_name, parse_video_id  # noqa: E402
from pitchcast.operators import extract as X  # noqa: E402
from pitchcast.operators import pages as P  # noqa: E402
from pitchcast.operators import report as R  # noqa: E402
from pitchcast.operators import resolve as V  # noqa: E402
from pitchcast.operators import store as S  # noqa: E402
from pitchcast.plans import jobs as J  # noqa: E402
from pitchcast.session import materialize, scratch_path  # noqa: E402
from pitchcast.sources import testviews as tv  # noqa: E402
from pitchcast.sources.readers import (  # noqa: E402
    parse_metadata, read_overrides, read_predictions, read_video_list)
from pitchcast.sources.schema import PREDICTION_COLUMNS, conform  # noqa: E402

D = dims.TEST
RUN_DATE = tv.RUN_DATE
RUN_TS = tv.RUN_FETCHED_AT
SMOKE_DIR = "/root/testdata/sf0.001"

PCTS = ("pred_home_win_pct", "pred_draw_pct", "pred_away_win_pct")


# ----------------------------------------------------------------------------- inputs

def stored_table(spark: SparkSession, sf: str) -> DataFrame:
    """The prediction table as the publish job leaves it (scored, stamped)."""
    v = tv.predictions(spark, sf)
    v = v.withColumn("brier_score", brier_score(*PCTS, "match_type", "actual_result"))
    v = v.withColumn("fetched_at", F.when(F.col("actual_result").isNotNull(),
                                          F.lit(tv.STORED_FETCHED_AT).cast("timestamp")))
    return conform(v)


def new_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Freshly extracted predictions: no result columns yet."""
    return tv.predictions(spark, sf).drop("actual_result")


def incoming_batch(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    """A re-run of every third month of the stored predictions; with ``whole``, of all of them."""
    nb = (tv.whole_batch if whole else tv.new_batch)(spark, sf)
    return conform(nb.withColumn("brier_score", brier_score(*PCTS, "match_type", "actual_result")))


def _resolution(spark, sf, preds=None):
    preds = tv.predictions(spark, sf) if preds is None else preds
    return V.prepared_inputs(preds, tv.fixtures(spark, sf), D, RUN_DATE)


def _overrides(spark, sf):
    return V.conform_overrides(tv.overrides(spark, sf))


def _rows(spark, sf):
    return X.build_prediction_rows(X.parse_responses(tv.responses(spark, sf)), extracted_at=RUN_DATE)


# ----------------------------------------------------------------------------- queries

def q_summary_stats(spark, sf):
    return R.summary_stats(stored_table(spark, sf))


def q_score_predictions(spark, sf):
    t = tv.predictions(spark, sf)
    return t.select("prediction_id", "match_type", "actual_result",
                    brier_score(*PCTS, "match_type", "actual_result").alias("brier_score"))


def q_brier_3way(spark, sf):
    t = tv.predictions(spark, sf).where(F.col("actual_result").isNotNull())
    return t.select("prediction_id", brier_3way(*PCTS, "actual_result").alias("brier_3way"))


def q_brier_2way(spark, sf):
    t = tv.predictions(spark, sf).where(F.col("actual_result").isNotNull())
    return t.select("prediction_id", brier_2way("pred_home_win_pct", "pred_away_win_pct",
                                                "actual_result").alias("brier_2way"))


def q_scored_rows(spark, sf):
    return R.scored(stored_table(spark, sf))


def q_list_pending(spark, sf):
    return S.list_pending(stored_table(spark, sf), tv.PENDING_AS_OF)


def q_classify_match_type(spark, sf):
    t = tv.predictions(spark, sf)
    return t.select("prediction_id", "pred_draw_pct", classify_match_type("pred_draw_pct").alias("match_type"))


def q_result_code(spark, sf):
    f = tv.fixtures(spark, sf)
    hg = F.col("home_score").try_cast("int")
    ag = F.col("away_score").try_cast("int")
    return f.select("fixture_seq", hg.alias("home_goals"), ag.alias("away_goals"),
                    result_code(hg, ag).alias("actual_result"))


def q_competition_breakdown(spark, sf):
    return R.competition_breakdown(stored_table(spark, sf))


def q_accuracy_by_competition(spark, sf):
    return R.accuracy_by_competition(stored_table(spark, sf))


def q_monthly_trend(spark, sf):
    return R.monthly_trend(stored_table(spark, sf))


def q_quarterly_trend(spark, sf):
    return R.quarterly_trend(stored_table(spark, sf))


def q_trend_direction(spark, sf):
    return R.trend_direction(R.quarterly_trend(stored_table(spark, sf)))


def q_brier_histogram(spark, sf):
    return R.brier_histogram(stored_table(spark, sf))


def q_distribution_markers(spark, sf):
    return R.distribution_markers(stored_table(spark, sf))


def q_benchmark_comparison(spark, sf):
    return R.benchmark_comparison(stored_table(spark, sf))


def q_recent_predictions(spark, sf):
    return R.recent_predictions(stored_table(spark, sf))


def q_recent_display(spark, sf):
    return R.recent_display(R.recent_predictions(stored_table(spark, sf)))


def q_parse_video_id(spark, sf):
    return tv.page_urls(spark, sf).select("page_id", parse_video_id("url").alias("video_id"))


def q_normalise_team(spark, sf):
    p = tv.predictions(spark, sf)
    f = tv.fixtures(spark, sf)
    names = (p.select(F.col("home_team").alias("name")).unionByName(p.select(F.col("away_team").alias("name")))
             .unionByName(f.select(F.col("home_team").alias("name")))
             .unionByName(f.select(F.col("away_team").alias("name"))).distinct())
    return names.select("name", canonical_name(F.col("name"), D).alias("canonical"))


def q_team_name_map(spark, sf):
    _, _, nm = _resolution(spark, sf)
    return nm


def q_infer_season(spark, sf):
    p = V.prepare_predictions(tv.predictions(spark, sf), D, RUN_DATE)
    return p.select("prediction_id", "competition", F.col("_season").alias("season"))


def q_fetch_plan(spark, sf):
    return V.fetch_plan(V.prepare_predictions(tv.predictions(spark, sf), D, RUN_DATE), D)


def q_unsupported_competitions(spark, sf):
    return V.unsupported_competitions(tv.predictions(spark, sf), D)


def q_round_cutoff(spark, sf):
    return V.round_cutoff(tv.rounds(spark, sf), D)


def q_resolve_single_leg(spark, sf):
    p, fx, nm = _resolution(spark, sf)
    return V.resolve_single_leg(p, fx, nm)


def q_resolve_two_leg(spark, sf):
    p, fx, nm = _resolution(spark, sf)
    return V.resolve_two_leg(p, fx, nm, D)


def q_tied_aggregates(spark, sf):
    p, fx, nm = _resolution(spark, sf)
    t = V.resolve_two_leg(p, fx, nm, D).where(F.col("status") == "tied")
    return t.select("prediction_id", "leg1_seq", "leg2_seq",
                    F.col("home_goals").alias("team1_total"), F.col("away_goals").alias("team2_total"))


def q_resolve_results(spark, sf):
    p, fx, nm = _resolution(spark, sf)
    return V.resolve_results(p, fx, D, nm)


def q_conform_overrides(spark, sf):
    return _overrides(spark, sf)


def q_apply_overrides(spark, sf):
    return V.apply_overrides(tv.predictions(spark, sf), _overrides(spark, sf))


def q_attach_results(spark, sf):
    return V.attach_results(new_predictions(spark, sf), tv.fixtures(spark, sf), D, RUN_DATE, RUN_TS,
                            overrides=_overrides(spark, sf))


def q_refresh_pending(spark, sf):
    table = stored_table(spark, sf)
    pending = table.where(F.col("actual_result").isNull())
    refreshed = V.attach_results(pending, tv.fixtures(spark, sf), D, RUN_DATE, RUN_TS)
    return S.upsert(table, refreshed)


def q_new_videos(spark, sf):
    return S.new_videos(tv.video_list(spark, sf), stored_table(spark, sf))


def q_dedupe_latest(spark, sf):
    u = S.union_batches(stored_table(spark, sf), incoming_batch(spark, sf))
    return S.dedupe_latest(u).select("prediction_id", "actual_result", "fetched_at",
                                     F.col("_is_new").alias("is_new"))


def q_upsert_predictions(spark, sf):
    return S.upsert(stored_table(spark, sf), incoming_batch(spark, sf))


def q_run_counters(spark, sf):
    return S.run_counters(stored_table(spark, sf), incoming_batch(spark, sf, whole=True))


def q_rounds_from_pages(spark, sf):
    return P.rounds_from_pages(P.latest_pages(tv.result_pages(spark, sf)), D)


def q_landed_fixtures(spark, sf):
    plan = P.ordered_plan(V.prepare_predictions(tv.predictions(spark, sf), D, RUN_DATE), D)
    return P.landed_fixtures(tv.result_pages(spark, sf), plan, D)


def q_refresh_delta(spark, sf):
    fixtures = tv.fixtures(spark, sf)
    gained = fixtures.where(F.col("event_date") >= F.lit(tv.GAINED_FROM).cast("date"))
    pending = stored_table(spark, sf).where(F.col("actual_result").isNull())
    return V.refresh(pending, fixtures, gained, D, RUN_DATE, RUN_TS)


def q_rejected_rows(spark, sf):
    return X.rejected(X.extraction_batch(X.parse_responses(tv.responses(spark, sf))))


def q_transcript_assembly(spark, sf):
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    t = X.assemble_transcripts(conv, languages=("assistant", "user"), key="conv_id", lang="role",
                               order="turn", text="text")
    return t.select("conv_id", F.col("role").alias("lang"), "transcript")


def q_extraction_requests(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("transcript"))
    r = X.extraction_requests(docs)
    return r.select("doc_id", "request_no", "n_requests", "request", "truncated", F.char_length("request").alias("request_chars"))


def q_parse_responses(spark, sf):
    p = X.parse_responses(tv.responses(spark, sf))
    n = F.coalesce(F.array_size(F.variant_get(F.col("parsed"), "$", "array<variant>")), F.lit(0))
    return p.select("video_id", "parse_ok", "parse_error", n.alias("n_predictions"))


def q_build_prediction_rows(spark, sf):
    return _rows(spark, sf).select(
        "prediction_id", "video_id", "video_url", "publish_date", "match_date", "home_team", "away_team", "competition",
        "match_type", "leg_number", *PCTS, "pred_sum", "pred_sum_ok", "raw_quote", "extracted_at", "reject", "reject_reason")


def q_pred_sum_check(spark, sf):
    rows = X.accepted(_rows(spark, sf))
    return rows.groupBy("competition").agg(
        F.count("*").alias("n"), F.count_if("pred_sum_ok").alias("n_sum_ok"),
        F.count_if(~F.col("pred_sum_ok")).alias("n_sum_bad"))


def q_video_list_csv(spark, sf):
    """The video list as a landed CSV file with one more column and blank lines."""
    path = scratch_path(spark, "videos")
    listed = tv.video_list(spark, sf).select(F.lit("note").alias("note"), F.when(~F.col("video_url").endswith("7"), F.col("video_url")).alias("video_url"))
    listed.write.option("header", True).csv(path)
    return read_video_list(spark, path)


def q_overrides_csv(spark, sf):
    """The override lines landed as several CSV files, in their order; the last line per id wins."""
    path = scratch_path(spark, "overrides")
    lines = tv.overrides(spark, sf).repartitionByRange(6, "line_no").sortWithinPartitions("line_no").drop("line_no")
    lines.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return V.conform_overrides(read_overrides(spark, path))


def _published(spark, sf, dry_run=False):
    """The stored table written as a version, then the batch upserted into its months: (base, counters)."""
    base = scratch_path(spark, "table")
    S.write_version(spark, stored_table(spark, sf), base)
    return base, S.upsert_version(spark, materialize(incoming_batch(spark, sf), "batch"), base, dry_run=dry_run)[1]


def q_published_table(spark, sf):
    return read_predictions(spark, _published(spark, sf)[0])


def q_publish_counters(spark, sf):
    counters = _published(spark, sf)[1]
    return spark.createDataFrame([tuple(counters.values())], ", ".join(f"{c} long" for c in counters))


def q_dry_run(spark, sf):
    """A dry run counts what a run would leave, and leaves the table as it was."""
    base, counters = _published(spark, sf, dry_run=True)
    return read_predictions(spark, base).agg(F.count("*").alias("rows_left")).select(
        "rows_left", *[F.lit(n).cast("long").alias(c) for c, n in counters.items()])


def q_report_cube(spark, sf):
    return R.report_cube(stored_table(spark, sf)).withColumn("s2", F.col("s2").cast("bigint"))


def q_extract_job(spark, sf):
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    segments = conv.select(F.lpad(F.col("conv_id").cast("string"), 11, "0").alias("video_id"), F.col("role").alias("lang"),
                           F.col("turn").cast("long").alias("seq"), "text")
    table = stored_table(spark, sf).where(F.col("video_id") % 3 == 0)
    requests = J.extract_job(tv.video_list(spark, sf), table, tv.metadata(spark, sf), segments, ("assistant", "user"))
    return requests.select("video_id", "video_url", "publish_date", "title", "lang", "request_no", "n_requests", "request")


def q_video_metadata(spark, sf):
    return parse_metadata(tv.metadata(spark, sf))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the all-time summary (mean Brier, accuracy, badge) at sf0.001."""
    return q_summary_stats(spark, SMOKE_DIR)


def _training_data():
    """(queries, oracles) of the training-data operators; none where that subpackage is not installed."""
    try:
        import corpus_pipeline
        from pitchcast.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "pitchcast.llm"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm.queries() | {"pipeline": corpus_pipeline.run}, llm.oracle_sql() | sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return O.all_oracles() | _training_data()[1]


__all__ = ["entry", "queries", "oracle_sql", "PREDICTION_COLUMNS"]
