"""End-to-end jobs: what a scheduled run calls.

extract_job  video list -> unseen videos -> metadata + transcript -> extractor requests
rows_job     landed extractor responses -> prediction rows and rejects, routed
resolve_job  new rows (+ stored pending rows) -> overrides / fixtures or landed pages -> scored rows
refresh_job  newly landed pages -> the stored pending rows that they resolve
publish_job  upsert into the versioned table (+ run counters), unless dry-run
report_job   report sections from the table, optionally written one folder each
pending_job  unresolved predictions published on or before a date
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..dims import Dictionaries
from ..functions.dates import lenient_date
from ..operators import extract as X
from ..operators import pages as P
from ..operators import report as R
from ..operators import resolve as V
from ..operators import store as S
from ..session import materialize, release_materialized, scratch_inputs
from ..sources.readers import parse_metadata


@dataclass(frozen=True)
class RunParams:
    run_date: str                      # stands in for "today" (season fallback, pending cut-off)
    fetched_at: str                    # one timestamp stamped on every row resolved in this run
    dictionaries: Dictionaries = field(default_factory=lambda: dims.PRODUCTION)
    refresh_pending: bool = True       # also re-resolve stored pending rows (documented intent)
    dry_run: bool = False


def extract_job(video_list: DataFrame, table: DataFrame, metadata: DataFrame, segments: DataFrame,
                languages=("es", "en")) -> DataFrame:
    """Extractor requests for videos not yet in the table.

    ``metadata``: (video_id, metadata_json); ``segments``: (video_id, lang, seq, text).
    Videos without metadata items or without a transcript are dropped.
    """
    todo = S.new_videos(video_list, table)
    meta = parse_metadata(metadata).join(todo.select("video_id"), "video_id", "left_semi")
    segs = segments.join(todo.select("video_id"), "video_id", "left_semi")
    transcripts = X.assemble_transcripts(segs, languages)
    return X.extraction_requests(transcripts.join(meta, "video_id").join(todo, "video_id"))


def rows_job(responses: DataFrame, metadata: DataFrame | None = None, extracted_at: str | None = None) -> DataFrame:
    """The routed batch of landed responses (video_id, raw_response[, video_url, publish_date]).

    Predictions have ``reject = false``; what the table must not hold has a reason (``operators.extract.extraction_batch``).
    """
    if metadata is not None and "publish_date" not in responses.columns:
        responses = responses.join(parse_metadata(metadata).select("video_id", "publish_date"), "video_id", "left")
    rows = X.extraction_batch(X.parse_responses(responses), extracted_at=extracted_at)
    if "publish_date" in rows.columns:
        rows = rows.withColumn("publish_date", lenient_date(F.col("publish_date").cast("string")))
    return rows


def route_rows(rows: DataFrame, rejects_path: str) -> DataFrame:
    """One evaluated pass with two sinks: the rejects go to ``rejects_path``, the predictions come back.

    The batch is parsed once, by the write of its stored copy; both sinks read that copy.
    """
    batch = materialize(rows, "routed-batch")
    X.rejected(batch).write.mode("overwrite").parquet(rejects_path)
    return X.accepted(batch)


def _with_date_text(rows: DataFrame) -> DataFrame:
    if "match_date_text" in rows.columns:
        return rows
    return rows.withColumn("match_date_text", F.date_format("match_date", "yyyy-MM-dd"))


def fixtures_for(rows: DataFrame, pages: DataFrame, params: RunParams) -> DataFrame:
    """The landed fixtures of the seasons that ``rows`` ask for, in source order."""
    d = params.dictionaries
    return P.landed_fixtures(pages, P.ordered_plan(V.prepare_predictions(rows, d, params.run_date), d), d)


def resolve_job(new_rows: DataFrame, table: DataFrame, fixtures: DataFrame | None, params: RunParams,
                overrides: DataFrame | None = None, rounds: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """Scored rows for the new batch, plus stored pending rows when refreshing.

    Fixtures come ready (``fixtures``, cut off by ``rounds`` if given) or from landed result ``pages``. The rejects of a
    routed batch take no part.
    """
    batch = _with_date_text(X.accepted(new_rows) if "reject" in new_rows.columns else new_rows)
    if params.refresh_pending:
        pending = _with_date_text(table.where(F.col("actual_result").isNull()))
        pending = pending.join(batch.select("prediction_id"), "prediction_id", "left_anti")
        batch = batch.unionByName(pending, allowMissingColumns=True)
    if pages is not None:
        fixtures = fixtures_for(batch, pages, params)
    kept = V.round_cutoff(rounds, params.dictionaries) if rounds is not None else None
    ov = V.conform_overrides(overrides) if overrides is not None else None
    return V.attach_results(batch, fixtures, params.dictionaries, params.run_date, params.fetched_at,
                            overrides=ov, kept_rounds=kept)


def refresh_job(table: DataFrame, pages_before: DataFrame, pages: DataFrame, params: RunParams,
                overrides: DataFrame | None = None) -> DataFrame:
    """The stored pending rows that the pages landed since ``pages_before`` resolve, and no others."""
    d = params.dictionaries
    pending = table.where(F.col("actual_result").isNull())
    plan = P.ordered_plan(V.prepare_predictions(pending, d, params.run_date), d)
    ov = V.conform_overrides(overrides) if overrides is not None else None
    return V.refresh(pending, P.landed_fixtures(pages, plan, d), P.gained_fixtures(pages_before, pages, plan, d), d,
                     params.run_date, params.fetched_at, overrides=ov)


def publish_job(spark: SparkSession, table_base: str, resolved: DataFrame, params: RunParams,
                partitions: int | None = None, built_on=S._ANY, batches: dict[str, int] | None = None):
    """Upsert ``resolved`` into the table at ``table_base``; returns (new manifest's path or None, counters).

    The resolved batch is materialized once; afterwards every scratch copy of the
    run is deleted. The counters come with the write.
    """
    current = S.latest_version(spark, table_base) if built_on is S._ANY else built_on
    scratch = scratch_inputs(resolved)                    # this run's resolution copies
    batch = materialize(resolved, "resolved-batch")       # resolution runs once
    scratch += scratch_inputs(batch)
    path, counters = S.upsert_version(spark, batch, table_base, partitions, current, batches, params.dry_run)
    # nothing reads this run's scratch copies any more: free the shared folder
    release_materialized(spark, scratch)
    return path, spark.createDataFrame([tuple(counters.values())], ", ".join(f"{c} long" for c in counters))


def report_job(table: DataFrame, out_dir: str | None = None, fmt: str = "json") -> dict[str, DataFrame]:
    """All report sections; with ``out_dir`` each one is written to ``out_dir/<section>``.

    One scan of the table gives the stored cube that all sections but ``recent`` are rolled up from.
    """
    sections = R.section_tables(table, materialize(R.report_cube(table), "report-cube"))
    if out_dir:
        for name, df in sections.items():
            df.coalesce(1).write.mode("overwrite").format(fmt).save(f"{out_dir.rstrip('/')}/{name}")
    return sections


def pending_job(table: DataFrame, as_of: str) -> DataFrame:
    return S.list_pending(table, as_of)
