"""Incremental runs over landed extractor responses and result pages with Structured Streaming.

``run_sources`` is the weekly run. Two file streams with ``trigger(availableNow=True)``, one for responses and one
for result pages, each with a checkpoint of its own, put exactly the files that arrived since the last run into numbered
batches. A run then takes every batch that the table's last version does not name, and commits the new version with
the numbers of the last batches in its manifest. That pair of numbers is the run's id: what crashes before the
commit is taken up again by the next run, what is replayed after it finds its batches named and does nothing.

``run_available`` is the older form, over responses and a ready frame of fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import store as S
from ..plans.jobs import RunParams, publish_job, refresh_job, resolve_job, route_rows, rows_job
from ..sources import files
from ..sources.readers import PAGE_SCHEMA

RESPONSE_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("video_url", T.StringType()),
    T.StructField("publish_date", T.StringType()),
    T.StructField("raw_response", T.StringType()),
])
SOURCES = {"responses": RESPONSE_SCHEMA, "pages": PAGE_SCHEMA}


def _landed(base: str, source: str) -> str:
    return f"{base.rstrip('/')}/_landed/{source}"


def stage_available(spark: SparkSession, source: str, source_dir: str, table_base: str, checkpoint_location: str) -> None:
    """Put the files that arrived since the last run into the next numbered batch of the source.

    A replayed micro-batch has the same number and the same files, and overwrites what an earlier attempt left.
    """
    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{_landed(table_base, source)}/batch={epoch:08d}")

    stream = spark.readStream.schema(SOURCES[source]).json(source_dir)
    (stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{checkpoint_location.rstrip('/')}/{source}")
     .trigger(availableNow=True).start().awaitTermination())


def _batches(spark: SparkSession, base: str, source: str, after: int, upto: int | None = None) -> tuple[DataFrame, int]:
    """The staged rows with batch numbers in (after, upto], and the last of these numbers."""
    numbers = [int(n.removeprefix("batch=")) for n in files.names(spark, _landed(base, source))]
    mine = [n for n in numbers if n > after and (upto is None or n <= upto)]
    paths = [f"{_landed(base, source)}/batch={n:08d}" for n in mine]
    rows = spark.read.schema(SOURCES[source]).parquet(*paths) if paths else spark.createDataFrame([], SOURCES[source])
    return rows, max(mine, default=after)


def process_landed(spark: SparkSession, table_base: str, params: RunParams, overrides: DataFrame | None = None) -> str | None:
    """Bring the table up to the staged batches: new responses are resolved, pending rows refreshed where pages landed.

    Returns the new manifest's path; None if the last version names all batches already.
    """
    version = S.latest_version(spark, table_base)
    done = version.batches if version else {}
    before = {s: done.get(s, -1) for s in SOURCES}
    responses, last_response = _batches(spark, table_base, "responses", before["responses"])
    _, last_page = _batches(spark, table_base, "pages", before["pages"])
    if (last_response, last_page) == (before["responses"], before["pages"]):
        return None
    table = S.read_version(spark, table_base, version)
    pages, _ = _batches(spark, table_base, "pages", -1, last_page)
    parts = []
    if last_response > before["responses"]:
        rows = route_rows(rows_job(responses, extracted_at=params.run_date), f"{table_base.rstrip('/')}/_rejects/batch={last_response:08d}")
        unseen = rows.join(table.select("video_id").distinct(), "video_id", "left_anti")
        parts.append(resolve_job(unseen, table.where(F.lit(False)), None, params, overrides, pages=pages))
    if params.refresh_pending and version and (last_page > before["pages"] or overrides is not None):
        pages_before, _ = _batches(spark, table_base, "pages", -1, before["pages"])
        parts.append(refresh_job(table, pages_before, pages, params, overrides))
    resolved = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if parts else table.where(F.lit(False))
    path, _ = publish_job(spark, table_base, resolved, params, built_on=version,
                          batches={"responses": last_response, "pages": last_page})
    return path


def run_sources(spark: SparkSession, responses_dir: str, pages_dir: str, table_base: str, params: RunParams,
                checkpoint_location: str, overrides: DataFrame | None = None) -> str | None:
    """One scheduled run over everything landed so far in both folders; the new manifest's path, None if nothing landed."""
    stage_available(spark, "responses", responses_dir, table_base, checkpoint_location)
    stage_available(spark, "pages", pages_dir, table_base, checkpoint_location)
    return process_landed(spark, table_base, params, overrides)


def process_batch(spark: SparkSession, batch: DataFrame, table_base: str, fixtures: DataFrame,
                  params: RunParams, overrides: DataFrame | None = None, rounds: DataFrame | None = None,
                  epoch: int = 0) -> str | None:
    """One micro-batch: landed responses -> new table version (None if nothing changes).

    Stored pending rows are resolved again with every batch, also one without unseen videos; a batch that
    neither adds nor resolves a row commits nothing.
    """
    version = S.latest_version(spark, table_base)
    table = S.read_version(spark, table_base, version)
    rows = route_rows(rows_job(batch, extracted_at=params.run_date), f"{table_base.rstrip('/')}/_rejects/batch={epoch:08d}")
    unseen = rows.join(table.select("video_id").distinct(), "video_id", "left_anti")
    resolved = resolve_job(unseen, table, fixtures, params, overrides, rounds)
    if unseen.isEmpty():
        resolved = resolved.where(F.col("actual_result").isNotNull())
        if resolved.isEmpty():
            return None
    path, _ = publish_job(spark, table_base, resolved, params, built_on=version)
    return path


def run_available(spark: SparkSession, landing_dir: str, table_base: str, fixtures: DataFrame,
                  params: RunParams, checkpoint_location: str, overrides: DataFrame | None = None,
                  rounds: DataFrame | None = None) -> None:
    """Process all responses landed so far, then stop; pending rows are refreshed also when nothing has landed."""
    stream = spark.readStream.schema(RESPONSE_SCHEMA).json(landing_dir)
    handled = []

    def handle(batch: DataFrame, epoch_id: int) -> None:
        handled.append(process_batch(spark, batch, table_base, fixtures, params, overrides, rounds, epoch_id))

    q = (stream.writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if not handled and params.refresh_pending and S.latest_version(spark, table_base):
        nothing = spark.createDataFrame([], RESPONSE_SCHEMA)
        process_batch(spark, nothing, table_base, fixtures, params, overrides, rounds)


__all__ = ["RESPONSE_SCHEMA", "process_batch", "process_landed", "run_available", "run_sources", "stage_available"]
