"""The prediction table as an idempotent, versioned parquet dataset.

Upsert = union by name -> latest-wins dedupe per prediction_id -> conform ->
range-ordered write of the touched months to *new* folders, committed by creating
the manifest ``_commits/version=N.json``, which must not exist yet.  A manifest names the
folder of each month; folders are never changed.  Readers take the highest
version, so a failed or concurrent write never clobbers (or exposes) anything,
and re-running a batch yields the same table (latest-wins with a deterministic
tie-break).
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import parse_video_id
from ..sources import files
from ..sources.schema import PREDICTION_COLUMNS, PREDICTION_SCHEMA, conform, empty_predictions

NO_MONTH = "none"


def new_videos(video_list: DataFrame, existing: DataFrame) -> DataFrame:
    """Video ids to process: parsable, not already stored, one URL per id."""
    parsed = video_list.select(parse_video_id(F.col("video_url")).alias("video_id"), "video_url")
    seen = existing.select("video_id").where(F.col("video_id").isNotNull()).distinct()
    return (parsed.where(F.col("video_id").isNotNull())
            .join(seen, "video_id", "left_anti")
            .groupBy("video_id").agg(F.min("video_url").alias("video_url")))


def _latest_first():
    # newest fetch first; a stored row loses a tie against the incoming batch;
    # the content hash makes any remaining tie deterministic
    return [F.col("fetched_at").desc_nulls_last(), F.col("_is_new").desc(),
            F.xxhash64(*[F.col(c) for c in PREDICTION_COLUMNS]).desc()]


def union_batches(existing: DataFrame, new: DataFrame) -> DataFrame:
    return (conform(existing).withColumn("_is_new", F.lit(0))
            .unionByName(conform(new).withColumn("_is_new", F.lit(1))))


def dedupe_latest(rows: DataFrame, key: str = "prediction_id") -> DataFrame:
    """Keep one row per key: latest ``fetched_at`` (nulls last)."""
    if "_is_new" not in rows.columns:
        rows = rows.withColumn("_is_new", F.lit(0))
    w = Window.partitionBy(key).orderBy(*_latest_first())
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """existing ∪ new, latest wins per prediction, conformed to the table schema.

    All rows take part, so that a stored table that already repeats an id comes
    out with one row for it as well.
    """
    return conform(dedupe_latest(union_batches(conform(existing), conform(new))).drop("_is_new"))


def month_of(publish_date="publish_date"):
    """The folder a row lies in: its month of publication, or ``none``."""
    return F.coalesce(F.date_format(publish_date, "yyyy-MM"), F.lit(NO_MONTH))


def ordered_for_write(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Canonical table order (publish_date nulls last, prediction_id) via a range
    partitioning + per-partition sort, so no single task sorts the table."""
    keys = [F.col("publish_date").asc_nulls_last(), F.col("prediction_id").asc()]
    parted = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return parted.sortWithinPartitions("month", *keys)


@dataclass(frozen=True)
class Version:
    """One committed state of the table: which folder holds each month, and what it adds up to."""

    number: int
    months: dict[str, str] = field(default_factory=dict)      # month -> folder, relative to the table
    rows: int = 0
    scored: int = 0
    batches: dict[str, int] = field(default_factory=dict)     # source -> last landed batch that is part of it

    def folders(self, base: str, months=None) -> list[str]:
        return [f"{base.rstrip('/')}/{f}" for m, f in sorted(self.months.items()) if months is None or m in months]


def _commit_path(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/_commits/version={number:08d}.json"


def latest_version(spark: SparkSession, base: str) -> Version | None:
    """The newest committed version; None if there is no table.

    A version is committed only once its manifest exists, after its data files
    are in place, so a half-written version is never read. A manifest that cannot be
    read raises (after a moment, in which its writer may be closing it).
    """
    found = files.names(spark, f"{base.rstrip('/')}/_commits")
    if not found:
        return None
    path = f"{base.rstrip('/')}/_commits/{found[-1]}"
    for wait in (0.1, 0.5, 2, None):
        try:
            return Version(**json.loads(files.read_text(spark, path)))
        except (json.JSONDecodeError, TypeError) as e:
            if wait is None:
                raise ValueError(f"the commit {path} cannot be read") from e
            time.sleep(wait)


class StaleVersion(RuntimeError):
    """Another writer has committed since the version that the data was built on."""


_ANY = object()


def commit(spark: SparkSession, base: str, version: Version) -> str:
    """Make ``version`` the table's state; raises StaleVersion if its number is taken. Returns the manifest's path."""
    path = _commit_path(base, version.number)
    if not files.create_exclusive(spark, path, json.dumps(asdict(version))):
        raise StaleVersion(base)
    return path


def _write_months(spark: SparkSession, df: DataFrame, base: str, partitions: int | None):
    """Write ``df`` to a new folder, a subfolder for each month; (month -> folder, rows, scored), counted by the write itself."""
    token = f"data/{uuid.uuid4().hex}"
    seen = Observation()
    # right above the write: below the range partitioning, its sampling would count the rows as well
    rows = (ordered_for_write(conform(df).withColumn("month", month_of()), partitions)
            .observe(seen, F.count(F.lit(1)).alias("rows"), F.count("brier_score").alias("scored")))
    rows.write.partitionBy("month").parquet(f"{base.rstrip('/')}/{token}")
    months = {n.removeprefix("month="): f"{token}/{n}" for n in files.names(spark, f"{base.rstrip('/')}/{token}")}
    counted = seen.get if months else {}
    return token, months, counted.get("rows", 0), counted.get("scored", 0)


def write_version(spark: SparkSession, df: DataFrame, base: str, partitions: int | None = None, built_on=_ANY,
                  batches: dict[str, int] | None = None) -> str:
    """Write ``df`` as the whole next version of the table at ``base``; returns its manifest's path.

    ``built_on`` is the version that ``latest_version`` gave when ``df`` was read (None: no
    table): if another one has been committed since, nothing is committed and
    StaleVersion is raised, so the caller reads again and retries.
    """
    current = latest_version(spark, base)
    if built_on is not _ANY and built_on != current:
        raise StaleVersion(base)
    token, months, rows, scored = _write_months(spark, df, base, partitions)
    return _commit_or_clean(spark, base, token, Version(_next(current), months, rows, scored, batches or {}))


def _next(current: Version | None) -> int:
    return 1 if current is None else current.number + 1


def _commit_or_clean(spark: SparkSession, base: str, token: str, version: Version) -> str:
    try:
        return commit(spark, base, version)
    except StaleVersion:
        files.delete(spark, f"{base.rstrip('/')}/{token}")
        raise


def read_version(spark: SparkSession, base: str, version: Version | None, months=None) -> DataFrame:
    """The rows of a version, of some months if they are named (other folders are not opened)."""
    folders = version.folders(base, months) if version else []
    return spark.read.schema(PREDICTION_SCHEMA).parquet(*folders) if folders else empty_predictions(spark)


def touched_months(stored: DataFrame, batch: DataFrame) -> list[str]:
    """The months a batch changes: those of its rows, and those where rows with its ids lie. A few strings."""
    ids = batch.select("prediction_id").distinct()
    held = stored.select("prediction_id", "publish_date").join(ids, "prediction_id", "left_semi")
    months = batch.select(month_of().alias("m")).unionByName(held.select(month_of().alias("m"))).distinct()
    return sorted(r["m"] for r in months.collect())


def upsert_version(spark: SparkSession, batch: DataFrame, base: str, partitions: int | None = None, built_on=_ANY,
                   batches: dict[str, int] | None = None, dry_run: bool = False):
    """Upsert ``batch`` into the table at ``base``; (manifest's path, or None in a dry run; counters).

    Only the months that the batch touches are read in full, merged and written, to new folders;
    the new version lists those beside the untouched folders of the last one. The
    write counts what it writes, and the last version knows its own sums, so the counters cost
    no second upsert. ``batch`` is read more than once: pass a stored one.
    """
    current = latest_version(spark, base)
    if built_on is not _ANY and built_on != current:
        raise StaleVersion(base)
    batch = conform(batch)
    stored = read_version(spark, base, current)
    months = touched_months(stored, batch)
    old = read_version(spark, base, current, months)
    before = old.agg(F.count(F.lit(1)).alias("rows"), F.count("brier_score").alias("scored")).first()
    merged = upsert(old, batch)
    if dry_run:
        token, written = None, {}
        rows, scored = merged.agg(F.count(F.lit(1)), F.count("brier_score")).first()
    else:
        token, written, rows, scored = _write_months(spark, merged, base, partitions)
    kept = {m: f for m, f in (current.months if current else {}).items() if m not in months}
    last = current or Version(0)
    version = Version(_next(current), kept | written, last.rows - before["rows"] + rows, last.scored - before["scored"] + scored,
                      last.batches | (batches or {}))
    path = None if dry_run else _commit_or_clean(spark, base, token, version)
    return path, {"existing_rows": last.rows, "existing_videos": stored.select("video_id").distinct().where("video_id is not null").count(),
                  "new_rows": batch.count(), "scored": version.scored, "pending": version.rows - version.scored}


def list_pending(table: DataFrame, as_of: str) -> DataFrame:
    """Unresolved predictions published on or before ``as_of``."""
    return (table.where(F.col("actual_result").isNull() & F.col("publish_date").isNotNull()
                        & (F.col("publish_date") <= F.lit(as_of).cast("date")))
            .select("prediction_id", "competition", "home_team", "away_team",
                    "match_type", "match_date", "publish_date"))


def run_counters(existing: DataFrame, new: DataFrame) -> DataFrame:
    """existing rows / distinct videos, new rows, scored and pending after the run.

    One pass over the union that the upsert ranks: which rows stay is read off
    their rank, so nothing is upserted, written or joined for the counters.
    """
    w = Window.partitionBy("prediction_id").orderBy(*_latest_first())
    ranked = union_batches(existing, new).select(
        (F.col("_is_new") == 1).alias("new"), "video_id", "brier_score", (F.row_number().over(w) == 1).alias("stays"))
    stays, is_new = F.col("stays"), F.col("new")
    return ranked.agg(
        F.count_if(~is_new).alias("existing_rows"),
        F.count_distinct(F.when(~is_new, F.col("video_id"))).alias("existing_videos"),
        F.count_if(is_new).alias("new_rows"),
        F.count_if(stays & F.col("brier_score").isNotNull()).alias("scored"),
        F.count_if(stays & F.col("brier_score").isNull()).alias("pending"))
