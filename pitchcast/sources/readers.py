"""Landed inputs: video lists, metadata, transcripts, fixtures, overrides, the table.

Every reader declares its schema (no inference) so a scan at any size is one
pass with pruning and pushdown.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import empty_predictions

VIDEO_LIST_SCHEMA = T.StructType([T.StructField("video_url", T.StringType())])

METADATA_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("snippet", T.StructType([
            T.StructField("publishedAt", T.StringType()),
            T.StructField("title", T.StringType()),
        ])),
    ]))),
])

SEGMENT_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("text", T.StringType()),
])

# Landed fixture pages as the results API returns them (scores are strings).
FIXTURE_EVENT_SCHEMA = T.StructType([
    T.StructField("fixture_seq", T.LongType()),
    T.StructField("competition", T.StringType()),
    T.StructField("season", T.StringType()),
    T.StructField("round_no", T.IntegerType()),
    T.StructField("strHomeTeam", T.StringType()),
    T.StructField("strAwayTeam", T.StringType()),
    T.StructField("dateEvent", T.StringType()),
    T.StructField("strStatus", T.StringType()),
    T.StructField("intHomeScore", T.StringType()),
    T.StructField("intAwayScore", T.StringType()),
])


# Landed result pages: one round of a competition's season, its events nested in their order.
EVENT_FIELDS = ["strHomeTeam", "strAwayTeam", "dateEvent", "strStatus", "intHomeScore", "intAwayScore"]
PAGE_SCHEMA = T.StructType([
    T.StructField("competition", T.StringType()),
    T.StructField("season", T.StringType()),
    T.StructField("round_no", T.IntegerType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("events", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in EVENT_FIELDS]))),
])


class MissingColumnError(ValueError):
    pass


def read_video_list(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a ``video_url`` header column; null URLs dropped."""
    df = spark.read.option("header", True).csv(path)
    if "video_url" not in df.columns:
        raise MissingColumnError(f"{path} missing required column 'video_url'")
    return df.select(F.col("video_url").cast("string")).na.drop(subset=["video_url"])


def single_video(spark: SparkSession, url: str) -> DataFrame:
    return spark.createDataFrame([(url,)], VIDEO_LIST_SCHEMA)


def read_predictions(spark: SparkSession, path: str | None, months=None) -> DataFrame:
    """The latest committed version of the prediction table, or an empty typed frame.

    ``months`` (``2025-03``; ``none`` for rows without a date) opens only their folders.
    """
    from ..operators.store import latest_version, read_version
    return read_version(spark, path, latest_version(spark, path), months) if path else empty_predictions(spark)


def read_overrides(spark: SparkSession, path: str) -> DataFrame | None:
    """Override CSV, raw (see operators.resolve.conform_overrides); None when unusable."""
    try:
        df = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":   # only an absent file means no overrides
            raise
        return None
    if not {"prediction_id", "home_goals", "away_goals"}.issubset(df.columns):
        return None
    # order of the lines: by file name, place of the split in the file, place in the split (within a
    # split, ids grow line by line, whatever number the split's partition has)
    return df.withColumn("line_no", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                             F.monotonically_increasing_id().alias("line")))


def read_metadata_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed metadata documents, one JSON object per line with a ``video_id`` field."""
    schema = T.StructType([T.StructField("video_id", T.StringType())] + METADATA_SCHEMA.fields)
    return spark.read.schema(schema).json(path)


def parse_metadata(df: DataFrame, json_col: str = "metadata_json") -> DataFrame:
    """``{"items": [{"snippet": {...}}]}`` text -> (video_id, publish_date, title).

    The first item wins; a document without items drops the video.
    """
    if json_col in df.columns:
        df = df.withColumn("_doc", F.from_json(F.col(json_col), METADATA_SCHEMA))
        items = F.col("_doc.items")
    else:
        items = F.col("items")
    first = F.get(items, 0)
    return (df.select("video_id", first.alias("_first"))
              .where(F.col("_first").isNotNull())
              .select("video_id",
                      F.substring(F.col("_first.snippet.publishedAt"), 1, 10).alias("publish_date"),
                      F.col("_first.snippet.title").alias("title")))


def read_result_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed result pages, one JSON object per line (see operators.pages)."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


def read_fixture_events(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed fixture events -> the fixture frame used by resolution."""
    raw = spark.read.schema(FIXTURE_EVENT_SCHEMA).format(fmt).load(path)
    return raw.select(
        "fixture_seq", "competition", "season", "round_no",
        F.col("strHomeTeam").alias("home_team"), F.col("strAwayTeam").alias("away_team"),
        F.col("intHomeScore").alias("home_score"), F.col("intAwayScore").alias("away_score"),
        F.to_date(F.try_to_timestamp(F.col("dateEvent"), F.lit("yyyy-M-d"))).alias("event_date"),
        F.col("strStatus").alias("status"))
