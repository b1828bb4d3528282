"""The persisted prediction table: one explicit schema used for read, conform and write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import lenient_date

PREDICTION_COLUMNS = [
    "prediction_id", "video_id", "publish_date", "match_date",
    "home_team", "away_team", "competition", "match_type", "leg_number",
    "pred_home_win_pct", "pred_draw_pct", "pred_away_win_pct",
    "actual_result", "home_goals", "away_goals",
    "brier_score", "fetched_at",
]

_TYPES = {
    "prediction_id": T.StringType(), "video_id": T.StringType(),
    "publish_date": T.DateType(), "match_date": T.DateType(),
    "home_team": T.StringType(), "away_team": T.StringType(),
    "competition": T.StringType(), "match_type": T.StringType(),
    "leg_number": T.IntegerType(),
    "pred_home_win_pct": T.IntegerType(), "pred_draw_pct": T.IntegerType(),
    "pred_away_win_pct": T.IntegerType(),
    "actual_result": T.StringType(), "home_goals": T.IntegerType(), "away_goals": T.IntegerType(),
    "brier_score": T.DoubleType(), "fetched_at": T.TimestampType(),
}

PREDICTION_SCHEMA = T.StructType([T.StructField(c, _TYPES[c], True) for c in PREDICTION_COLUMNS])


def _coerce(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Cast with "bad value -> null" semantics."""
    if src == dst:
        return c
    if isinstance(dst, T.DateType) and isinstance(src, T.StringType):
        return lenient_date(c)
    if isinstance(dst, T.TimestampType) and isinstance(src, T.StringType):
        return F.try_to_timestamp(c)
    return c.try_cast(dst)


def conform(df: DataFrame) -> DataFrame:
    """Project to the 17 persisted columns: missing -> null, extra dropped, types coerced."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in PREDICTION_SCHEMA.fields:
        if f.name in have:
            cols.append(_coerce(F.col(f.name), have[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty_predictions(spark) -> DataFrame:
    return spark.createDataFrame([], PREDICTION_SCHEMA)
