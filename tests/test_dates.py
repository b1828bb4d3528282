import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchcast import dims
from pitchcast.functions.dates import gauge_level, infer_season, lenient_date, quarter_label, trend_level

RUN_DATE = "2026-03-01"


@pytest.mark.parametrize("comp,day,expected", [
    ("LaLiga", "2024-08-01", "2024-2025"),
    ("LaLiga", "2025-01-15", "2024-2025"),
    ("Mundial", "2026-06-15", "2026"),
    ("Eurocopa", "2024-07-01", "2024"),
    ("Copa América", "2024-06-20", "2024"),
    ("Eurocopa", "2021-07-01", "2020"),
    ("LaLiga", "not-a-date", "2025-2026"),   # unparsable -> run date
    ("LaLiga", "", "2025-2026"),
    ("LaLiga", "2025-3-5", "2024-2025"),     # single-digit month/day accepted
])
def test_infer_season(spark, comp, day, expected):
    df = spark.createDataFrame([(comp, day)], "c string, d string")
    got = df.select(infer_season(F.col("c"), lenient_date(F.col("d")), RUN_DATE, dims.PRODUCTION)).first()[0]
    assert got == expected


def test_lenient_date_rejects_partial_and_time(spark):
    df = spark.createDataFrame([("2025",), ("2025-03-05T10:00",), ("2025-03-05",)], "d string")
    assert [r[0] for r in df.select(lenient_date("d")).collect()] == [None, None, dt.date(2025, 3, 5)]


def test_levels(spark):
    df = spark.createDataFrame([(0.15,), (0.35,), (0.05,), (0.2222,)], "v double")
    got = df.select(gauge_level(F.col("v"), 16), trend_level(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(8, 1), (16, 7), (2, 0), (11, 4)]


def test_quarter_label(spark):
    df = spark.createDataFrame([(dt.date(2025, 11, 3),)], "d date")
    assert df.select(quarter_label("d")).first()[0] == "2025-Q4"
