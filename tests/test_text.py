import pytest
from pyspark.sql import functions as F

from pitchcast import dims
from pitchcast.functions.text import canonical_name, normalise_name, parse_video_id, strip_fence


def one(spark, col_fn, value, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col_fn(F.col("s")).alias("r")).first()["r"]


@pytest.mark.parametrize("url,expected", [
    ("https://www.youtube.com/watch?v=dQw4w9WgXcQ", "dQw4w9WgXcQ"),
    ("https://youtu.be/dQw4w9WgXcQ", "dQw4w9WgXcQ"),
    ("https://www.youtube.com/watch?v=dQw4w9WgXcQ&t=42s", "dQw4w9WgXcQ"),
    ("https://vimeo.com/12345", None),
    ("", None),
    (None, None),
])
def test_parse_video_id(spark, url, expected):
    assert one(spark, parse_video_id, url) == expected


@pytest.mark.parametrize("raw,expected", [
    ("Real Madrid", "madrid"),
    ("Atlético", "atletico"),
    ("Real Sociedad", "sociedad"),
    ("Atlético Madrid", "madrid"),
    ("FC Barcelona", "barcelona"),
    ("Club Brugge", "brugge"),
    ("Recreativo de Huelva", "recreativo huelva"),
    ("Marsella", "marseille"),
    ("Nápoles", "napoli"),
    ("Eintracht Francfort", "eintracht frankfurt"),
    ("Paris Saint-Germain", "paris saintgermain"),
    ("Real   Madrid", "madrid"),
    ("  Costa de Marfil ", "ivory coast"),
    ("República Democrática del Congo", "dr congo"),
])
def test_normalise(spark, raw, expected):
    assert one(spark, lambda c: normalise_name(c, dims.PRODUCTION), raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("Union San Giluas", "union saintgilloise"),
    ("Union SaintGilloise", "union saintgilloise"),
    ("Sporting Portugal", "sporting cp"),
    ("Sporting CP", "sporting cp"),
    ("Barcelona", "barcelona"),
])
def test_canonical_alias(spark, raw, expected):
    assert one(spark, lambda c: canonical_name(c, dims.PRODUCTION), raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ('[{"a": 1}]', '[{"a": 1}]'),
    ('```json\n[{"a": 1}]\n```', '[{"a": 1}]'),
    ('```\n[]\n```', '[]'),
    ('  [1]  ', '[1]'),
])
def test_strip_fence(spark, raw, expected):
    assert one(spark, strip_fence, raw) == expected
