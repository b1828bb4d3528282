import pytest
from pyspark.sql import functions as F

from pitchcast.functions.scoring import (
    brier_2way, brier_3way, brier_score, classify_match_type, result_code, top_pick_hit)


def row(spark, **kw):
    cols = list(kw)
    return spark.createDataFrame([tuple(kw.values())], ", ".join(
        f"{c} {'string' if isinstance(v, str) or v is None else 'int'}" for c, v in kw.items()))


def test_result_codes(spark):
    df = spark.createDataFrame([(2, 0), (0, 1), (1, 1), (5, 3), (None, 1)], "h int, a int")
    got = [r[0] for r in df.select(result_code("h", "a")).collect()]
    assert got == ["H", "A", "D", "H", None]


@pytest.mark.parametrize("h,d,a,actual,expected", [
    (100, 0, 0, "H", 0.0),
    (100, 0, 0, "A", round(2.0 / 3.0, 4)),
    (60, 20, 20, "D", round((0.36 + 0.64 + 0.04) / 3.0, 4)),
])
def test_brier_3way(spark, h, d, a, actual, expected):
    df = spark.createDataFrame([(h, d, a, actual)], "h int, d int, a int, r string")
    assert df.select(brier_3way("h", "d", "a", "r")).first()[0] == expected


def test_brier_3way_near_uniform(spark):
    # 1/3 each is not expressible in integer percent; 33/34/33 is the nearest
    df = spark.createDataFrame([(33, 34, 33, "H")], "h int, d int, a int, r string")
    assert df.select(brier_3way("h", "d", "a", "r")).first()[0] == round((0.67 ** 2 + 0.34 ** 2 + 0.33 ** 2) / 3, 4)


@pytest.mark.parametrize("h,a,actual,expected", [
    (80, 20, "H", 0.04),
    (60, 40, "H", 0.16),
    (30, 20, "H", 0.16),
    (0, 0, "H", 0.0),
    (50, 50, "D", 0.25),
])
def test_brier_2way(spark, h, a, actual, expected):
    df = spark.createDataFrame([(h, a, actual)], "h int, a int, r string")
    assert df.select(brier_2way("h", "a", "r")).first()[0] == expected


def test_classify(spark):
    df = spark.createDataFrame([(0,), (25,), (None,)], "d int")
    assert [r[0] for r in df.select(classify_match_type("d")).collect()] == ["knockout", "single", None]


def test_dispatch(spark):
    df = spark.createDataFrame([
        (100, 0, 0, "single", "H"),     # 3-way perfect
        (80, 0, 20, "knockout", "H"),   # 2-way
        (50, 25, 25, "single", None),   # pending
        (50, 25, 25, None, "X"),        # unknown result code
        (50, 25, 25, None, "H"),        # no match type -> 3-way
    ], "h int, d int, a int, mt string, r string")
    got = [r[0] for r in df.select(brier_score("h", "d", "a", "mt", "r")).collect()]
    assert got == [0.0, 0.04, None, None, round(((0.5 - 1) ** 2 + 0.25 ** 2 + 0.25 ** 2) / 3, 4)]


def test_top_pick_ties_count(spark):
    df = spark.createDataFrame([(40, 40, 20, "H"), (40, 40, 20, "D"), (40, 40, 20, "A"), (20, 30, 50, "A")],
                               "h int, d int, a int, r string")
    assert [r[0] for r in df.select(top_pick_hit("h", "d", "a", "r")).collect()] == [1, 1, 0, 1]


def _py_brier(h, d, a, mt, r):
    if r not in ("H", "D", "A"):
        return None
    ph, pd_, pa = h / 100.0, d / 100.0, a / 100.0
    ih, id_, ia = (1.0 if r == c else 0.0 for c in "HDA")
    if mt == "knockout":
        tot = ph + pa
        if tot <= 0:
            return 0.0
        return round(((ph / tot - ih) ** 2 + (pa / tot - ia) ** 2) / 2.0, 4)
    return round(((ph - ih) ** 2 + (pd_ - id_) ** 2 + (pa - ia) ** 2) / 3.0, 4)


def test_brier_grid_matches_formula(spark):
    rows = [(h, d, 100 - h - d, mt, r) for h in range(0, 101, 5) for d in range(0, 101 - h, 5)
            for mt in ("single", "knockout") for r in ("H", "D", "A")]
    df = spark.createDataFrame(rows, "h int, d int, a int, mt string, r string")
    got = df.select("h", "d", "a", "mt", "r", brier_score("h", "d", "a", "mt", "r").alias("b")).collect()
    bad = [tuple(x) for x in got if x["b"] != _py_brier(x["h"], x["d"], x["a"], x["mt"], x["r"])]
    assert not bad and len(got) == len(rows)
