"""Plan shape: no nested-loop or cartesian joins, no Python UDFs, pushed scans."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E._QUERIES))   # the training-data queries may use Python: tests/llm
def test_no_nested_loops_or_python(spark, name):
    text = plan_text(E.queries()[name](spark, SF))
    assert not [f for f in FORBIDDEN if f in text], name


def test_scored_filter_and_columns_reach_the_scan(spark, tmp_path):
    from pitchcast.operators import report as R
    from pitchcast.operators import store as S
    base = str(tmp_path / "t")
    S.write_version(spark, E.stored_table(spark, SF), base)
    from pitchcast.sources.readers import read_predictions
    t = read_predictions(spark, base)
    text = plan_text(R.monthly_trend(t))
    assert "PushedFilters: [IsNotNull(brier_score)]" in text
    assert "ReadSchema: struct<publish_date:date,brier_score:double>" in text


def test_two_leg_uses_group_limit(spark):
    text = plan_text(E.queries()["resolve_two_leg"](spark, SF))
    assert "WindowGroupLimit" in text


def test_first_pick_is_a_hash_aggregate(spark):
    for name in ("resolve_single_leg", "resolve_two_leg", "resolve_results"):
        text = plan_text(E.queries()[name](spark, SF))
        assert "SortAggregate" not in text and "HashAggregate" in text, name
