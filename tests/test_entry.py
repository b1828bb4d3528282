import duckdb

import __spark_entry__ as E
import oracles as O
from pitchcast.sources.testviews import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_predictions"] > 0


def test_every_query_has_an_oracle():
    # of the library: the training-data queries and their SQL are the subject of tests/llm
    assert set(E._QUERIES) == set(O.all_oracles())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_selected_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name in ["summary_stats", "quarterly_trend", "brier_histogram", "build_prediction_rows", "round_cutoff"]:
        sdf = E.queries()[name](spark, SF)
        cols = sorted(sdf.columns)
        got = sorted((tuple(r[c] for c in cols) for r in sdf.collect()), key=repr)
        rel = con.execute(E.oracle_sql()[name])
        names = [d[0] for d in rel.description]
        exp = sorted((tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()), key=repr)
        assert got == exp, name


def _odd_tables(spark, path):
    """Orders of all months, of a customer of one nation, with a null date."""
    spark.createDataFrame([(n, f"NATION_{n}") for n in range(25)], "n_nationkey int, n_name string").write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(1, 3, "MACHINERY")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{path}/customer.parquet")
    (spark.range(1, 49).selectExpr("id as o_orderkey", "1L as o_custkey", "case when id % 2 = 0 then 'F' else 'O' end as o_orderstatus",
                                   "case when id <> 9 then add_months(date'1995-01-05', cast(id as int)) end as o_orderdate")
     .write.parquet(f"{path}/orders.parquet"))
    return path


def test_run_counters_take_the_batch_of_every_month(spark, tmp_path):
    sf = _odd_tables(spark, str(tmp_path))
    stored = E.stored_table(spark, sf).count()
    again = E.stored_table(spark, sf).where("cast(substring(prediction_id, 13, 8) as int) % 2 = 1").count()
    row = E.queries()["run_counters"](spark, sf).first()
    assert (row["existing_rows"], row["new_rows"]) == (stored, stored + again) and stored > 40
    con = duckdb.connect()
    for t in ("orders", "customer", "nation"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet/*.parquet')")
    assert tuple(row) == con.execute(O.all_oracles()["run_counters"]).fetchone()


def test_the_batch_is_generated_as_its_sql_joins_it(spark, tmp_path):
    from pitchcast.sources import testviews as tv
    sf = _odd_tables(spark, str(tmp_path))
    for template, made in ((tv.NEW_BATCH, tv.new_batch), (tv.WHOLE_BATCH, tv.whole_batch)):
        joined, rows = tv.view(spark, sf, template, v_predictions=tv.predictions(spark, sf)), made(spark, sf)
        assert rows.columns == joined.columns and sorted(rows.collect(), key=repr) == sorted(joined.collect(), key=repr)
