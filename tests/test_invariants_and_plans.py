"""Invariants on the models at sf0.01 and physical-plan checks."""

from pyspark.sql import functions as F

from conftest import SF0001, SF001
from evwin.plans import catalog
from evwin.plans.models import ModelGraph
from evwin.sources.testdata import raw_tables

import __spark_entry__ as E


def test_invariants_sf001(spark):
    g = ModelGraph(raw_tables(spark, SF001))
    n = g.listings.count()
    assert g.coverage_summary.agg(F.sum("ipo_count")).first()[0] == n
    assert g.coverage_summary_short.agg(F.sum("ipo_count")).first()[0] == n
    m = g.metrics_long
    assert m.filter("min_close > first_close or first_close > max_close or min_close > last_close "
                    "or last_close > max_close").count() == 0
    assert m.filter("not (max_gain_100d >= return_100d and return_100d >= max_drawdown_100d)").count() == 0
    k = ["event_id", "price_date"]
    assert g.window_short.select(*k).subtract(g.window_long.select(*k)).count() == 0
    assert g.window_long.groupBy(*k).count().filter("count > 1").count() == 0


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_precedence_uses_window_group_limit(spark):
    plan = _plan(catalog.QUERIES["preferred_prices"](spark, SF0001))
    assert "WindowGroupLimit" in plan


def test_no_python_udfs_in_any_query(spark):
    bad = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
    for k, fn in E.queries().items():
        plan = _plan(fn(spark, SF0001))
        assert not any(b in plan for b in bad), k


def test_scan_pruning(spark):
    # lazy derivation from the test tables: only the needed lineitem columns are read
    g = ModelGraph(raw_tables(spark, SF0001))
    plan = _plan(g.metrics_short)
    assert "l_returnflag" not in plan and "l_tax" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double," \
           "l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    # stored layout: the date bound prunes month partitions and is pushed to parquet
    plan = _plan(catalog.QUERIES["metrics_30d"](spark, SF0001))
    assert "PartitionFilters: [isnotnull(price_month" in plan and "(price_month" in plan
    assert "GreaterThanOrEqual(price_date,2001-01-01)" in plan
    assert "raw_row" not in plan


def test_window_join_is_bucketed_equi_join(spark):
    plan = _plan(catalog.QUERIES["window_prices_100d"](spark, SF0001))
    assert "_wb" in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 54 and "return_30d_pct" in df.columns


def test_mart_aggregates_are_hash_based_and_scans_bounded_on_both_sides(spark):
    for key in ("coverage_100d", "metrics_100d", "metrics_30d"):
        plan = _plan(catalog.QUERIES[key](spark, SF0001))
        assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan, key
        assert "price_month#" in plan and "(price_month#" in plan
        assert "<= date_format(" in plan.split("PartitionFilters: [isnotnull(price_month")[1].split("]")[0], key


def test_distinct_days_counts_across_words(spark):
    from evwin.functions.exprs import distinct_days
    rows = [("a", x) for x in (0, 0, 63, 64, 64, 100)] + [("b", 5), ("c", None)]
    df = spark.createDataFrame(rows, "k string, day bigint")
    got = dict(df.groupBy("k").agg(distinct_days(F.col("day"), 100)).collect())
    assert got == {"a": 4, "b": 1, "c": 0}
