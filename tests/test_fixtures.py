"""Derived raw tables and the minimum slice against the counts in FIXTURES.md."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from conftest import SF0001, SF001
from evwin.plans import catalog
from evwin.plans.models import ModelGraph
from evwin.sources.raw import store_root
from evwin.sources.schemas import KEYS, PRICE_LAYOUT
from evwin.sources.testdata import daily_prices, raw_tables, supplier_prices


def _counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_raw_table_sizes_sf0001(spark):
    r = raw_tables(spark, SF0001)
    assert r.ipo_events.count() == 200
    assert r.symbol_map.count() == 281
    assert r.company_profiles.count() == 233
    assert r.daily_prices.count() == 11328
    assert r.daily_prices.filter("close is null").count() == 444


def test_raw_keys_unique(spark):
    r = raw_tables(spark, SF0001)
    for name, df in (("ipo_events", r.ipo_events), ("daily_prices", r.daily_prices),
                     ("symbol_map", r.symbol_map), ("company_profiles", r.company_profiles)):
        keys = KEYS[name]
        assert df.groupBy(*keys).count().filter("count > 1").count() == 0, name


def test_minimum_slice_sf0001(spark):
    g = ModelGraph(raw_tables(spark, SF0001))
    assert g.listings.count() == 54
    assert g.listings.filter(F.col("price_symbol").isNull()).count() == 3
    assert _counts(g.metrics_short, "coverage_status_30d") == {
        "partial_coverage": 17, "very_low_coverage": 18, "no_prices": 19}
    assert _counts(g.coverage, "coverage_status") == {
        "partial_coverage": 27, "very_low_coverage": 8, "mapped_but_no_prices": 13, "not_priceable": 6}


def test_class_counts_sf001(spark):
    g = ModelGraph(raw_tables(spark, SF001))
    assert g.listings.count() == 554
    assert _counts(g.metrics_short, "coverage_status_30d") == {
        "good_coverage": 111, "partial_coverage": 198, "very_low_coverage": 156, "no_prices": 89}
    assert _counts(g.coverage, "coverage_status") == {
        "good_coverage": 81, "partial_coverage": 265, "very_low_coverage": 119,
        "mapped_but_no_prices": 29, "not_priceable": 60}


def test_supplier_lines_are_shuffled_once(spark):
    day = dt.datetime(2001, 5, 2)
    line = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    lineitem = spark.createDataFrame([
        (2, 1, 1, 2.0, 20.0, day), (1, 1, 1, 1.0, 7.0, day), (1, 1, 1, 1.0, 5.0, day), (9, 1, 3, 5.0, 15.0, day), (9, 1, 2, 1.0, 4.0, day),
        (3, 5, None, 4.0, 40.0, None), (4, None, 1, 1.0, 1.0, day), (5, 8, 1, 3.0, 33.0, day)], line)
    supplier = spark.createDataFrame([(1, 7), (1, 7), (1, 3), (5, None), (None, 7)], "s_suppkey long, s_nationkey long")
    stored = supplier_prices(lineitem, supplier).sortWithinPartitions(*PRICE_LAYOUT)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    line_side = [x for x in plan.splitlines() if "Exchange" in x and "s_suppkey" not in x and "Broadcast" not in x]
    assert len(line_side) == 1 and "rangepartitioning" in line_side[0], plan
    got = {(r.source, r.symbol, r.price_date): tuple(map(float, (r.open, r.high, r.low, r.close))) + (r.volume,) for r in daily_prices(lineitem, supplier).collect()}
    may, none = dt.date(2001, 5, 2), ("yahoo", "S5", None)
    assert got == {
        ("yahoo", "S1", may): (5.0, 10.0, 3.0, 3.0, 27), ("alphavantage", "S1", may): (4.0, 4.0, 4.0, 4.0, 3),
        none: (10.0, 10.0, 10.0, 10.0, 4), ("yahoo", "S8", may): (11.0, 11.0, 11.0, 11.0, 3),
        ("yahoo", "N7", may): (5.0, 10.0, 3.0, 3.0, 18), ("alphavantage", "N7", may): (4.0, 4.0, 4.0, 4.0, 2),
        ("yahoo", "N3", may): (5.0, 10.0, 3.0, 3.0, 9), ("alphavantage", "N3", may): (4.0, 4.0, 4.0, 4.0, 1)}
    assert {r.price_month for r in stored.collect()} == {"2001-05", None}


def test_a_query_builds_only_what_it_reads(spark, tmp_path):
    for name in ("part", "supplier", "lineitem"):
        shutil.copy(f"{SF0001}/{name}.parquet", tmp_path)
    root = store_root(spark, str(tmp_path)).removeprefix("file://")
    catalog.QUERIES["unresolved_symbols"](spark, str(tmp_path)).collect()
    assert sorted(os.listdir(root)) == ["ipo_events", "symbol_map"]
    catalog.QUERIES["profiles_finnhub"](spark, str(tmp_path)).collect()
    held = sorted(n.split("-")[0] if n.startswith("landing") else n for n in os.listdir(root))
    assert held == ["company_profiles", "ipo_events", "landing", "symbol_map"]   # its own feed, no prices
