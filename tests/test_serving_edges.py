"""Serving-layer edge cases (dashboard semantics)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from evwin.plans import serving as D

COLS = ("event_id string, ipo_date date, ipo_symbol string, price_symbol string, industry string, sector string, "
        "price_days bigint, first_price_date date, last_price_date date, first_close_30d decimal(18,6), "
        "last_close_30d decimal(18,6), avg_close_30d double, min_close_30d decimal(18,6), max_close_30d decimal(18,6), "
        "return_30d_pct decimal(38,2), coverage_status_30d string")


def metrics(spark, rows):
    """rows: (symbol, industry, days, return, first, min, max)"""
    out = []
    for i, (s, ind, days, ret, first, mn, mx) in enumerate(rows):
        f = None if first is None else Decimal(first)
        out.append((f"e{i}", dt.date(2001, 5, i + 1), s, "P", ind, None, days, None, None, f, f, None,
                    None if mn is None else Decimal(mn), None if mx is None else Decimal(mx),
                    None if ret is None else Decimal(ret), "x"))
    return spark.createDataFrame(out, COLS)


def test_return_filter_keeps_nulls_and_bounds(spark):
    m = D.metrics_enriched(metrics(spark, [("A", "I", 20, None, 1, 1, 1), ("B", "I", 20, "-100", 1, 1, 1),
                                           ("C", "I", 20, "300", 1, 1, 1), ("D", "I", 20, "300.01", 1, 1, 1)]))
    got = sorted(r.ipo_symbol for r in D.metrics_filtered(m, min_return=-100, max_return=300).collect())
    assert got == ["A", "B", "C"]
    assert D.metrics_filtered(m).count() == 4  # no bound unless one is asked for


def test_enrichment(spark):
    m = D.metrics_enriched(metrics(spark, [("A", None, None, None, None, None, None),
                                           ("B", "I", 7, "1.5", "0", "1", "2"), ("C", "I", 3, "1", "10", "9", "12")]))
    got = {r.ipo_symbol: r for r in m.collect()}
    assert got["A"].industry == "Unknown" and got["A"].sector == "Unknown" and got["A"].price_days == 0
    assert got["A"].coverage_band == "no_prices" and got["A"].price_range_pct_30d is None
    assert got["B"].price_range_pct_30d is None and got["B"].coverage_band == "partial_coverage"
    assert abs(got["C"].price_range_pct_30d - 30.0) < 1e-9


def test_verdicts(spark):
    m = D.metrics_enriched(metrics(spark, [("A", "I", 15, "0", 1, 1, 1), ("B", "I", 20, "2.5", 1, 1, 1),
                                           ("C", "I", 16, None, 1, 1, 1), ("D", "I", 1, None, 1, 1, 1),
                                           ("E", "I", 0, None, None, None, None)]))
    got = {r.ipo_symbol: (r.verdict, r.message) for r in D.listing_verdict(m).collect()}
    assert got["A"][0] == "negative" and "negative 30-day return of 0.00%" in got["A"][1]
    assert got["B"][0] == "positive" and "return of 2.50%." in got["B"][1]
    assert got["C"][0] == "partial" and "(16 trading days)" in got["C"][1]
    assert got["D"][0] == "minimal" and got["E"][0] == "none"


def test_kpis_and_summary_texts(spark):
    m = D.metrics_filtered(D.metrics_enriched(metrics(spark, [
        ("A", "I", 20, "10", 1, 1, 1), ("B", "J", 16, "-3.25", 1, 1, 1), ("C", "I", 8, None, 1, 1, 1),
        ("D", "I", 0, None, None, None, None)])))
    k = D.kpis(m).collect()[0]
    assert (k.ipos, k.with_any_prices, k.good_coverage) == (4, 3, 2)
    assert k.avg_price_days_text == "11.00" and k.avg_return_text == "3.38%"     # 3.375 -> 3.38
    s = D.executive_summary(m).collect()[0]
    assert s.summary.startswith("Out of 4 IPOs in the filtered dataset, 3 (75.0%) have at least one")
    assert "2 IPOs (50.0%) have strong coverage" in s.summary and s.summary.endswith("return is 3.38%.")
    empty = D.executive_summary(m.filter(F.lit(False))).collect()[0]
    assert empty.summary == "No IPOs match the current filters."
    bw = D.best_worst_industry(m).collect()[0]
    assert (bw.top_industry, bw.bottom_industry) == ("I", "J")
    none = D.best_worst_industry(m.filter("price_days < 15")).collect()[0]
    assert none.top_industry is None and none.message.startswith("No industry-level performance insight")


def test_median_even_group(spark):
    m = D.metrics_enriched(metrics(spark, [("A", "I", 20, "1.01", 1, 1, 1), ("B", "I", 20, "2.00", 1, 1, 1),
                                           ("C", "I", 20, "4.00", 1, 1, 1), ("D", "I", 20, "10.00", 1, 1, 1)]))
    r = D.sector_scan(m).collect()[0]
    assert r.median_return_30d_pct == 3.0 and r.ipo_count == 4


def test_listing_detail_picks_newest(spark):
    m = D.metrics_enriched(metrics(spark, [("A", "I", 20, "1", 1, 1, 1), ("A", "J", 20, "2", 1, 1, 1)]))
    rows = D.listing_detail(m).collect()
    assert len(rows) == 14
    assert {r.field: r.value for r in rows}["Industry"] == "J"     # newer ipo_date


def test_filters_by_industry_sector_band(spark):
    m = D.metrics_enriched(metrics(spark, [("A", "I", 20, "1", 1, 1, 1), ("B", "J", 20, "2", 1, 1, 1),
                                           ("C", "I", 8, "3", 1, 1, 1), ("D", None, 0, None, None, None, None)]))
    assert sorted(r.ipo_symbol for r in D.metrics_filtered(m, industry="I").collect()) == ["A", "C"]
    assert [r.ipo_symbol for r in D.metrics_filtered(m, industry="I", band="good_coverage").collect()] == ["A"]
    assert [r.ipo_symbol for r in D.metrics_filtered(m, sector="Unknown", industry="Unknown").collect()] == ["D"]
    assert sorted(r.ipo_symbol for r in D.metrics_filtered(m, min_return=1.5, max_return=2.5).collect()) == ["B", "D"]
    doms = [(r.domain, r.value) for r in D.filter_domains(m).collect()]
    assert doms[0] == ("industry", "All") and ("industry", "Unknown") in doms and ("sector", "All") in doms
