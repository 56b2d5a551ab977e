"""Literal-row edge cases of the model layer (FIXTURES.md §3, SURVEY §7.3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from evwin.operators.ingest import event_id_expr
from evwin.operators import worklist as W
from evwin.plans import models as M
from evwin.sources import schemas as S

AS_OF = dt.date(2001, 6, 30)
TS = dt.datetime(2001, 6, 1)


def events(spark, rows):
    """rows: (symbol, ipo_date, exchange)"""
    data = []
    for i, (sym, d, ex) in enumerate(rows):
        data.append((f"e{i}", "finnhub", d, sym, f"Co {i}", ex, None, None, None, None, TS))
    return spark.createDataFrame(data, S.IPO_EVENTS)


def smap(spark, rows):
    """rows: (vendor, ipo_symbol, vendor_symbol, is_priceable, last_checked_at)"""
    return spark.createDataFrame([(v, s, vs, p, None, t) for v, s, vs, p, t in rows], S.SYMBOL_MAP)


def profiles(spark, rows):
    """rows: (source, symbol, industry, sector)"""
    return spark.createDataFrame([(src, s, None, None, None, None, None, None, ind, sec, None, None, None, TS)
                                  for src, s, ind, sec in rows], S.COMPANY_PROFILES)


def prices(spark, rows):
    """rows: (source, symbol, date, close)"""
    return spark.createDataFrame([(src, s, d, c, c, c, c, 1, None, TS) for src, s, d, c in rows], S.DAILY_PRICES)


def d(n):
    return AS_OF - dt.timedelta(days=n)


SHAPES = ["ABC", "abc", "ABU", "W", "A1", "ABCDEF", "", None, "ABC\n"]


def test_symbol_shapes(spark):
    ev = events(spark, [(s, d(10), "NASDAQ") for s in SHAPES])
    lst = M.listings_recent(ev, smap(spark, []), profiles(spark, []), as_of=AS_OF)
    assert sorted(r.ipo_symbol for r in lst.collect()) == ["ABC", "ABC"]       # ABC and abc
    w01 = W.recent_equity_symbols(ev, as_of=AS_OF)
    assert sorted(r.symbol for r in w01.collect()) == ["A1", "ABC"]
    valid = M.listings_valid(ev)
    assert sorted(r.symbol for r in valid.collect()) == ["ABC", "ABU", "W"]


def test_listing_filters_exchange_and_date(spark):
    ev = events(spark, [("AAA", d(10), None), ("BBB", d(10), "nyse american"), ("CCC", d(181), "NYSE"),
                        ("DDD", d(180), "NYSE"), ("EEE", AS_OF + dt.timedelta(days=9), "NASDAQ"),
                        ("FFF", d(5), "OTC")])
    lst = M.listings_recent(ev, smap(spark, []), profiles(spark, []), as_of=AS_OF)
    # NULL exchange dropped, lower-case exchange kept, no upper date bound
    assert sorted(r.ipo_symbol for r in lst.collect()) == ["BBB", "DDD", "EEE"]


def test_mapping_precedence(spark):
    m = smap(spark, [("alphavantage", "AAA", "A1", False, TS), ("yahoo", "AAA", "Y1", True, TS),
                     ("alphavantage", "BBB", "A2", True, TS), ("yahoo", "BBB", "Y2", True, TS),
                     ("yahoo", "CCC", "Y3", False, dt.datetime(2001, 1, 1)), ("other", "CCC", "O3", True, TS),
                     ("yahoo", "DDD", "Y4", False, None)])
    got = {r.ipo_symbol: r.vendor_symbol for r in M.preferred_symbol_map(m).collect()}
    assert got == {"AAA": "Y1", "BBB": "A2", "CCC": "Y3", "DDD": "Y4"}


def test_profile_precedence_and_case(spark):
    p = profiles(spark, [("yahoo", "AAA", "Tech", None), ("finnhub", "AAA", None, "S"),
                         ("finnhub", "BBB", "Fin", None), ("yahoo", "BBB", "Tech", None),
                         ("yahoo", "ccc", "Lower", None)])
    got = {r.symbol: r.source for r in M.preferred_profile(p).collect()}
    assert got == {"AAA": "yahoo", "BBB": "finnhub", "ccc": "yahoo"}
    ev = events(spark, [("ccc", d(3), "NASDAQ")])
    lst = M.listings_recent(ev, smap(spark, []), p, as_of=AS_OF).collect()
    assert lst[0].ipo_symbol == "CCC" and lst[0].industry is None    # joined on raw symbol
    assert lst[0].is_priceable is False


def _graph_rows(spark, ipo_date, price_rows, mapping=True):
    ev = events(spark, [("AAA", ipo_date, "NASDAQ")])
    m = smap(spark, [("yahoo", "AAA", "PX", True, TS)] if mapping else [])
    return ev, m, prices(spark, price_rows)


def test_window_edges(spark):
    ipo = d(150)
    rows = [("yahoo", "PX", ipo + dt.timedelta(days=k), Decimal(10 + k)) for k in (-1, 0, 30, 31, 100, 101)]
    ev, m, px = _graph_rows(spark, ipo, rows)
    lst = M.listings_recent(ev, m, profiles(spark, []), as_of=AS_OF)
    w100 = M.window_prices(lst, px, as_of=AS_OF, bucket_days=7)
    assert sorted(r.day_num for r in w100.collect()) == [0, 30, 31, 100]
    assert sorted(r.day_num for r in M.cut_window(w100, 30).collect()) == [0, 30]


def test_daily_precedence_mixes_vendors(spark):
    ipo = d(150)
    rows = [("yahoo", "PX", ipo, Decimal(1)), ("alphavantage", "PX", ipo, Decimal(2)),
            ("yahoo", "PX", ipo + dt.timedelta(days=1), Decimal(3)), ("zeta", "PX", ipo + dt.timedelta(days=2), Decimal(4)),
            ("beta", "PX", ipo + dt.timedelta(days=2), Decimal(5))]
    ev, m, px = _graph_rows(spark, ipo, rows)
    lst = M.listings_recent(ev, m, profiles(spark, []), as_of=AS_OF)
    got = sorted((r.day_num, r.price_source) for r in M.window_prices(lst, px, as_of=AS_OF).collect())
    assert got == [(0, "alphavantage"), (1, "yahoo"), (2, "beta")]


def _metrics(spark, closes, ipo=None):
    ipo = ipo or d(150)
    rows = [("yahoo", "PX", ipo + dt.timedelta(days=i), c) for i, c in enumerate(closes)]
    ev, m, px = _graph_rows(spark, ipo, rows)
    lst = M.listings_recent(ev, m, profiles(spark, []), as_of=AS_OF)
    w = M.window_prices(lst, px, as_of=AS_OF)
    return M.metrics_short(lst, M.cut_window(w, 30)).collect()[0], M.metrics_long(lst, w).collect()[0]


def test_first_last_rules(spark):
    m30, m100 = _metrics(spark, [None, Decimal(10), Decimal(12)])
    assert m30.return_30d_pct is None and m30.first_close_30d is None
    assert m100.first_close == Decimal(10) and abs(m100.return_100d - 0.2) < 1e-12 and m100.n_days == 2
    m30, m100 = _metrics(spark, [Decimal(0), Decimal(10)])
    assert m30.return_30d_pct is None and m100.return_100d is None
    m30, m100 = _metrics(spark, [Decimal(7)])
    assert m30.return_30d_pct == Decimal("0.00") and m100.return_100d == 0.0 and m100.max_gain_100d == 0.0


def test_return_rounding_ties(spark):
    # (477/480 - 1) * 100 = -0.625 exactly -> -0.63 (half away from zero)
    m30, _ = _metrics(spark, [Decimal(480), Decimal(477)])
    assert m30.return_30d_pct == Decimal("-0.63")


def test_all_null_closes_give_null_n_days(spark):
    _, m100 = _metrics(spark, [None, None])
    assert m100.n_days is None and m100.coverage_status == "very_low_coverage"


def test_short_class_limits(spark):
    days = spark.createDataFrame([(n,) for n in (0, 1, 6, 7, 14, 15)], "d bigint")
    from evwin.functions.exprs import coverage_class_short, coverage_class_long
    got = [r[0] for r in days.orderBy("d").select(coverage_class_short(F.col("d"))).collect()]
    assert got == ["no_prices", "very_low_coverage", "very_low_coverage", "partial_coverage",
                   "partial_coverage", "good_coverage"]
    days = spark.createDataFrame([(n,) for n in (0, 19, 20, 59, 60)], "d bigint")
    got = [r[0] for r in days.orderBy("d").select(
        coverage_class_long(F.lit(True), F.lit("X"), F.col("d"))).collect()]
    assert got == ["mapped_but_no_prices", "very_low_coverage", "partial_coverage", "partial_coverage",
                   "good_coverage"]


def test_unmapped_and_not_priceable_order(spark):
    from evwin.functions.exprs import coverage_class_long
    df = spark.createDataFrame([(True, None, 0), (False, None, 0), (False, "X", 70)],
                               "p boolean, s string, d bigint")
    got = [r[0] for r in df.select(coverage_class_long(F.col("p"), F.col("s"), F.col("d"))).collect()]
    assert got == ["unmapped", "not_priceable", "not_priceable"]


def test_labels(spark):
    lst = spark.createDataFrame([(None, None), ("", ""), (" ", " "), (" Tech ", "x")], "industry string, sector string")
    got = sorted(r.industry for r in M.dim_industry(lst).collect())
    assert got == ["Not available", "Tech"]
    m = spark.createDataFrame([(None, 20, Decimal("1.00")), ("", 20, Decimal("2.00")), (" Tech ", 20, Decimal("3.00"))],
                              "industry string, price_days bigint, return_30d_pct decimal(10,2)")
    got = sorted(r.industry for r in M.benchmarks_short(m).collect())
    assert got == ["", " Tech ", "Unknown"]


def test_event_id_matches_python_md5(spark):
    import hashlib
    df = spark.createDataFrame([("2001-01-02", "Co", "AB"), (None, None, None)], "d string, n string, s string")
    got = [r[0] for r in df.select(event_id_expr(F.lit("finnhub"), "d", "n", "s")).collect()]

    def py(dv, n, s):
        return hashlib.md5(f"finnhub|{dv}|{n or ''}|{s or ''}".encode()).hexdigest()
    assert got == [py("2001-01-02", "Co", "AB"), py(None, None, None)]
