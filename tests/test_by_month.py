"""Marts kept by month, pruning by the months of listings, large documents, refused
payloads, approximate medians."""

import contextlib
import datetime as dt
import glob
import io
import json
import os
import random
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from evwin.operators import ingest as I
from evwin.operators.upsert import upsert_partitioned
from evwin.plans import catalog
from evwin.plans import models as M
from evwin.plans import serving as D
from evwin.plans import window_state as WS
from evwin.sources import versioned as V
from evwin.sources.raw import PRICE_LAYOUT, with_month, write_prices
from evwin.sources.schemas import DAILY_PRICES

AS_OF = dt.date(2001, 6, 30)
OPTIONS = dict(as_of=AS_OF, recent_days=180)
_LISTING = ("event_id string, ipo_date date, ipo_symbol string, company_name string, exchange string, price_vendor string, price_symbol string, "
            "is_priceable boolean, profile_source string, industry string, sector string, country string, currency string, market_cap double, weburl string")


def _listing(i, day, symbol, priceable=True):
    return (f"e{i}", day, f"L{i}", f"Co {i}", "NYSE", "yahoo", symbol, priceable, None, "Tech", None, None, None, None, None)


def _prices(spark, rows):
    return with_month(spark.createDataFrame([(s, y, d, c, c, c, c, 1, None, dt.datetime(2001, 6, 30)) for (s, y, d), c in rows], DAILY_PRICES))


@pytest.mark.parametrize("seed", [0, 1])
def test_marts_by_month_equal_marts_after_loads_in_any_order(spark, seed):
    """Loads bring new days, corrections and the other vendor's bars, in any order; a listing is
    added and another gets a new symbol on the way."""
    rnd = random.Random(seed)
    day = lambda n: dt.date(2001, 1, 5) + dt.timedelta(rnd.randrange(n))
    base = tempfile.mkdtemp(prefix="evwin-states-")
    rows = [_listing(i, day(60), f"S{rnd.randrange(3)}", rnd.random() < 0.8) for i in range(8)]
    listings = before = spark.createDataFrame(rows, _LISTING)
    for load in range(3):
        batch = {(rnd.choice(["yahoo", "alphavantage"]), f"S{rnd.randrange(3)}", day(150)): rnd.choice([None, Decimal(rnd.randrange(1, 9))]) for _ in range(40)}
        df = _prices(spark, batch.items())
        upsert_partitioned(spark, f"{base}/p", df, ["source", "symbol", "price_date"], "price_month", PRICE_LAYOUT)
        if load == 1:
            rows[0] = _listing(0, rows[0][1], "S1")
            listings = spark.createDataFrame([*rows, _listing(9, dt.date(2001, 1, 9), "S2")], _LISTING)
        prices = V.read(spark, f"{base}/p")
        for days in (100, 30):
            months = df.select("price_month").unionByName(WS.months_of_change(before, listings, days))
            WS.refresh(spark, f"{base}/{days}", listings, prices, months, days=days, **OPTIONS)
        before = listings
        window = M.window_prices(listings, prices, days=100, **OPTIONS)
        stats = WS.long_stats(V.read(spark, f"{base}/100"))
        assert sorted(M.metrics_long(listings, None, stats=stats).collect()) == sorted(M.metrics_long(listings, window).collect())
        assert sorted(M.coverage_long(listings, None, stats=stats).collect()) == sorted(M.coverage_long(listings, window).collect())
        short = M.window_prices(listings, prices, days=30, **OPTIONS)
        stats = WS.short_stats(V.read(spark, f"{base}/30"))
        assert sorted(M.metrics_short(listings, None, stats=stats).collect(), key=str) == sorted(M.metrics_short(listings, short).collect(), key=str)


def test_a_refresh_leaves_other_months_as_they_are(spark):
    base = tempfile.mkdtemp(prefix="evwin-states-")
    listings = spark.createDataFrame([_listing(1, dt.date(2001, 1, 5), "S")], _LISTING)
    p = _prices(spark, [(("yahoo", "S", dt.date(2001, m, 7)), Decimal(m)) for m in (1, 2, 3)])
    first = WS.refresh(spark, base, listings, p, p.select("price_month"), days=100, **OPTIONS)
    p2 = _prices(spark, [(("yahoo", "S", dt.date(2001, m, 7)), Decimal(m * 10)) for m in (1, 2, 3)])
    second = WS.refresh(spark, base, listings, p2, spark.createDataFrame([("2001-02",), (None,)], "price_month string"), days=100, **OPTIONS)
    assert {m for m in first.parts if first.parts[m] == second.parts[m]} == {"2001-01", "2001-03"}
    assert [r.max_close for r in V.read(spark, base).orderBy("price_month").collect()] == [1, 20, 3]
    empty = WS.refresh(spark, base, listings, p2.limit(0), spark.createDataFrame([("2001-02",)], "price_month string"), days=100, **OPTIONS)
    assert sorted(empty.parts) == ["2001-01", "2001-03"]     # a month that holds nothing any more


def test_windows_read_only_months_that_listings_touch(spark):
    """Listings early and late, prices in between: files of the months between are never opened."""
    base = os.path.join(tempfile.mkdtemp(prefix="evwin-prune-"), "prices")
    rows = [(("yahoo", f"S{i}", dt.date(2001, m, d)), Decimal(m)) for i in range(3) for m in range(1, 7) for d in (3, 20)]
    write_prices(_prices(spark, rows).drop("price_month"), base)
    path = os.path.join(os.path.dirname(base), "listings")
    spark.createDataFrame([_listing(1, dt.date(2001, 1, 2), "S1"), _listing(2, dt.date(2001, 6, 2), "S2"), _listing(3, dt.date(2001, 4, 1), "S2", False)], _LISTING).write.parquet(path)
    prices, listings = spark.read.parquet(base), spark.read.parquet(path)
    for month in ("02", "03", "04", "05"):
        for f in glob.glob(f"{base}/price_month=2001-{month}/*.parquet"):
            with open(f, "r+b") as file:
                file.write(b"not a table")
    got = M.window_prices(listings, prices, days=28, **OPTIONS).collect()
    assert sorted((r.event_id, r.price_date.month, r.price_date.day) for r in got) == [("e1", 1, 3), ("e1", 1, 20), ("e2", 6, 3), ("e2", 6, 20)]
    with pytest.raises(Exception):
        prices.agg(F.max("close")).collect()


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_price_scans_are_pruned_by_listing_months(spark):
    for key in ("window_prices_100d", "metrics_30d", "incremental_prices"):
        assert "dynamicpruning" in _plan(catalog.QUERIES[key](spark, SF0001)), key


# ---- documents beyond the size of a parsed value -------------------------------
def test_a_calendar_beyond_a_parsed_value_gives_its_events(spark):
    n = 150_000
    events = spark.range(n).select(F.struct(
        F.lit("2001-05-01").alias("date"), F.concat(F.repeat(F.lit("A long name "), 75), "id").alias("name"), F.format_string("S%d", F.col("id") % 9999).alias("symbol"),
        F.lit("NYSE").alias("exchange"), F.lit(1.5).alias("priceRangeLow"), F.col("id").alias("numberOfShares")).alias("e"))
    doc = events.agg(F.to_json(F.collect_list("e")).alias("rows"))
    big = doc.select(F.lit(1).alias("batch_seq"), F.concat(F.lit('{"ipoCalendar": [], "data": '), "rows", F.lit("}")).alias("payload"))
    other = spark.createDataFrame([(2, '{"ipoCalendar": [{"name": "x"'), (3, None), (4, '{"ipoCalendar": [{"name": "small", "symbol": "S"}]}')], "batch_seq int, payload string")
    payloads = big.unionByName(other)
    assert payloads.filter("batch_seq = 1").select(I.parse_payload("payload").isNull()).first()[0]     # refused as a value
    got = I.calendar_parse(payloads).groupBy("batch_seq").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("pos").alias("places"), F.sum("shares").alias("shares"), F.max("price_range_low").alias("low"), F.min("date").alias("day"))
    rows = {r.batch_seq: r for r in got.collect()}
    assert set(rows) == {1, 4} and rows[4].n == 1
    assert (rows[1].n, rows[1].places, rows[1].shares, rows[1].low, rows[1].day) == (n, n, n * (n - 1) // 2, Decimal("1.5"), "2001-05-01")
    assert sorted(r.batch_seq for r in I.unreadable(payloads).collect()) == [2, 3]


def test_both_ways_of_a_document_give_the_same_rows(spark, monkeypatch):
    docs = [{"ipoCalendar": [{"date": "2001-01-02", "name": "Co", "symbol": None, "exchange": 7, "priceRangeLow": 1.25}, {}]}, {"ipoCalendar": {"a": 1}, "data": [{"name": "n"}]},
            {"ipoCalendar": [], "ipoCalendarData": None, "data": [{"name": "n"}]}, {"ipoCalendar": 0, "data": [{"symbol": "S"}]}, {"ipoCalendar": "text"}, {}, {"data": [5, "x", None, {"name": "last"}]}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "batch_seq int, payload string")
    cols = ["batch_seq", "pos", "date", "name", "symbol", "exchange", "price_range_low", "shares"]
    want = sorted(I.calendar_parse(df).select(*cols).collect(), key=str)
    parsed = I._large_rows(F.col("payload"))
    rows = df.select("batch_seq", F.posexplode(parsed).alias("pos", "r"))
    got = rows.select("batch_seq", "pos", *[I.py_str(I.vfield(F.col("r"), k)).alias(k) for k in ("date", "name", "symbol", "exchange")],
                      F.expr("try_variant_get(r, '$.priceRangeLow', 'decimal(18,6)')").alias("price_range_low"), F.expr("try_variant_get(r, '$.numberOfShares', 'bigint')").alias("shares"))
    assert sorted(got.collect(), key=str) == want


# ---- refused payloads ---------------------------------------------------------
def test_a_load_is_split_once_into_good_and_refused(spark):
    rows = [("a", '{"Time Series (Daily)": {}}'), ("b", '{"Note": "slow down"}'), ("c", '{"Information": {"k": 1}}'), ("d", "{"), ("e", None), ("f", '{"Other": 1}')]
    df = spark.createDataFrame(rows, "symbol string, payload string")
    good, refused = I.split_load(df, os.path.join(tempfile.mkdtemp(prefix="evwin-split-"), "load"))
    assert [tuple(r) for r in good.select("symbol", "payload").collect()] == [rows[0]]
    assert sorted((r.symbol, r.status, r.message) for r in refused.collect()) == [
        ("b", "rate_limited", "slow down"), ("c", "info", '{"k":1}'), ("d", "invalid", None), ("e", "invalid", None), ("f", "unexpected", None)]
    for key in ("payload_triage", "payload_quarantine"):
        assert "parse_json" not in _plan(catalog.QUERIES[key](spark, SF0001)), key


def test_profile_calls_that_fail_are_told_from_empty_ones(spark):
    df = spark.createDataFrame([("A", '{"ticker": "A"}', None), ("B", "{}", None), ("C", None, "timeout"), ("D", "{cut", None), ("E", '{"ticker": "E"}', "late error")],
                               "symbol string, payload string, error string")
    assert [r.outcome for r in I.profiles_finnhub(df).collect()] == ["upserted", "empty", "failed", "failed", "failed"]
    assert [r.outcome for r in I.profiles_yahoo(df.withColumn("payload", F.regexp_replace("payload", "ticker", "longName"))).collect()] == ["upserted", "empty", "failed", "failed", "failed"]


# ---- approximate medians --------------------------------------------------------
def test_approximate_medians_are_within_their_bound(spark):
    n, accuracy = 60_000, 100
    rows = spark.range(n).select(
        F.lit("I").alias("industry"), F.lit("S").alias("sector"), F.lit(20).cast("bigint").alias("price_days"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 100).cast("decimal(18,2)").alias("return_30d_pct"), F.col("id").cast("string").alias("event_id"), F.col("id").cast("string").alias("ipo_symbol"))
    exact, = D.sector_scan(rows.repartition(7)).collect()
    near, = D.sector_scan(rows.repartition(7), accuracy=accuracy).collect()
    assert exact.ipo_count == near.ipo_count == n and exact.avg_return_30d_pct == near.avg_return_30d_pct
    below = rows.filter(F.col("return_30d_pct") <= near.median_return_30d_pct).count()
    assert abs(below / n - 0.5) <= 1 / accuracy
    few = rows.filter("cast(event_id as int) < 90")
    assert D.sector_scan(few, accuracy=1000).collect() == D.sector_scan(few).collect()
