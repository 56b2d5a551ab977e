"""Ingest, conform, upsert and worklist edge cases."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from evwin.operators import ingest as I
from evwin.operators import worklist as W
from evwin.operators.upsert import last_wins, upsert, upsert_partitioned, upsert_within
from evwin.sources import versioned as V

AS_OF = dt.date(2001, 6, 30)


def test_calendar_envelopes(spark):
    df = spark.createDataFrame([
        (1, '{"ipoCalendar": [], "ipoCalendarData": [{"date": "2001-01-02", "name": "A"}]}'),
        (2, '{"ipoCalendar": {"x": 1}, "ipoCalendarData": [{"date": "2001-01-03", "name": "B"}]}'),
        (3, '{"ipoCalendar": null, "data": [{"date": "2001-01-04", "name": "C"}]}'),
        (4, '{"ipoCalendar": "", "data": "not a list"}'),
        (5, 'not json')], "batch_seq int, payload string")
    got = sorted(r.name for r in I.calendar_parse(df).collect())
    assert got == ["A", "C"]


def test_event_dedupe_last_wins(spark):
    df = spark.createDataFrame([
        (1, '{"ipoCalendar": [{"date": "2001-01-02", "name": "A", "exchange": "X1"}, '
            '{"date": "2001-01-02", "name": "A", "exchange": "X2"}]}'),
        (2, '{"ipoCalendar": [{"date": "2001-01-02", "name": "A", "exchange": "X3"}, '
            '{"date": "2001-01-05", "name": "B"}]}')], "batch_seq int, payload string")
    got = {r.company_name: r.exchange for r in I.event_key_dedupe(I.calendar_parse(df)).collect()}
    assert got == {"A": "X3", "B": None}


def test_series_flatten_and_triage(spark):
    pl = ('{"Time Series (Daily)": {"2001-01-02": {"1. open": "1.5", "2. high": "", "4. close": "2", '
          '"5. volume": "10.9"}, "2001-02-02": {"1. open": "9"}}}')
    df = spark.createDataFrame([("S", pl, dt.date(2001, 1, 1), dt.date(2001, 1, 31))],
                               "symbol string, payload string, date_from date, date_to date")
    r = I.daily_series_flatten(df).collect()
    assert len(r) == 1 and r[0].high is None and r[0].low is None and r[0].volume == 10 and str(r[0].open) == "1.500000"
    t = spark.createDataFrame([(p,) for p in ['{"Note": "x", "Error Message": "y"}', '{"Error Message": "y"}',
                                             '{"Information": "i"}', '{"Meta": 1}', pl, '[1]']], "payload string")
    assert [r.status for r in I.payload_triage(t).collect()] == [
        "rate_limited", "error", "info", "unexpected", "ok", "invalid"]


def test_bars_normalise(spark):
    nan = float("nan")
    df = spark.createDataFrame([("S", dt.date(2001, 1, 2), nan, nan, nan, nan, 5.0),
                                ("S", dt.date(2001, 1, 3), 1.0, nan, None, 2.0, nan),
                                ("S", dt.date(2001, 3, 3), 1.0, 1.0, 1.0, 1.0, 1.0)],
                               "symbol string, Date date, ` Open` double, HIGH double, low double, `Close ` double, volume double")
    df = df.withColumn("date_from", F.lit(dt.date(2001, 1, 1))).withColumn("date_to", F.lit(dt.date(2001, 1, 31)))
    r = I.bars_normalise(df, date_col="Date").collect()
    assert len(r) == 1 and r[0].high is None and r[0].volume is None and float(r[0].close) == 2.0
    no_prices = df.select("symbol", "Date", "volume", "date_from", "date_to")
    assert I.bars_normalise(no_prices, date_col="Date").count() == 0


def test_cleaners(spark):
    vals = ['" N/A "', '"none"', '"unknown"', '"0"', '"1d"', '0', '""', '"  7.5 "']
    df = spark.createDataFrame([(v,) for v in vals], "j string").select(I.parse_payload("j").alias("v"))
    txt = [r[0] for r in df.select(I.clean_text(F.col("v"))).collect()]
    num = [r[0] for r in df.select(I.clean_number(F.col("v"))).collect()]
    assert txt == [None, None, None, "0", "1d", "0", None, "7.5"]
    assert num == [None, None, None, 0.0, None, 0.0, None, 7.5]


def test_profile_conform_aliases_and_zero(spark):
    pl = spark.createDataFrame([
        ("A", '{"ticker": "AAA", "finnhubIndustry": " Tech ", "marketCapitalization": 5, "market_cap": 0}'),
        ("B", '{}'), ("C", '{"ticker": ""}'),
        ("D", '{"ticker": "DDD", "name": "n/a", "industry": "Bank", "finnhubIndustry": "X"}')],
        "symbol string, payload string")
    fh = I.profiles_finnhub(pl)
    assert sorted(r.outcome for r in fh.collect()) == ["empty", "empty", "upserted", "upserted"]
    rows = {r.symbol: r for r in I.profiles_conform(fh.filter("outcome = 'upserted'")).collect()}
    assert rows["AAA"].industry == "Tech" and rows["AAA"].market_cap == 5.0   # 0 counts as missing
    assert rows["DDD"].industry == "Bank" and rows["DDD"].name is None


def test_yahoo_profile(spark):
    pl = spark.createDataFrame([("A", '{"shortName": "Short", "longName": "", "exchange": "none", '
                                      '"fullExchangeName": "NasdaqGS", "marketCap": "12"}'),
                                ("B", '{"country": "US"}'), ("C", '{}')], "symbol string, payload string")
    got = I.profiles_yahoo(pl).select(F.col("symbol").cast("string").alias("s"), F.col("name").cast("string").alias("n"),
                                      F.col("exchange").cast("string").alias("e"),
                                      F.col("market_cap").cast("double").alias("m"), "outcome").collect()
    got = {x.s: x for x in got}
    # "none" is truthy, so it wins over fullExchangeName and is then cleaned to NULL
    assert got["A"].n == "Short" and got["A"].e is None and got["A"].m == 12.0 and got["A"].outcome == "upserted"
    assert got["B"].outcome == "empty" and got["C"].outcome == "empty"


def test_resolvers(spark):
    alpha = spark.createDataFrame([
        ("abc", '{"bestMatches": [{"1. symbol": "ZZZ", "2. name": "z"}, {"1. symbol": "ABC", "2. name": "a"}]}'),
        ("DEF", '{"bestMatches": [{"1. symbol": "", "2. name": "d", "4. region": "US"}]}'),
        ("GHI", '{"bestMatches": []}'), ("JKL", '{"Note": "slow down"}')], "symbol string, payload string")
    got = {r.ipo_symbol: r for r in I.resolve_first_or_exact(alpha).collect()}
    assert got["ABC"].vendor_symbol == "ABC" and got["ABC"].notes == "match=ABC name=a region=None"
    assert got["DEF"].vendor_symbol == "DEF" and got["DEF"].is_priceable
    assert got["GHI"].notes == "No matches from SYMBOL_SEARCH" and not got["GHI"].is_priceable
    assert got["JKL"].notes.startswith("resolve_error: ") and not got["JKL"].is_priceable
    q = '{"quotes": [{"symbol": "%s", "exchange": "NMS", "quoteType": "EQUITY"}]}'
    yh = spark.createDataFrame([(s, q % s) for s in ("ABU", "W", "AW", "A.B", "A-U")], "symbol string, payload string")
    got = {r.ipo_symbol: r.resolved for r in I.resolve_ranked_exact(yh).collect()}
    assert got == {"ABU": "ABU", "W": "W", "AW": None, "A.B": None, "A-U": None}


def test_high_water_marks(spark):
    wl = spark.createDataFrame([("A", "VA", dt.date(2001, 3, 1)), ("B", "VB", dt.date(2001, 3, 1)),
                                ("C", "VC", dt.date(2001, 1, 1)), ("D", "VD", dt.date(2001, 7, 5))],
                               "ipo_symbol string, vendor_symbol string, ipo_date date")
    px = spark.createDataFrame([("yahoo", "VB", dt.date(2001, 3, 10)), ("yahoo", "VC", dt.date(2001, 5, 1)),
                                ("alphavantage", "VA", dt.date(2001, 3, 20))],
                               "source string, symbol string, price_date date")
    got = {r.ipo_symbol: (r.load_from, r.load_to, r.load_status) for r in
           W.load_windows(wl, px, source="yahoo", as_of=AS_OF).collect()}
    assert got["A"] == (dt.date(2001, 3, 1), dt.date(2001, 6, 9), "load")           # no hwm: full window
    assert got["B"] == (dt.date(2001, 3, 11), dt.date(2001, 6, 9), "load")          # hwm + 1
    assert got["C"][2] == "up_to_date"                                            # hwm past window end
    assert got["D"][2] == "not_listed_yet"


def test_upsert_idempotent_and_last_wins(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    b = spark.createDataFrame([("b", 20, 1), ("c", 30, 1), ("c", 31, 2)], "k string, v int, seq int")
    b1 = last_wins(b, ["k"], [F.col("seq")])
    once = upsert(t, b1, ["k"])
    twice = upsert(once, b1, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [("a", 1), ("b", 20), ("c", 31)]


def _months(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int, m string")


def _held(df):
    return sorted((r.k, r.v, r.m) for r in df.collect())


def test_upsert_partitioned_rewrites_touched_only(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="evwin-upsert-"), "t")
    first = V.create(spark, path, _months(spark, ("a", 1, "2001-01"), ("b", 2, "2001-02")), "m", ("m", "k"))
    after = upsert_partitioned(spark, path, _months(spark, ("b", 20, "2001-02"), ("c", 3, "2001-03"), ("n", 4, None)), ["k"], "m")
    assert _held(V.read(spark, path).fillna("none", ["m"])) == [("a", 1, "2001-01"), ("b", 20, "2001-02"), ("c", 3, "2001-03"), ("n", 4, "none")]
    assert after.parts["2001-01"] == first.parts["2001-01"] and after.parts["2001-02"] != first.parts["2001-02"]   # untouched partition
    again = upsert_partitioned(spark, path, _months(spark, ("b", 20, "2001-02")), ["k"], "m")
    assert again.number == 3 and V.read(spark, path).count() == 4
    assert not os.listdir(os.path.join(path, "_batches")) and len(os.listdir(os.path.join(path, "_pointers"))) == 4   # two, and their checksums
    with pytest.raises(ValueError, match="partition value"):
        upsert_partitioned(spark, path, _months(spark, ("z", 1, "a/b")), ["k"], "m")


def test_a_reader_sees_the_table_before_or_after_a_merge(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="evwin-upsert-"), "t")
    old = [("a", 1, "2001-01"), ("b", 2, "2001-02")]
    V.create(spark, path, _months(spark, *old), "m", ("m", "k"))
    opened, seen = V.read(spark, path), []
    put = V._put

    def looks(spark_, file, text=""):
        seen.append(_held(V.read(spark_, path)))    # files of the merge are written, its manifest and pointer not yet
        put(spark_, file, text)
    monkeypatch.setattr(V, "_put", looks)
    upsert_partitioned(spark, path, _months(spark, ("b", 20, "2001-02"), ("a", 10, "2001-01")), ["k"], "m")
    assert seen == [old, old] and _held(V.read(spark, path)) == [("a", 10, "2001-01"), ("b", 20, "2001-02")]
    assert _held(opened) == old     # a query begun before the merge reads on


def test_a_writer_that_dies_changes_nothing(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="evwin-upsert-"), "t")
    V.create(spark, path, _months(spark, ("a", 1, "2001-01")), "m", ("m", "k"))
    commit = V.commit
    monkeypatch.setattr(V, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        upsert_partitioned(spark, path, _months(spark, ("a", 9, "2001-01")), ["k"], "m")
    assert _held(V.read(spark, path)) == [("a", 1, "2001-01")]
    monkeypatch.setattr(V, "commit", commit)
    upsert_partitioned(spark, path, _months(spark, ("b", 2, "2001-01")), ["k"], "m")
    assert _held(V.read(spark, path)) == [("a", 1, "2001-01"), ("b", 2, "2001-01")]


def test_a_second_writer_is_refused(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="evwin-upsert-"), "t")
    before = V.create(spark, path, _months(spark, ("a", 1, "2001-01")), "m", ("m", "k"))
    rows = _months(spark, ("a", 2, "2001-01"))
    version, holds = V.write(spark, path, rows, "m", ("m", "k"))
    upsert_partitioned(spark, path, _months(spark, ("a", 3, "2001-01")), ["k"], "m")
    with pytest.raises(V.ConcurrentWrite):
        V.commit(spark, path, before, version, holds, holds, rows.schema, "m")
    assert _held(V.read(spark, path)) == [("a", 3, "2001-01")]


def test_tables_without_a_date_are_bucketed_by_key(spark):
    from evwin.operators.upsert import key_bucket
    path = os.path.join(tempfile.mkdtemp(prefix="evwin-upsert-"), "t")
    rows = spark.range(200).selectExpr("cast(id as string) k", "0 v")
    V.create(spark, path, rows.withColumn("b", key_bucket(["k"])), "b", ("b", "k"))
    new = spark.range(190, 210).selectExpr("cast(id as string) k", "1 v").withColumn("b", key_bucket(["k"]))
    upsert_partitioned(spark, path, new, ["k"], "b")
    got = V.read(spark, path)
    assert got.count() == 210 and got.filter("v = 1").count() == 20


def test_fallback_and_summary(spark):
    wl = spark.createDataFrame([("A", "YA", dt.date(2001, 3, 1)), ("B", "YB", dt.date(2001, 3, 1)),
                                ("C", "YC", dt.date(2001, 8, 1))], "ipo_symbol string, vendor_symbol string, ipo_date date")
    smap = spark.createDataFrame([("alphavantage", "B", "AB", True), ("alphavantage", "A", "AA", True)],
                                 "vendor string, ipo_symbol string, vendor_symbol string, is_priceable boolean")
    empty = spark.createDataFrame([], "source string, symbol string, price_date date")
    staged = spark.createDataFrame([("yahoo", "YA", dt.date(2001, 3, 2), None, None, None, None, 1),
                                    ("alphavantage", "AB", dt.date(2001, 3, 3), None, None, None, None, 1),
                                    ("alphavantage", "AA", dt.date(2001, 3, 3), None, None, None, None, 1)],
                                   "source string, symbol string, price_date date, open decimal(18,6), "
                                   "high decimal(18,6), low decimal(18,6), close decimal(18,6), volume bigint")
    pw, sw = W.fallback_windows(wl, empty, smap, as_of=AS_OF)
    off = W.primary_with_fallback(pw, sw, staged, use_fallback=False)
    on = W.primary_with_fallback(pw, sw, staged, use_fallback=True)
    assert sorted((r.ipo_symbol, r.source) for r in off.collect()) == [("A", "yahoo")]
    assert sorted((r.ipo_symbol, r.source) for r in on.collect()) == [("A", "yahoo"), ("B", "alphavantage")]
    s = W.price_run_summary(W.turn_outcomes(pw, sw, staged, use_fallback=True)).collect()[0]
    assert (s.attempted, s.rows, s.with_data, s.no_data, s.yahoo_used, s.alpha_used) == (3, 2, 2, 1, 2, 1)


_BARS = ("source string, symbol string, price_date date, open decimal(18,6), high decimal(18,6), "
         "low decimal(18,6), close decimal(18,6), volume bigint")
_NO_MAP = "vendor string, ipo_symbol string, vendor_symbol string, is_priceable boolean"
_PAIRS = "ipo_symbol string, vendor_symbol string, ipo_date date"


def _bar(symbol, day, source="yahoo"):
    return (source, symbol, day, None, None, None, None, 1)


def test_every_listing_date_of_a_symbol_is_loaded(spark):
    wl = spark.createDataFrame([("A", "YA", dt.date(2001, 3, 1)), ("A", "YA", dt.date(2001, 6, 20))], _PAIRS)
    staged = spark.createDataFrame([_bar("YA", dt.date(2001, 3, 5)), _bar("YA", dt.date(2001, 6, 25))], _BARS)
    empty = spark.createDataFrame([], "source string, symbol string, price_date date")
    pw, sw = W.fallback_windows(wl, empty, spark.createDataFrame([], _NO_MAP), as_of=AS_OF)
    out = W.primary_with_fallback(pw, sw, staged, use_fallback=True)
    # the newer listing loads 25 June; the older one's turn then starts after it, and its window ends on 9 June
    assert [(r.ipo_date, r.price_date) for r in out.collect()] == [(dt.date(2001, 6, 20), dt.date(2001, 6, 25))]
    s = W.price_run_summary(W.turn_outcomes(pw, sw, staged, use_fallback=True)).collect()[0]
    assert (s.attempted, s.rows, s.with_data, s.no_data, s.yahoo_used) == (2, 1, 1, 1, 2)
    # without a bar in the newer window, the older listing loads its own
    out = W.primary_with_fallback(pw, sw, staged.filter("price_date < '2001-06-01'"))
    assert [(r.ipo_date, r.price_date) for r in out.collect()] == [(dt.date(2001, 3, 1), dt.date(2001, 3, 5))]


def test_shared_series_counts_a_bar_once(spark):
    wl = spark.createDataFrame([("A", "Y", dt.date(2001, 3, 1)), ("B", "Y", dt.date(2001, 3, 1))], _PAIRS)
    staged = spark.createDataFrame([_bar("Y", dt.date(2001, 3, 5))], _BARS)
    empty = spark.createDataFrame([], "source string, symbol string, price_date date")
    pw, sw = W.fallback_windows(wl, empty, spark.createDataFrame([], _NO_MAP), as_of=AS_OF)
    s = W.price_run_summary(W.turn_outcomes(pw, sw, staged)).collect()[0]
    assert (s.rows, s.with_data, s.no_data) == (1, 1, 1)


def test_failed_series_fall_back_and_count(spark):
    wl = spark.createDataFrame([("A", "Y", dt.date(2001, 3, 1)), ("B", "Z", dt.date(2001, 3, 1))], _PAIRS)
    smap = spark.createDataFrame([("alphavantage", "A", "AA", True), ("alphavantage", "B", "AB", True)], _NO_MAP)
    staged = spark.createDataFrame([_bar("Y", dt.date(2001, 3, 5)), _bar("AA", dt.date(2001, 3, 6), "alphavantage")], _BARS)
    bad = spark.createDataFrame([("yahoo", "Y"), ("alphavantage", "AB")], "source string, symbol string")
    empty = spark.createDataFrame([], "source string, symbol string, price_date date")
    pw, sw = W.fallback_windows(wl, empty, smap, as_of=AS_OF, failures=bad)
    out = W.primary_with_fallback(pw, sw, staged, use_fallback=True)
    assert [(r.ipo_symbol, r.source) for r in out.collect()] == [("A", "alphavantage")]
    s = W.price_run_summary(W.turn_outcomes(pw, sw, staged, use_fallback=True)).collect()[0]
    assert (s.failed, s.yahoo_used, s.alpha_used, s.with_data, s.no_data) == (2, 1, 1, 1, 1)


def test_loads_equal_a_loop_in_any_order(spark):
    import random
    rnd = random.Random(5)
    day0 = dt.date(2001, 3, 1)
    wl = sorted({(f"L{i}", f"Y{rnd.randrange(3)}", day0 + dt.timedelta(rnd.randrange(40))) for i in range(40)},
                key=lambda r: (r[1], r[0]))
    bars = sorted({(f"Y{s}", day0 + dt.timedelta(rnd.randrange(60))) for s in range(3) for _ in range(12)})
    marks, want = {}, set()
    for sym, ser, d in wl:   # turn order: series, then symbol, whatever the dates
        lo = max(marks.get(ser, dt.date.min) + dt.timedelta(1), d) if ser in marks else d
        got = [x for s, x in bars if s == ser and lo <= x <= d + dt.timedelta(10)]
        want |= {(sym, ser, x) for x in got}
        if got:
            marks[ser] = max(got)
    w = spark.createDataFrame(wl, _PAIRS)
    empty = spark.createDataFrame([], "source string, symbol string, price_date date")
    pw, sw = W.fallback_windows(w, empty, spark.createDataFrame([], _NO_MAP), as_of=AS_OF, window_days=10,
                                turn=F.struct("vendor_symbol", "ipo_symbol"))
    out = W.primary_with_fallback(pw, sw, spark.createDataFrame([_bar(s, x) for s, x in bars], _BARS))
    rows = [(r.ipo_symbol, r.symbol, r.price_date) for r in out.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_calendar_windows_modes(spark):
    ev = spark.createDataFrame([(dt.date(2000, 3, 1),), (dt.date(2001, 6, 1),), (dt.date(2001, 7, 20),)],
                               "ipo_date date")
    inc = I.calendar_windows(spark, ev, as_of=AS_OF).collect()[0]
    assert (inc.window_from, inc.window_to, inc.events) == (dt.date(2000, 6, 30), dt.date(2001, 7, 14), 1)
    full = {r.window_from.year: r.events for r in
            I.calendar_windows(spark, ev, as_of=AS_OF, full=True, start_year=1999).collect()}
    assert full == {1999: 0, 2000: 1, 2001: 2, 2002: 0}
    assert I.calendar_windows(spark, ev, as_of=AS_OF, full=True).count() == 0   # 2014 > as_of year + 1


def test_source_default(spark):
    p = spark.createDataFrame([(None, "A"), ("yahoo", "B")], "source string, symbol string")
    assert sorted(tuple(x) for x in I.profile_source_default(p).collect()) == [("finnhub", "A"), ("yahoo", "B")]


def test_upsert_batch_duplicates_collapse(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    b = spark.createDataFrame([("a", 5), ("a", 7), ("b", 2), ("b", 2)], "k string, v int")
    assert sorted(upsert(t, b, ["k"]).collect()) == [("a", 7), ("b", 2)]


def test_unreadable_payload_is_a_resolve_error(spark):
    rows = [("A", None), ("B", "<html>busy</html>"), ("C", '{"bestMatches": []}'), ("D", '{"Note": "slow down"}')]
    got = {r.ipo_symbol: r for r in I.resolve_first_or_exact(spark.createDataFrame(rows, "symbol string, payload string")).collect()}
    assert got["A"].notes.startswith("resolve_error: ") and got["B"].notes.startswith("resolve_error: ")
    assert got["D"].notes.startswith("resolve_error: ") and got["D"].notes.endswith("slow down")
    assert not got["C"].notes.startswith("resolve_error") and not any(r.is_priceable for r in got.values())


def test_market_cap_is_read_like_a_float(spark):
    rows = [(s, f'{{"longName": "N", "marketCap": {v}}}') for s, v in (("A", '"1d"'), ("B", '"1_000"'), ("C", "12.5"), ("D", '" 7 "'))]
    out = I.profiles_yahoo(spark.createDataFrame(rows, "symbol string, payload string"))
    got = {r.s: r.m for r in out.selectExpr("cast(symbol as string) s", "cast(market_cap as double) m").collect()}
    assert got == {"A": None, "B": 1000.0, "C": 12.5, "D": 7.0}


def test_history_needs_only_a_row(spark):
    import datetime as dt
    p = spark.createDataFrame([("yahoo", "A", dt.date(2001, 6, 20), None, None, None, None)], "source string, symbol string, price_date date, open double, high double, low double, close double")
    p = p.withColumn("price_month", F.date_format("price_date", "yyyy-MM"))
    got = I.history_check(spark.createDataFrame([("A",), ("B",)], "resolved string"), p, as_of=dt.date(2001, 6, 30)).collect()
    assert {r.resolved: r.has_history for r in got} == {"A": True, "B": False}


def test_upsert_within_equals_upsert_and_refuses_other_dates(spark):
    t = spark.createDataFrame([("a", dt.date(2001, 1, d), d) for d in range(1, 11)], "k string, price_date date, v int")
    b = spark.createDataFrame([("a", dt.date(2001, 1, 5), 50), ("b", dt.date(2001, 1, 6), 60)], "k string, price_date date, v int")
    keys, lo, hi = ["k", "price_date"], dt.date(2001, 1, 4), dt.date(2001, 1, 7)
    assert sorted(upsert_within(t, b, keys, "price_date", lo, hi).collect()) == sorted(upsert(t, b, keys).collect())
    with pytest.raises(Exception, match="outside the batch"):
        upsert_within(t, b, keys, "price_date", lo, dt.date(2001, 1, 5)).collect()


def test_raw_record_and_raw_row_are_what_was_passed_in(spark):
    import json
    fh = spark.createDataFrame([("A", '{"ticker": "A", "name": "Co", "symbol": "old", "ipo": null}')], "symbol string, payload string")
    yh = spark.createDataFrame([("B", '{"longName": "Co B", "marketCap": "7"}')], "symbol string, payload string")
    row = I.profiles_conform(I.profiles_finnhub(fh)).first()
    assert json.loads(row.raw_json) == {"ticker": "A", "name": "Co", "ipo": None, "source": "finnhub", "symbol": "A"}
    row = I.profiles_conform(I.profiles_yahoo(yh)).first()
    assert json.loads(row.raw_json) == {
        "source": "yahoo", "symbol": "B", "name": "Co B", "exchange": None, "country": None, "industry": None,
        "sector": None, "currency": None, "weburl": None, "market_cap": 7.0, "logo": None,
        "raw_json": {"longName": "Co B", "marketCap": "7"}}
    p = spark.createDataFrame([("v", "S", dt.date(2001, 1, 2), None)], "source string, symbol string, price_date date, open double")
    assert json.loads(I.price_rows(p).first().raw_row) == {"source": "v", "symbol": "S", "date": "2001-01-02", "open": None}


def test_unreadable_payloads_and_series_faults_are_set_aside(spark):
    day = dt.date(2001, 1, 1)
    rows = [("ok", '{"Time Series (Daily)": {"2001-01-02": {"1. open": "1"}, "2000-01-02": {"1. open": "abc"}}}'),
            ("cut", '{"Time Series (Daily)": {"2001-01-02": {"1. open": "1"'), ("none", None), ("empty", "{}"),
            ("date", '{"Time Series (Daily)": {"2001-01-02": {"1. open": "1"}, "no day": {"1. open": "1"}}}'),
            ("number", '{"Time Series (Daily)": {"2001-01-02": {"1. open": "1"}, "2001-01-03": {"5. volume": "x"}}}')]
    df = spark.createDataFrame([(s, p, day, dt.date(2001, 1, 31)) for s, p in rows],
                               "symbol string, payload string, date_from date, date_to date")
    assert {(r.symbol, r.reason) for r in I.series_faults(df).collect()} == {
        ("cut", I.UNREADABLE_PAYLOAD), ("none", I.UNREADABLE_PAYLOAD), ("date", I.BAD_DATE), ("number", I.BAD_NUMBER)}
    assert [r.symbol for r in I.daily_series_flatten(df).collect()] == ["ok"]
    assert {(r.symbol, r.payload_length) for r in I.unreadable(df).collect()} == {("cut", 54), ("none", None)}


def test_calendar_documents_hold_about_the_stated_rows(spark):
    from evwin.sources.payloads import calendar_payloads
    ev = spark.range(5000).select(
        F.col("id").cast("string").alias("event_id"), F.lit(AS_OF).alias("ipo_date"), F.lit("n").alias("company_name"),
        F.lit("S").alias("symbol"), F.lit("NYSE").alias("exchange"), F.lit(1).alias("price_range_low"),
        F.lit(2).alias("price_range_high"), F.lit(3).alias("shares"))
    sizes = [r[0] for r in calendar_payloads(ev, as_of=AS_OF, rows_per_document=100)
             .select(F.regexp_count("payload", F.lit('"date"'))).collect()]
    assert sum(sizes) == 5000 and len(sizes) == 50 and max(sizes) < 200


def test_mapping_and_profile_keys_hold_beyond_the_symbol_space(spark):
    from evwin.plans.quality import key_checks
    from evwin.sources import testdata as T
    from evwin.sources.schemas import KEYS
    part = spark.range(1_000_000).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"),
        F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice"))
    supplier = spark.range(100).select(F.col("id").alias("s_suppkey"))
    checks = key_checks({"symbol_map": (T.symbol_map(part, supplier), KEYS["symbol_map"]),
                         "company_profiles": (T.company_profiles(part), KEYS["company_profiles"])})
    assert checks.filter("status <> 'pass'").count() == 0
