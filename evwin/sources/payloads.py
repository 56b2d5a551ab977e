"""Landed vendor payloads built by Spark from the derived raw tables (FIXTURES
§2: "build the JSON from these tables by to_json"), so that every parse has
a relational source to be checked against.  Each builder is one grouped
plan; a payload holds a bounded group (one day and hash bucket of a
calendar, one month of one symbol's series, one symbol's profile)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evwin.functions.exprs import lit_date

# --- fixed values of the payload scenario -------------------------------------
BATCH_TS = dt.datetime(2001, 6, 30, 9, 0, 0)
CALENDAR_ROWS = 500       # events a document, about
REPLAY_FROM = 10 ** 15
REPLAY_EXCHANGE = ("OTC", "OTC Markets")   # re-sent later with a changed value
NOTE_TEXT = "call frequency"
ERROR_TEXT = "timeout after 30s"
BROKEN_SERIES = ('{"Time Series (Daily)": {"2001-01-02": {"1. open": "1"',
                 '{"Time Series (Daily)": {"2001-13-02": {"1. open": "1"}, "2001-01-03": {"1. open": "1"}}}',
                 '{"Time Series (Daily)": {"2001-01-02": {"1. open": "abc"}, "2001-01-03": {"1. open": "1"}}}')
FAILED_SUFFIX = "7"    # vendor series whose download failed
TRIAGE_EXTRAS = ('{"Note": "Thank you for using the API"}', '{"Error Message": "Invalid API call"}',
                 '{"Information": "premium endpoint"}', '{"Meta Data": {}}')
# -----------------------------------------------------------------------------

_EPOCH = dt.date(1970, 1, 1)


def _calendar_row():
    return F.struct(F.col("ipo_date").cast("string").alias("date"), F.col("company_name").alias("name"),
                    "symbol", "exchange", F.col("price_range_low").alias("priceRangeLow"),
                    F.col("price_range_high").alias("priceRangeHigh"), F.col("shares").alias("numberOfShares"))


def calendar_payloads(events: DataFrame, *, as_of: dt.date, lookback_days: int = 365,
                      lookahead_days: int = 14, rows_per_document: int = CALENDAR_ROWS) -> DataFrame:
    """(batch_seq, payload): events of the incremental window grouped by day
    and hash bucket, with as many buckets a day as its events need at some
    ``rows_per_document`` each; the envelope varies with the day (key 1, empty key 1
    then key 2, key 3, and a non-list key 1 that yields no rows).  Events
    on the replay exchange are re-sent in later batches with a new value."""
    lo, hi = as_of - dt.timedelta(days=lookback_days), as_of + dt.timedelta(days=lookahead_days)
    ev = events.filter(F.col("ipo_date").between(lit_date(lo), lit_date(hi)))
    per_day = ev.groupBy("ipo_date").agg(F.ceil(F.count(F.lit(1)) / rows_per_document).alias("_docs"))
    ev = ev.join(per_day, "ipo_date")
    day = F.datediff("ipo_date", F.lit(_EPOCH)).cast("bigint")
    b = F.pmod(F.xxhash64("event_id"), F.col("_docs"))

    def grouped(df):
        return df.groupBy(day.alias("day"), b.alias("b")).agg(F.collect_list(_calendar_row()).alias("rows"))

    g = grouped(ev)
    rows = F.to_json("rows")
    kind = F.pmod(F.col("day"), F.lit(4))
    payload = (F.when(kind == 0, F.concat(F.lit('{"ipoCalendar": '), rows, F.lit("}")))
               .when(kind == 1, F.concat(F.lit('{"ipoCalendar": [], "ipoCalendarData": '), rows, F.lit("}")))
               .when(kind == 2, F.concat(F.lit('{"ipoCalendar": null, "data": '), rows, F.lit("}")))
               .otherwise(F.concat(F.lit('{"ipoCalendar": {"status": "unavailable"}, "ipoCalendarData": '),
                                   rows, F.lit("}"))))
    seq = F.col("day") * 10 ** 9 + F.col("b")
    first = g.select(seq.alias("batch_seq"), payload.alias("payload"))
    old, new = REPLAY_EXCHANGE
    replay = grouped(ev.filter(F.col("exchange") == old).withColumn("exchange", F.lit(new)))
    again = replay.select((F.lit(REPLAY_FROM) + seq).alias("batch_seq"),
                          F.concat(F.lit('{"ipoCalendar": '), F.to_json("rows"), F.lit("}")).alias("payload"))
    return first.unionByName(again)


def series_payloads(prices: DataFrame, *, source: str = "alphavantage") -> DataFrame:
    """(symbol, payload): one daily-series document per symbol and month."""
    p = prices.filter(F.col("source") == source)
    bar = F.struct(*[F.col(c).cast("string").alias(k) for c, k in
                     (("open", "1. open"), ("high", "2. high"), ("low", "3. low"), ("close", "4. close"),
                      ("volume", "5. volume"))])
    entry = F.struct(F.col("price_date").cast("string").alias("k"), bar.alias("v"))
    g = p.groupBy("symbol", F.trunc("price_date", "month").alias("month")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("series"))
    return g.select("symbol", F.to_json(F.struct(F.col("series").alias("Time Series (Daily)"))).alias("payload"))


def faulty_series(prices: DataFrame, *, source: str = "alphavantage") -> DataFrame:
    """Series payloads plus, per symbol, one that is cut off, one with a broken
    day and one with a broken number beside a good bar."""
    syms = prices.filter(F.col("source") == source).select("symbol").distinct()
    bad = syms.select("symbol", F.explode(F.array(*[F.lit(x) for x in BROKEN_SERIES])).alias("payload"))
    return series_payloads(prices, source=source).unionByName(bad)


def triage_payloads(prices: DataFrame, *, source: str = "alphavantage") -> DataFrame:
    """Series payloads plus, per symbol, one payload of each failure kind."""
    syms = prices.filter(F.col("source") == source).select("symbol").distinct()
    extras = syms.select("symbol", F.explode(F.array(*[F.lit(x) for x in TRIAGE_EXTRAS])).alias("payload"))
    return series_payloads(prices, source=source).unionByName(extras)


def failed_series(symbol_map: DataFrame) -> DataFrame:
    """(source, symbol) of the vendor series whose download failed."""
    return (symbol_map.filter(F.col("vendor_symbol").endswith(FAILED_SUFFIX))
            .select(F.col("vendor").alias("source"), F.col("vendor_symbol").alias("symbol")).distinct())


def bar_frames(prices: DataFrame, *, as_of: dt.date, lookback_days: int = 365,
               source: str = "yahoo") -> DataFrame:
    """Vendor bar frames as a download would give them: capitalised,
    padded column names, doubles, NaN for a missing close."""
    p = prices.filter(F.col("source") == source)
    c = F.col("close").cast("double")
    return p.select(
        "symbol", F.col("price_date").cast("timestamp").alias("Date"),
        F.col("open").cast("double").alias(" Open"), F.col("high").cast("double").alias("High "),
        F.col("low").cast("double").alias("LOW"), F.when(c.isNull(), F.lit(float("nan"))).otherwise(c).alias("Close"),
        F.col("volume").cast("double").alias("Volume"),
        lit_date(as_of - dt.timedelta(days=lookback_days)).alias("date_from"), lit_date(as_of).alias("date_to"))


def finnhub_profile_payloads(profiles: DataFrame, symbol_map: DataFrame) -> DataFrame:
    """(symbol, payload, error): a profile document per finnhub profile, and for
    mapped symbols without one an empty document or a failed call."""
    fh = profiles.filter(F.col("source") == "finnhub")
    doc = F.to_json(F.struct(F.col("symbol").alias("ticker"), "name", "exchange", "country", "ipo", "currency",
                             F.col("market_cap").alias("marketCapitalization"),
                             F.col("industry").alias("finnhubIndustry"), "weburl", "logo"))
    full = fh.select("symbol", doc.alias("payload"))
    missing = (symbol_map.select(F.col("ipo_symbol").alias("symbol")).distinct()
               .join(fh.select("symbol"), "symbol", "left_anti"))
    down = F.col("symbol").endswith(FAILED_SUFFIX)
    missing = missing.select("symbol", F.when(~down, F.lit("{}")).alias("payload"), F.when(down, F.lit(ERROR_TEXT)).alias("error"))
    return full.withColumn("error", F.lit(None).cast("string")).unionByName(missing)


def yahoo_profile_payloads(profiles: DataFrame) -> DataFrame:
    y = profiles.filter(F.col("source") == "yahoo")
    doc = F.to_json(F.struct(F.col("name").alias("longName"), "exchange", "country", "industry", "sector",
                             F.col("market_cap").alias("marketCap"), "currency", F.col("weburl").alias("website")))
    return y.select("symbol", doc.alias("payload"))


def alpha_search_payloads(symbol_map: DataFrame) -> DataFrame:
    """(symbol, payload) of symbol searches, one per alphavantage mapping."""
    m = symbol_map.filter(F.col("vendor") == "alphavantage")
    s, v, p = F.col("ipo_symbol"), F.col("vendor_symbol"), F.col("is_priceable")
    cand = "struct<`1. symbol`: string, `2. name`: string, `4. region`: string>"

    def c(sym, name, region):
        return F.struct(sym.alias("1. symbol"), F.lit(name).alias("2. name"),
                        F.lit(region).cast("string").alias("4. region"))
    docs = (F.when(v.startswith("X"), F.lit('{"Note": "' + NOTE_TEXT + '"}'))
            .when(p, F.to_json(F.struct(F.array(c(v, "first", "United States"), c(F.lower(s), "exact", None))
                                        .alias("bestMatches"))))
            .when(v.startswith("N"), F.lit('{"bestMatches": []}'))
            .otherwise(F.to_json(F.struct(F.array(c(v, "only", "United States")).cast(f"array<{cand}>")
                                          .alias("bestMatches")))))
    return m.select(F.col("ipo_symbol").alias("symbol"), docs.alias("payload"))


def yahoo_search_requests(symbol_map: DataFrame) -> DataFrame:
    """(symbol, payload, error): searches for each distinct yahoo vendor symbol."""
    v = F.col("symbol")

    def q(sym, exch):
        return F.struct(sym.alias("symbol"), F.lit(exch).alias("exchange"), F.lit("EQUITY").alias("quoteType"))
    syms = symbol_map.filter(F.col("vendor") == "yahoo").select(F.col("vendor_symbol").alias("symbol")).distinct()
    err = v.startswith("S") & v.endswith("7")
    doc = (F.when(err, F.lit(None).cast("string"))
           .when(v.startswith("X"), F.to_json(F.struct(F.array(q(v, "NMS")).alias("quotes"))))
           .when(v.startswith("N"), F.to_json(F.struct(F.array(q(v, "LSE")).alias("quotes"))))
           .otherwise(F.to_json(F.struct(F.array(q(F.concat(v, F.lit("W")), "NMS"), q(v, "NYQ")).alias("quotes")))))
    return syms.select("symbol", doc.alias("payload"), F.when(err, F.lit(ERROR_TEXT)).alias("error"))


def symbol_search_requests(symbol_map: DataFrame) -> DataFrame:
    """(symbol, payload, error): quote searches for the listing symbols of the second
    vendor's mappings: found as they are, found on a foreign exchange, or failed."""
    v = F.col("symbol")
    quote = F.struct(v.alias("symbol"), F.when(v.endswith("Z"), "LSE").otherwise("NYQ").alias("exchange"), F.lit("EQUITY").alias("quoteType"))
    down = v.endswith(FAILED_SUFFIX)
    syms = symbol_map.filter(F.col("vendor") == "yahoo").select(F.col("ipo_symbol").alias("symbol")).distinct()
    return syms.select("symbol", F.when(~down, F.to_json(F.struct(F.array(quote).alias("quotes")))).alias("payload"),
                       F.when(down, F.lit(ERROR_TEXT)).alias("error"))


#: What the store held before the landed files: the fourth letter of a symbol decides
#: which mappings and profiles are still to be found.
NEW_ALPHA, NEW_YAHOO, NEW_PROFILE = ("A", "H"), ("S", "Z"), ("J", "N")


def is_new(symbol, letters):
    return F.substring(symbol, 4, 1).between(*letters)


def _land_calendar(raw, folder: str, as_of: dt.date) -> None:
    """The calendar, later the same documents again in part (files landed twice) beside
    re-sent events."""
    from evwin.session import materialize
    from evwin.sources.landing import land_documents
    docs = materialize(calendar_payloads(raw.ipo_events, as_of=as_of), "calendar")  # so that both landings have the same bytes
    again = F.col("batch_seq") >= REPLAY_FROM
    land_documents(docs.filter(~again), f"{folder}/1")
    land_documents(docs.filter(again | (F.col("batch_seq") % 3 == 0)), f"{folder}/2")


def _failed_calls(raw, source: str) -> DataFrame:
    return failed_series(raw.symbol_map).filter(F.col("source") == source).select("source", "symbol", F.lit(ERROR_TEXT).alias("error"))


#: What each feed of envelopes lands.
_ENVELOPES = {
    "series": lambda raw: (faulty_series(raw.daily_prices), _failed_calls(raw, "alphavantage")),
    "triage": lambda raw: (triage_payloads(raw.daily_prices),),
    "bars_errors": lambda raw: (_failed_calls(raw, "yahoo"),),
    "finnhub_profile": lambda raw: (finnhub_profile_payloads(raw.company_profiles, raw.symbol_map),),
    "yahoo_profile": lambda raw: (yahoo_profile_payloads(raw.company_profiles),),
    "alpha_search": lambda raw: (alpha_search_payloads(raw.symbol_map),),
    "yahoo_search": lambda raw: (symbol_search_requests(raw.symbol_map),),
    "vendor_search": lambda raw: (yahoo_search_requests(raw.symbol_map),)}
FEEDS = ("calendar", "bars", *_ENVELOPES)


def land(raw, folder: str, feed: str, as_of: dt.date) -> None:
    """One feed of the scenario, landed in ``folder``: the calendar as documents, bars as
    Parquet, responses as envelopes."""
    from evwin.sources.landing import land_envelopes
    if feed == "calendar":
        _land_calendar(raw, folder, as_of)
    elif feed == "bars":
        bar_frames(raw.daily_prices, as_of=as_of).write.parquet(folder)
    else:
        for rows in _ENVELOPES[feed](raw):
            land_envelopes(rows, folder)
