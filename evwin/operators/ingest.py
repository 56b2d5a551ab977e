"""Ingest and conform operators (I01-I18) over *landed* vendor payloads.

The reference calls three web vendors one symbol at a time; here the
payloads are rows (one JSON text per request) and each operator is one
Spark plan over all of them.  JSON is read with the VARIANT functions, so
missing keys, JSON null, empty containers and value types can be told apart
exactly as Python's ``dict.get`` / ``a or b`` see them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.functions.exprs import (CLEAN_TOKENS_DB, CLEAN_TOKENS_PROFILE, lit_date, price_date_range, py_strip,
                                   ts_lit)
from evwin.operators.price_days import with_history

# --- fixed values ------------------------------------------------------------
CALENDAR_KEYS = ("ipoCalendar", "ipoCalendarData", "data")
SERIES_KEY = "Time Series (Daily)"
SERIES_FIELDS = ("1. open", "2. high", "3. low", "4. close", "5. volume")
TRIAGE = (("Note", "rate_limited"), ("Error Message", "error"), ("Information", "info"))
NO_MATCH_NOTE = "No matches from SYMBOL_SEARCH"
RATE_LIMIT_PREFIX = "Alpha Vantage rate limit hit: "
US_EXCHANGES = ("NYQ", "NMS", "NGM", "NCM", "ASE", "NYSE", "NASDAQ", "AMEX")
QUOTE_TYPES = ("EQUITY", "ETF")
DISALLOWED_SUBSTRINGS = (".", "=F", "^", "-UN", "-U", "-WT", "-WS", "-RT", "-P")
DISALLOWED_ENDINGS = ("W", "R")
YAHOO_NOTES = {"match": "yahoo_search:exact_us_match_with_history", "no_history": "yahoo_search:no_history",
               "no_match": "yahoo_search:no_match", "error": "yahoo_search:error:"}
PROFILE_COLUMNS = ("source", "symbol", "name", "exchange", "country", "ipo", "currency", "market_cap",
                   "industry", "sector", "weburl", "logo", "raw_json")
# -----------------------------------------------------------------------------


def _empty_list() -> Column:
    return F.call_function("parse_json", F.lit("[]"))


def _null_variant() -> Column:
    return F.expr("cast(null as variant)")


def _stage(df: DataFrame, drop: tuple = (), **cols: Column) -> DataFrame:
    """Add computed columns in their own projection, so later expressions
    reference them instead of repeating them (the optimizer does not inline
    a non-trivial expression that is referenced more than once)."""
    out = df.select("*", *[c.alias(n) for n, c in cols.items()])
    return out.drop(*drop) if drop else out


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- JSON (variant) helpers: Python truthiness, str(), `a or b` -------------
def vfield(v: Column, key: str) -> Column:
    """``obj.get(key)`` as a variant (SQL NULL when the key is missing)."""
    return F.call_function("variant_get", v, F.lit('$["' + key + '"]'))


def vtype(v: Column) -> Column:
    return F.call_function("schema_of_variant", v)


def _let(v: Column, fn) -> Column:
    """Bind ``v`` once and evaluate ``fn(x)``: a lambda over a one-element
    array.  Keeps expressions linear when the optimizer substitutes one
    projection into another (filter pushdown inlines aliases)."""
    return F.element_at(F.transform(F.array(v), fn), 1)


def py_truthy(v: Column) -> Column:
    def f(x):
        t = F.call_function("schema_of_variant", x)
        return (F.when(x.isNull() | (t == "VOID"), F.lit(False))
                .when(t.startswith("ARRAY"), F.coalesce(F.array_size(x.try_cast("array<variant>")) > 0, F.lit(False)))
                .when(t.startswith("OBJECT"), F.coalesce(F.size(x.try_cast("map<string,variant>")) > 0, F.lit(False)))
                .when(t == "STRING", x.try_cast("string") != "")
                .when(t == "BOOLEAN", x.try_cast("boolean"))
                .otherwise(F.coalesce(x.try_cast("double") != 0, F.lit(True))))
    return _let(v, f)


def py_or(*vs: Column) -> Column:
    """Python ``a or b or c``: the first truthy operand, else the last one."""
    return reduce(lambda acc, v: _let(v, lambda x: F.when(py_truthy(x), x).otherwise(acc)), reversed(vs[:-1]),
                  vs[-1])


def py_str(v: Column) -> Column:
    """``str(value)`` of a decoded JSON value (None -> SQL NULL)."""
    def f(x):
        t = F.call_function("schema_of_variant", x)
        return (F.when(x.isNull() | (t == "VOID"), F.lit(None).cast("string"))
                .when(t == "BOOLEAN", F.when(x.try_cast("boolean"), "True").otherwise("False"))
                .when(t.startswith("ARRAY") | t.startswith("OBJECT"), F.to_json(x))
                .otherwise(x.try_cast("string")))
    return _let(v, f)


def clean_text(v: Column, tokens=CLEAN_TOKENS_DB) -> Column:
    return _let(py_strip(py_str(v)), lambda s: F.when((s == "") | F.lower(s).isin(*tokens),
                                                      F.lit(None).cast("string")).otherwise(s))


_NUM_RE = r"^[+-]?((\d+(_\d+)*)?\.?\d+(_\d+)*|\d+(_\d+)*\.)([eE][+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"


def clean_number(v: Column, tokens=CLEAN_TOKENS_DB) -> Column:
    """Numbers pass through; text is stripped, null tokens -> NULL, parsed as
    Python's float() would, else NULL."""
    def f(x):
        t = F.call_function("schema_of_variant", x)
        parsed = _let(py_strip(py_str(x)), lambda s: F.when(
            F.lower(s).rlike(_NUM_RE) & ~F.lower(s).isin(*tokens), F.regexp_replace(s, "_", "").try_cast("double")))
        return (F.when(x.isNull() | (t == "VOID"), F.lit(None).cast("double"))
                .when(t == "STRING", parsed)
                .otherwise(x.try_cast("double")))
    return _let(v, f)


def parse_payload(col) -> Column:
    return F.call_function("try_parse_json", _c(col))


# ---- I01 calendar ------------------------------------------------------------
_FALSY_JSON = ("", "[]", "{}", "false", "0", "0.0", "-0.0", "null")


def _large_rows(payload: Column) -> Column:
    """The events of a document that a parsed value cannot hold: the envelope's values
    are kept as text, the first truthy one is cut into its elements, and each of those is
    parsed by itself.  NULL for a text that is no JSON object, or a value that is no list."""
    def first_truthy(env):
        text = F.lit(None).cast("string")
        for k in reversed(CALENDAR_KEYS):
            v = env.getField(k)
            text = F.when(v.isNull() | v.isin(*_FALSY_JSON), text).otherwise(v)
        return text
    env = F.from_json(payload, "struct<" + ", ".join(f"{k}: string" for k in CALENDAR_KEYS) + ">")
    element = lambda x: F.coalesce(parse_payload(x), x.cast("variant"))
    return _let(_let(env, first_truthy), lambda text: F.when(text.startswith("["), F.transform(F.from_json(text, "array<string>"), element)))


def calendar_parse(payloads: DataFrame, payload_col: str = "payload", seq_col: str = "batch_seq") -> DataFrame:
    """Listing rows of calendar payloads: the first truthy of the envelope
    keys; a value that is not a list gives no rows.  Keeps the batch
    sequence and position for last-wins deduplication.  Documents beyond the
    size of a parsed value are cut into their events first."""
    p = payloads.select(F.col(seq_col).alias("batch_seq"), F.col(payload_col).alias("_text"), parse_payload(payload_col).alias("_v"))
    p = _stage(p, **{f"_k{i}": vfield(F.col("_v"), k) for i, k in enumerate(CALENDAR_KEYS)})
    p = _stage(p, _ev=py_or(*[F.col(f"_k{i}") for i in range(len(CALENDAR_KEYS))]))
    is_list = vtype(F.col("_ev")).startswith("ARRAY")
    events = F.when(F.col("_v").isNull(), _large_rows(F.col("_text"))).otherwise(F.when(is_list, F.col("_ev").try_cast("array<variant>")))
    rows = p.select("batch_seq", F.posexplode(events).alias("pos", "r"))
    rows = _stage(rows, **{f"_{k}": vfield(F.col("r"), k) for k in ("date", "name", "symbol", "exchange")})

    def g(k, t):
        return F.expr(f"try_variant_get(r, '$.{k}', '{t}')")
    return rows.select(
        "batch_seq", "pos", *[py_str(F.col(f"_{k}")).alias(k) for k in ("date", "name", "symbol", "exchange")],
        g("priceRangeLow", "decimal(18,6)").alias("price_range_low"),
        g("priceRangeHigh", "decimal(18,6)").alias("price_range_high"),
        g("numberOfShares", "bigint").alias("shares"),
        F.to_json("r").alias("raw_json"))


# ---- I02 calendar windows -----------------------------------------------------
def calendar_windows(spark, events: DataFrame, *, as_of: dt.date, full: bool = False,
                     lookback_days: int = 365, lookahead_days: int = 14, start_year: int = 2014,
                     end_year: int | None = None) -> DataFrame:
    """Request windows of a calendar run with the events each covers.  Full
    mode: one window per year (equi-join on the year); incremental: one
    window [as_of - lookback, as_of + lookahead]."""
    if full:
        end_year = as_of.year + 1 if end_year is None else end_year
        years = spark.range(start_year, end_year + 1).select(F.col("id").cast("int").alias("year"))
        cnt = events.groupBy(F.year("ipo_date").alias("year")).agg(F.count(F.lit(1)).alias("events"))
        return (years.join(cnt, "year", "left")
                .select(F.make_date("year", F.lit(1), F.lit(1)).alias("window_from"),
                        F.make_date("year", F.lit(12), F.lit(31)).alias("window_to"),
                        F.coalesce(F.col("events"), F.lit(0)).alias("events")))
    lo, hi = as_of - dt.timedelta(days=lookback_days), as_of + dt.timedelta(days=lookahead_days)
    return (events.filter(F.col("ipo_date").between(lit_date(lo), lit_date(hi)))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(lit_date(lo).alias("window_from"), lit_date(hi).alias("window_to"), "events"))


# ---- I03 / I04 events --------------------------------------------------------
def event_id_expr(source, ipo_date, company_name, symbol) -> Column:
    """md5('source|date|name or ""|symbol or ""').  A missing date prints as
    'None' (Python f-string of None); name/symbol fall back to ''."""
    return F.md5(F.concat(
        _c(source), F.lit("|"),
        F.coalesce(_c(ipo_date).cast("string"), F.lit("None")), F.lit("|"),
        F.coalesce(_c(company_name).cast("string"), F.lit("")), F.lit("|"),
        F.coalesce(_c(symbol).cast("string"), F.lit(""))))


def event_key_dedupe(rows: DataFrame, *, source: str = "finnhub", batch_ts: dt.datetime | None = None
                     ) -> DataFrame:
    """Calendar rows -> raw event rows keyed by event_id; within the batch
    the last occurrence of an id wins."""
    w = Window.partitionBy("event_id").orderBy(F.col("batch_seq").desc(), F.col("pos").desc())
    keyed = rows.withColumn("event_id", event_id_expr(F.lit(source), "date", "name", "symbol"))
    last = keyed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return last.select(
        "event_id", F.lit(source).alias("source"), F.expr("try_to_date(date)").alias("ipo_date"), "symbol",
        F.col("name").alias("company_name"), "exchange", "price_range_low", "price_range_high", "shares",
        "raw_json", ts_lit(batch_ts).alias("ingested_at"))


# ---- I05 / I06 / I07 prices --------------------------------------------------
_SERIES_SCHEMA = ("struct<`" + SERIES_KEY + "`: map<string, struct<"
                  + ", ".join(f"`{f}`: string" for f in SERIES_FIELDS) + ">>>")


def payload_triage(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Adds ``status`` (first match wins: rate_limited, error, info,
    unexpected, ok; invalid for unparseable text) and ``message``."""
    p = _stage(payloads, _v=parse_payload(payload_col))
    p = _stage(p, _keys=F.when(vtype(F.col("_v")).startswith("OBJECT"), F.json_object_keys(F.to_json("_v"))))
    keys = F.col("_keys")
    status = F.when(keys.isNull(), F.lit("invalid"))
    msg = F.lit(None).cast("string")
    for key, st in TRIAGE:
        status = status.when(F.array_contains(keys, key), F.lit(st))
    status = status.when(~F.array_contains(keys, SERIES_KEY), F.lit("unexpected")).otherwise(F.lit("ok"))
    for key, _ in reversed(TRIAGE):
        msg = F.when(F.array_contains(keys, key), py_str(vfield(F.col("_v"), key))).otherwise(msg)
    p = _stage(p, status=status)
    return p.withColumn("message", F.when(F.col("status") != "ok", msg)).drop("_v", "_keys")


def split_load(payloads: DataFrame, folder: str, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """I07 as a load uses it: every payload parsed once and written by status;
    (good, refused) read what is written, refused with status and message."""
    spark = payloads.sparkSession
    payload_triage(payloads, payload_col).write.partitionBy("status").parquet(folder)
    fields = [f for f in payloads.schema if f.name != "status"] + [T.StructField("message", T.StringType()), T.StructField("status", T.StringType())]
    held = spark.read.schema(T.StructType(fields)).parquet(folder)
    return held.filter("status = 'ok'").drop("message"), held.filter("status <> 'ok'")


UNREADABLE_PAYLOAD, BAD_DATE, BAD_NUMBER = "unreadable payload", "bad date", "bad number"


def unreadable(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """The payload rows no parser can take (text that is no JSON document),
    with ``reason`` and length: what a load sets aside and counts, where the
    parsing operators give no rows.  NULL payloads are included; a document that
    is only beyond the size of a parsed value is not."""
    as_text = F.from_json(F.col(payload_col), "map<string, string>", {"mode": "PERMISSIVE"})
    return (payloads.filter(parse_payload(payload_col).isNull() & as_text.isNull())
            .withColumn("reason", F.lit(UNREADABLE_PAYLOAD))
            .withColumn("payload_length", F.length(F.col(payload_col))))


def _series_fault(series: Column, lo: Column, hi: Column) -> Column:
    """Why a daily series as a whole fails: an unreadable day, or a number that
    does not parse in a bar of [lo, hi]; NULL for a good one or none."""
    entries = F.map_entries(series)
    day = lambda e: F.call_function("try_to_date", e["key"], F.lit("yyyy-M-d"))

    def broken(e):
        vals = [e["value"].getField(f) for f in SERIES_FIELDS]
        return day(e).between(lo, hi) & reduce(lambda a, b: a | b, [
            F.coalesce((v != "") & py_strip(v).try_cast("double").isNull(), F.lit(False)) for v in vals])
    return (F.when(F.exists(entries, lambda e: day(e).isNull()), BAD_DATE)
            .when(F.exists(entries, broken), BAD_NUMBER))


def series_faults(payloads: DataFrame, *, payload_col: str = "payload", from_col: str = "date_from",
                  to_col: str = "date_to") -> DataFrame:
    """The daily-series payloads that fail, with ``reason``: unreadable text,
    or a bad date or number in them, for which all of the payload is refused."""
    series = F.from_json(F.col(payload_col), _SERIES_SCHEMA).getField(SERIES_KEY)
    reason = F.when(parse_payload(payload_col).isNull(), UNREADABLE_PAYLOAD) \
        .otherwise(_series_fault(series, F.col(from_col), F.col(to_col)))
    return payloads.withColumn("reason", reason).filter(F.col("reason").isNotNull())


_SERIES_BARS = "array<struct<price_date: date, open: decimal(18,6), high: decimal(18,6), low: decimal(18,6), close: decimal(18,6), volume: bigint>>"


def _series_bars(payload: Column, lo: Column, hi: Column) -> Column:
    """The bars of a daily series inside [lo, hi]; NULL where there are none, or the
    payload fails (``series_faults``).  One expression in which each value is bound once:
    the text is read once, each day parsed once, and whether the payload as a whole is
    good is looked at where it has a bar to give."""
    days = F.transform(F.map_entries(F.from_json(payload, _SERIES_SCHEMA).getField(SERIES_KEY)), lambda e: F.struct(
        F.call_function("try_to_date", e["key"], F.lit("yyyy-M-d")).alias("d"), e["value"].alias("v")))

    def broken(e):
        vals = [e["v"].getField(f) for f in SERIES_FIELDS]
        return reduce(lambda a, b: a | b, [F.coalesce((v != "") & py_strip(v).try_cast("double").isNull(), F.lit(False)) for v in vals])

    def num(e, f, t):
        x = e["v"].getField(f)
        return F.when(x != "", x.try_cast("double").cast(t) if t == "bigint" else x.try_cast(t))

    def bar(e):
        types = dict.fromkeys(SERIES_FIELDS, "decimal(18,6)") | {SERIES_FIELDS[-1]: "bigint"}
        return F.struct(e["d"].alias("price_date"), *[num(e, f, t).alias(f[3:]) for f, t in types.items()])

    def given(all_days, inside):
        good = (F.size(inside) > 0) & ~F.exists(all_days, lambda e: e["d"].isNull()) & ~F.exists(inside, broken)
        return F.when(good & parse_payload(payload).isNotNull(), F.transform(inside, bar))
    return _let(days, lambda x: _let(F.filter(x, lambda e: e["d"].between(lo, hi)), lambda y: given(x, y))).cast(_SERIES_BARS)


def series_bars(payloads: DataFrame, *, payload_col: str = "payload", from_col: str = "date_from", to_col: str = "date_to") -> DataFrame:
    """Daily-series payloads with their ``bars`` in place of the text, for a load that
    needs more of a response than its bars."""
    bars = _series_bars(F.col(payload_col), F.col(from_col), F.col(to_col)).alias("bars")
    return payloads.select(*[c for c in payloads.columns if c not in (payload_col, from_col, to_col)], bars)


def daily_series_flatten(payloads: DataFrame, *, symbol_col: str = "symbol", payload_col: str = "payload",
                         from_col: str = "date_from", to_col: str = "date_to",
                         source: str = "alphavantage") -> DataFrame:
    """OHLCV rows of daily-series payloads inside [from, to]; '' or missing
    -> NULL; volume truncated from a float.  Payloads that fail
    (``series_faults``) give no rows.  Payloads may come read, as ``series_bars``."""
    p = payloads if payload_col not in payloads.columns else series_bars(payloads, payload_col=payload_col, from_col=from_col, to_col=to_col)
    # an outer generator: no filter is inferred from it, to be evaluated below once more
    e = p.select(F.col(symbol_col).alias("symbol"), F.inline_outer("bars")).filter(F.col("price_date").isNotNull())
    return e.select(F.lit(source).alias("source"), "symbol", "price_date", "open", "high", "low", "close", "volume")


def bars_normalise(bars: DataFrame, *, symbol_col: str = "symbol", date_col: str = "date",
                   from_col: str = "date_from", to_col: str = "date_to", source: str = "yahoo") -> DataFrame:
    """Vendor bar frames -> OHLCV rows: column names stripped/lower-cased,
    missing columns tolerated (all four price columns missing -> no rows),
    NaN -> NULL, rows whose four prices are all missing dropped."""
    renamed = bars.toDF(*[c.strip().lower() for c in bars.columns])
    have = set(renamed.columns)
    sym, dcol, fc, tc = (x.strip().lower() for x in (symbol_col, date_col, from_col, to_col))

    def val(c):
        if c not in have:
            return F.lit(None).cast("double")
        x = F.col(c).cast("double")
        return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)
    o, h, lo, cl, vol = (val(c) for c in ("open", "high", "low", "close", "volume"))
    out = renamed.select(F.col(sym).alias("symbol"), F.to_date(F.col(dcol)).alias("price_date"),
                         F.col(fc).alias("_from"), F.col(tc).alias("_to"),
                         o.alias("o"), h.alias("h"), lo.alias("l"), cl.alias("c"), vol.alias("v"))
    if not ({"open", "high", "low", "close"} & have):
        out = out.filter(F.lit(False))
    out = out.filter(F.col("price_date").between(F.col("_from"), F.col("_to"))
                     & F.coalesce("o", "h", "l", "c").isNotNull())
    return out.select(F.lit(source).alias("source"), "symbol", "price_date",
                      *[F.col(x).cast("decimal(18,6)").alias(n) for x, n in
                        (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"))],
                      F.col("v").cast("bigint").alias("volume"))


# ---- I08 / I09 / I10 / I18 profiles ------------------------------------------
def _call_failed(payloads: DataFrame, payload_col: str, error_col: str) -> Column:
    """A request that gave no document: an error was landed for it, or a text that is none."""
    broken = F.col("body").isNull()
    return broken if error_col not in payloads.columns else broken | F.col("_error").isNotNull()


def profiles_finnhub(payloads: DataFrame, *, symbol_col: str = "symbol", payload_col: str = "payload",
                     error_col: str = "error") -> DataFrame:
    """Keeps non-empty object payloads with a truthy ``ticker``; adds
    source='finnhub' and symbol=ticker, to ``record`` (the payload as JSON)
    too; ``outcome`` is upserted, empty or failed (an error, or no JSON)."""
    error = [F.col(error_col).alias("_error")] if error_col in payloads.columns else []
    p = payloads.select(parse_payload(payload_col).alias("body"), *error)
    failed = _call_failed(payloads, payload_col, error_col)
    p = _stage(p, _t=vfield(F.col("body"), "ticker"))
    ok = F.coalesce(~failed & vtype(F.col("body")).startswith("OBJECT") & py_truthy(F.col("body")) & py_truthy(F.col("_t")), F.lit(False))
    own = F.map_filter(F.col("body").try_cast("map<string,variant>"), lambda k, _: ~k.isin("source", "symbol"))
    added = F.create_map(F.lit("source"), F.lit("finnhub").cast("variant"), F.lit("symbol"), F.col("_t"))
    return p.select(F.lit("finnhub").cast("variant").alias("source"), F.when(ok, F.col("_t")).alias("symbol"),
                    "body", F.when(ok, F.to_json(F.map_concat(own, added))).alias("record"),
                    F.when(failed, "failed").when(ok, "upserted").otherwise("empty").alias("outcome"))


def profiles_yahoo(payloads: DataFrame, *, symbol_col: str = "symbol", payload_col: str = "payload",
                   error_col: str = "error") -> DataFrame:
    """Maps an info payload to the profile record; ``outcome`` is upserted,
    failed (an error, or no JSON), or empty: an empty payload, or one with
    neither industry, sector nor name."""
    keys = {"name": ("longName", "shortName", "displayName"), "exchange": ("exchange", "fullExchangeName"),
            "country": ("country",), "industry": ("industry",), "sector": ("sector",),
            "currency": ("currency",), "weburl": ("website",)}
    error = [F.col(error_col).alias("_error")] if error_col in payloads.columns else []
    p = payloads.select(F.col(symbol_col).alias("_sym"), parse_payload(payload_col).alias("body"), *error)
    failed = _call_failed(payloads, payload_col, error_col)
    raw = sorted({k for ks in keys.values() for k in ks} | {"marketCap"})
    p = _stage(p, **{f"_r_{k}": vfield(F.col("body"), k) for k in raw})
    p = _stage(p, **{f"_o_{n}": py_or(*[F.col(f"_r_{k}") for k in ks]) for n, ks in keys.items()})
    p = _stage(p, **{n: clean_text(F.col(f"_o_{n}"), CLEAN_TOKENS_PROFILE) for n in keys})
    useful = py_truthy(F.col("body")) & (F.col("industry").isNotNull() | F.col("sector").isNotNull()
                                        | F.col("name").isNotNull())
    cols = [F.lit("yahoo").cast("variant").alias("source"), F.col("_sym").cast("variant").alias("symbol")]
    cols += [F.col(n).cast("variant").alias(n) for n in keys]
    cols += [clean_number(F.col("_r_marketCap"), CLEAN_TOKENS_PROFILE).cast("variant").alias("market_cap"),
             _null_variant().alias("logo")]
    rec = p.select(*cols, "body", F.when(failed, "failed").when(useful, "upserted").otherwise("empty").alias("outcome"))
    fields = ["source", "symbol", *keys, "market_cap", "logo"]
    return rec.withColumn("record", F.to_json(F.struct(*fields, F.col("body").alias("raw_json")),
                                              {"ignoreNullFields": "false"}))


def profiles_conform(records: DataFrame, target_columns: list[str] | None = None,
                     batch_ts: dt.datetime | None = None) -> DataFrame:
    """I10: record -> profile row.  A field is the record's own column when
    present, else the payload's key; strings cleaned (null tokens), numbers
    cleaned; aliases as ``a or b``; rows without source or symbol dropped;
    only the target's columns kept; ``raw_json`` is the record, or without
    one the payload."""
    have = set(records.columns)
    body = F.col("body") if "body" in have else _null_variant()
    fields = ("source", "symbol", "ticker", "name", "exchange", "country", "ipo", "currency", "market_cap",
              "marketCapitalization", "industry", "finnhubIndustry", "sector", "weburl", "logo")
    p = records.select(*[(F.col(k).cast("variant") if k in have else vfield(body, k)).alias(f"_f_{k}")
                         for k in fields], (F.col("record") if "record" in have else F.to_json(body)).alias("_body"))
    f = {k: F.col(f"_f_{k}") for k in fields}
    p = _stage(p, _symbol=py_or(f["symbol"], f["ticker"]), _mcap=py_or(f["market_cap"], f["marketCapitalization"]),
               _industry=py_or(f["industry"], f["finnhubIndustry"]))
    rec = {
        "source": clean_text(f["source"]), "symbol": clean_text(F.col("_symbol")),
        "name": clean_text(f["name"]), "exchange": clean_text(f["exchange"]),
        "country": clean_text(f["country"]), "ipo": clean_text(f["ipo"]), "currency": clean_text(f["currency"]),
        "market_cap": clean_number(F.col("_mcap")), "industry": clean_text(F.col("_industry")),
        "sector": clean_text(f["sector"]), "weburl": clean_text(f["weburl"]), "logo": clean_text(f["logo"]),
        "raw_json": F.col("_body")}
    keep = [k for k in PROFILE_COLUMNS if target_columns is None or k in target_columns]
    out = p.select(*[rec[k].alias(k) for k in keep], ts_lit(batch_ts).alias("ingested_at"))
    return out.filter(F.col("source").isNotNull() & F.col("symbol").isNotNull())


def profile_source_default(profiles: DataFrame, default: str = "finnhub") -> DataFrame:
    """I18: source defaults to 'finnhub' where NULL."""
    return profiles.withColumn("source", F.coalesce(F.col("source"), F.lit(default)))


# ---- I11 / I12 keyed writes --------------------------------------------------
def symbol_map_rows(rows: DataFrame, *, vendor: str, batch_ts: dt.datetime | None = None) -> DataFrame:
    """I11 batch rows: is_priceable defaults to true when the field is absent
    (a present NULL is false), last_checked_at = batch time."""
    pr = (F.coalesce(F.col("is_priceable").cast("boolean"), F.lit(False)) if "is_priceable" in rows.columns
          else F.lit(True))
    notes = F.col("notes") if "notes" in rows.columns else F.lit(None).cast("string")
    return rows.select(F.lit(vendor).alias("vendor"), "ipo_symbol", "vendor_symbol", pr.alias("is_priceable"),
                       notes.alias("notes"), ts_lit(batch_ts).alias("last_checked_at"))


def price_rows(rows: DataFrame, *, batch_ts: dt.datetime | Column | None = None) -> DataFrame:
    """I12 batch rows: source defaults to 'unknown'; raw_row keeps the input
    row as JSON, nulls included, with the day under ``date``; ingested_at =
    batch time (a column where rows were landed at different times)."""
    src = F.coalesce(F.col("source"), F.lit("unknown")) if "source" in rows.columns else F.lit("unknown")
    cols = [c for c in ("source", "symbol", "price_date", "open", "high", "low", "close", "volume")
            if c in rows.columns]
    return rows.select(src.alias("source"), "symbol", "price_date",
                       *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in
                         (("open", "decimal(18,6)"), ("high", "decimal(18,6)"), ("low", "decimal(18,6)"),
                          ("close", "decimal(18,6)"), ("volume", "bigint"))],
                       F.to_json(F.struct(*[F.col(c).alias("date" if c == "price_date" else c) for c in cols]),
                                 {"ignoreNullFields": "false"}).alias("raw_row"),
                       (batch_ts if isinstance(batch_ts, Column) else ts_lit(batch_ts)).alias("ingested_at"),
                       F.date_format("price_date", "yyyy-MM").alias("price_month"))


# ---- I13-I16 symbol resolution -----------------------------------------------
def resolve_first_or_exact(requests: DataFrame, *, symbol_col: str = "symbol", payload_col: str = "payload"
                           ) -> DataFrame:
    """Per requested symbol: the case-insensitive exact match, else the first
    candidate, else none (not priceable).  A rate-limited, missing or
    unreadable payload is a resolve error.  One row per request."""
    p = requests.select(F.col(symbol_col).alias("sym"), parse_payload(payload_col).alias("_v"))
    p = _stage(p, _n=vfield(F.col("_v"), "Note"), _bm=vfield(F.col("_v"), "bestMatches"))
    unread = F.col("_v").isNull()
    base = p.select("sym", (unread | F.col("_n").isNotNull()).alias("_err"),
                    F.when(unread, F.lit(UNREADABLE_PAYLOAD))
                    .otherwise(F.concat(F.lit(RATE_LIMIT_PREFIX), F.coalesce(py_str(F.col("_n")), F.lit("None")))).alias("_note"),
                    py_or(F.col("_bm"), _empty_list()).try_cast("array<variant>").alias("_m"))
    ex = base.select("sym", "_err", "_note", F.posexplode_outer("_m").alias("pos", "m"))
    ex = _stage(ex, _ms=py_str(vfield(F.col("m"), "1. symbol")))
    msym = F.col("_ms")
    exact = F.upper(F.coalesce(msym, F.lit(""))) == F.upper(F.col("sym"))
    w = Window.partitionBy("sym").orderBy(F.when(exact, 0).otherwise(1), F.col("pos").asc_nulls_last())
    pick = ex.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    has = F.col("m").isNotNull()
    vs = F.upper(F.coalesce(F.when(msym != "", msym), F.col("sym")))
    note_txt = F.concat(F.lit("match="), vs, F.lit(" name="),
                        F.coalesce(py_str(vfield(F.col("m"), "2. name")), F.lit("None")),
                        F.lit(" region="), F.coalesce(py_str(vfield(F.col("m"), "4. region")), F.lit("None")))
    err = F.col("_err")
    return pick.select(
        F.upper("sym").alias("ipo_symbol"),
        F.when(err | ~has, F.upper("sym")).otherwise(vs).alias("vendor_symbol"),
        (~err & has).alias("is_priceable"),
        F.when(err, F.concat(F.lit("resolve_error: "), F.col("_note")))
         .when(~has, F.lit(NO_MATCH_NOTE)).otherwise(note_txt).alias("notes"))


def clean_symbol(c: Column) -> Column:
    return F.upper(py_strip(F.coalesce(c, F.lit(""))))


def looks_like_us_equity(c: Column) -> Column:
    s = clean_symbol(c)
    bad = reduce(lambda a, b: a | b, [s.contains(x) for x in DISALLOWED_SUBSTRINGS])
    ending = reduce(lambda a, b: a | b, [s.endswith(x) for x in DISALLOWED_ENDINGS])
    return ((s != "") & ~bad & s.rlike("^[\\p{L}\\p{N}]{1,5}\\z") & ~((F.length(s) >= 2) & ending))


def resolve_ranked_exact(requests: DataFrame, *, symbol_col: str = "symbol", payload_col: str = "payload"
                         ) -> DataFrame:
    """Per requested symbol: accepted only when the best-ranked good
    candidate (quote type, US exchange, symbol shape; ranked exact, US,
    EQUITY, shorter) equals the request, which is the same as "a good
    candidate equals the request".  ``resolved`` is NULL otherwise."""
    sym = clean_symbol(F.col(symbol_col))
    p = requests.select(sym.alias("sym"), looks_like_us_equity(F.col(symbol_col)).alias("_shape"),
                        vfield(parse_payload(payload_col), "quotes").alias("_qv"))
    base = p.select("sym", "_shape", py_or(F.col("_qv"), _empty_list()).try_cast("array<variant>").alias("_q"))
    q = base.filter("_shape").select("sym", F.explode("_q").alias("q"))
    q = _stage(q, **{f"_{k}": clean_symbol(py_str(vfield(F.col("q"), k))) for k in ("symbol", "exchange", "quoteType")})
    cs, ce, ct = F.col("_symbol"), F.col("_exchange"), F.col("_quoteType")
    good = (cs != "") & ct.isin(*QUOTE_TYPES) & ce.isin(*US_EXCHANGES) & looks_like_us_equity(cs)
    cand = (q.filter(good & (cs == F.col("sym"))).select("sym").distinct().withColumn("_ok", F.lit(True)))
    return (base.select("sym").distinct().join(cand, "sym", "left")
            .select(F.col("sym").alias("ipo_symbol"), F.when(F.col("_ok"), F.col("sym")).alias("resolved")))


def history_check(candidates: DataFrame, prices: DataFrame | None, *, as_of: dt.date, lookback_days: int = 30,
                  source: str = "yahoo", symbol_col: str = "resolved", days: DataFrame | None = None) -> DataFrame:
    """I15: ``has_history`` = the vendor has a bar for the symbol in the last
    ``lookback_days`` (set-based semi join, not one call per symbol), from the
    price table or, where given, from its ``days`` (``price_days``)."""
    if days is not None:
        symbols = with_history(days, source, as_of, lookback_days)
    else:
        symbols = (price_date_range(prices, as_of - dt.timedelta(days=lookback_days), as_of)
                   .filter(F.col("source") == source).select("symbol").distinct())
    recent = symbols.select(F.col("symbol").alias("_hs"), F.lit(True).alias("has_history"))
    out = candidates.join(recent, candidates[symbol_col] == recent["_hs"], "left").drop("_hs")
    return out.withColumn("has_history", F.coalesce(F.col("has_history"), F.lit(False)))


def yahoo_map_rows(requests: DataFrame, resolved: DataFrame, *, error_col: str = "error",
                   symbol_col: str = "symbol", error_chars: int | None = None) -> DataFrame:
    """I16: mapping rows from resolution + history: priceable only with an
    exact match that has history; failed requests keep the error text (its
    first ``error_chars`` characters, if given)."""
    req = requests.select(clean_symbol(F.col(symbol_col)).alias("ipo_symbol"),
                          F.col(error_col).alias("_e") if error_col in requests.columns
                          else F.lit(None).cast("string").alias("_e"))
    r = resolved.select(F.col("ipo_symbol").alias("_r"), "resolved", "has_history")
    j = req.join(r, req["ipo_symbol"] == r["_r"], "left")
    err, res, hist = F.col("_e").isNotNull(), F.col("resolved"), F.col("has_history")
    vendor = F.when(err | res.isNull(), F.col("ipo_symbol")).otherwise(res)
    priceable = ~err & res.isNotNull() & F.coalesce(hist, F.lit(False))
    notes = (F.when(err, F.concat(F.lit(YAHOO_NOTES["error"]), F.col("_e") if error_chars is None else F.substring("_e", 1, error_chars)))
             .when(res.isNull(), F.lit(YAHOO_NOTES["no_match"]))
             .when(priceable, F.lit(YAHOO_NOTES["match"])).otherwise(F.lit(YAHOO_NOTES["no_history"])))
    rows = j.select("ipo_symbol", clean_symbol(vendor).alias("vendor_symbol"), priceable.alias("is_priceable"),
                    notes.alias("notes")).filter(F.col("ipo_symbol") != "")
    empty_vendor = F.col("vendor_symbol") == ""
    return rows.select("ipo_symbol",
                       F.when(empty_vendor, F.col("ipo_symbol")).otherwise(F.col("vendor_symbol")).alias("vendor_symbol"),
                       F.when(empty_vendor, F.lit(False)).otherwise(F.col("is_priceable")).alias("is_priceable"),
                       F.when(empty_vendor & (F.coalesce(F.col("notes"), F.lit("")) == ""),
                              F.lit(YAHOO_NOTES["no_match"])).otherwise(F.col("notes")).alias("notes"))


def map_counters() -> dict[str, Column]:
    """I16: attempted / priceable / not_priceable of mapping rows, for an ``agg`` or an
    ``observe`` on what is written."""
    return {"attempted": F.count(F.lit(1)), "priceable": F.count_if("is_priceable"),
            "not_priceable": F.count_if(~F.col("is_priceable"))}
