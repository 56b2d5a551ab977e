"""Registered queries: ``key -> (spark, sf_dir) -> DataFrame`` and the matching
DuckDB oracle SQL.  Every query derives the raw tables from the given test
tables (so its work grows with them) and runs on all of them.

Output convention (shared with the oracle): decimals are returned as DOUBLE
and timestamps as 'yyyy-MM-dd HH:mm:ss' strings."""

from __future__ import annotations

import datetime as dt
import re
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.config import DEFAULT_PARAMS, RETURN_FILTER_RANGE
from evwin.functions.exprs import price_date_range
from evwin.operators.price_days import high_water_marks
from evwin.plans import models as M
from evwin.plans import oracle as O
from evwin.sources.payloads import failed_series
from evwin.sources.raw import store_root, stored_raw_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FINAL_SQL: dict[str, str] = {}   # oracle statements without the fixture CTEs


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = lambda spark, sf_dir: finalize(fn(graph(spark, sf_dir)))
        if sql is not None:
            ORACLE[key] = O.with_ctes(sql)
            FINAL_SQL[key] = sql
        return fn
    return deco


_GRAPHS: dict = {}


def graph(spark: SparkSession, sf_dir: str) -> M.ModelGraph:
    """The model graph of a folder over its stored raw tables (derived from the
    test tables once, see ``sources.raw``).  A query takes it once, as its one
    view of the store, and hands it to whatever it is made of; the input's files
    are listed then, and tables are opened only for a store not met before."""
    root = store_root(spark, sf_dir, DEFAULT_PARAMS.as_of)
    key = (spark.sparkContext.applicationId, root)
    if key not in _GRAPHS:
        # listings (M04, one row per recent listing) is the shared dimension of
        # every mart: written once, as SURVEY §4 plans; the price-side work
        # (precedence, window join, aggregation) stays in each query.
        raw = stored_raw_tables(spark, sf_dir, DEFAULT_PARAMS.as_of, root)
        _GRAPHS[key] = M.ModelGraph(raw, DEFAULT_PARAMS, materialize=("listings", "price_days"))
    return _GRAPHS[key]


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c.split('.')[-1]}"


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}"


# ---------------------------------------------------------------- models ----
@register("view_ipos", f"""SELECT ipo_date, symbol, company_name, exchange, {dbl('price_range_low')},
  {dbl('price_range_high')}, shares FROM raw_events""")
def _m01(g):
    return M.view_ipos(g.raw.ipo_events)


@register("view_prices", f"""SELECT symbol, price_date, {dbl('open')}, {dbl('high')}, {dbl('low')},
  {dbl('close')}, volume FROM raw_prices""")
def _m02(g):
    return M.view_prices(g.raw.daily_prices)


@register("listings_valid", f"""SELECT event_id, ipo_date, symbol, company_name, exchange,
  {dbl('price_range_low')}, {dbl('price_range_high')}, shares, {ts('ingested_at')}
FROM raw_events WHERE symbol IS NOT NULL AND symbol <> '' AND regexp_full_match(symbol, '[A-Z]{{1,5}}')
  AND ipo_date IS NOT NULL""")
def _m03(g):
    return M.listings_valid(g.raw.ipo_events)


_LISTING_COLS = ("event_id, ipo_date, ipo_symbol, company_name, exchange, price_vendor, price_symbol, "
                 "is_priceable, profile_source, industry, sector, country, currency, market_cap, weburl")


@register("listings_recent", f"SELECT {_LISTING_COLS} FROM m_listings")
def _m04(g):
    return g.listings


@register("preferred_symbol_map", f"""SELECT ipo_symbol, vendor, vendor_symbol, is_priceable, notes,
  {ts('last_checked_at')} FROM m_map""")
def _m04a(g):
    return M.preferred_symbol_map(g.raw.symbol_map)


@register("preferred_profile", """SELECT symbol, source, industry, sector, country, currency, market_cap,
  weburl FROM m_prof""")
def _m04b(g):
    return M.preferred_profile(g.raw.company_profiles)


@register("preferred_prices", f"""SELECT source, symbol, price_date, {dbl('open')}, {dbl('high')},
  {dbl('low')}, {dbl('close')}, volume FROM m_pref""")
def _m05a(g):
    return M.preferred_prices(g.raw.daily_prices)


_WIN_SQL = (f"SELECT event_id, ipo_symbol, ipo_date, price_symbol, price_source, price_date, {dbl('open')}, "
            f"{dbl('high')}, {dbl('low')}, {dbl('close')}, volume, day_num FROM ")


@register("window_prices_100d", _WIN_SQL + "m_win_long")
def _m05(g):
    return g.window_long


@register("window_prices_30d", _WIN_SQL + "m_win_short")
def _m06(g):
    return g.window_short


@register("dim_industry", """SELECT DISTINCT coalesce(nullif(trim(industry), ''), 'Not available') AS industry,
  coalesce(nullif(trim(sector), ''), 'Not available') AS sector FROM m_listings""")
def _m07(g):
    return g.dim_industry


@register("coverage_100d", """SELECT event_id, ipo_date, ipo_symbol, company_name, exchange, industry, sector,
  price_vendor, price_symbol, is_priceable, price_rows, distinct_price_days, first_price_date, last_price_date,
  coverage_status, is_analysis_ready FROM m_coverage""")
def _m08(g):
    return g.coverage


@register("coverage_summary_100d", f"""SELECT coverage_status, count(*) AS ipo_count,
  count(*) FILTER (WHERE industry IS NOT NULL) AS with_industry,
  count(*) FILTER (WHERE sector IS NOT NULL) AS with_sector,
  {O.rdiv('CAST(sum(distinct_price_days) AS HUGEINT)', 'count(distinct_price_days)', 2)} AS avg_price_days
FROM m_coverage GROUP BY coverage_status""")
def _m09(g):
    return g.coverage_summary


@register("metrics_100d", f"""SELECT event_id, ipo_date, ipo_symbol, company_name, exchange, industry, sector,
  price_vendor, price_symbol, coverage_status, is_analysis_ready, n_days, {dbl('first_close')},
  {dbl('last_close')}, {dbl('min_close')}, {dbl('max_close')}, return_100d, max_gain_100d, max_drawdown_100d
FROM m_metrics_long""")
def _m10(g):
    return g.metrics_long


@register("benchmarks_100d", "SELECT * FROM m_bench_long")
def _m11(g):
    return g.benchmarks_long


_M30_SQL = (f"SELECT event_id, ipo_date, ipo_symbol, price_symbol, industry, sector, price_days, "
            f"first_price_date, last_price_date, {dbl('first_close_30d')}, {dbl('last_close_30d')}, "
            f"avg_close_30d, {dbl('min_close_30d')}, {dbl('max_close_30d')}, return_30d_pct, "
            f"coverage_status_30d FROM m_metrics_30")


@register("metrics_30d", _M30_SQL)
def _m12(g):
    return g.metrics_short


@register("coverage_summary_30d", "SELECT * FROM m_cov_summary_30")
def _m13(g):
    return g.coverage_summary_short


@register("benchmarks_30d", "SELECT * FROM m_bench_30")
def _m14(g):
    return g.benchmarks_short


# -------------------------------------------------------------- worklists ---
from evwin.operators import worklist as W  # noqa: E402

_P = DEFAULT_PARAMS
_WL = dict(as_of=_P.as_of, recent_days=_P.worklist_recent_days)
_LOAD_LO = _P.as_of - dt.timedelta(days=_P.worklist_recent_days)   # no window of a worklist starts earlier
_RECENT_SQL = O._d(_LOAD_LO)


def _raw(g):
    return g.raw


@register("recent_equity_symbols", "SELECT symbol FROM w_recent")
def _w01(g):
    return W.recent_equity_symbols(_raw(g).ipo_events, **_WL)


@register("symbols_missing_profile", f"""SELECT s.symbol FROM w_recent s
LEFT JOIN (SELECT symbol, max(nullif(industry, '')) AS ia, max(nullif(sector, '')) AS sa FROM raw_profiles
           WHERE source IN ('finnhub', 'yahoo') GROUP BY symbol) p ON p.symbol = s.symbol
WHERE p.symbol IS NULL OR (p.ia IS NULL AND p.sa IS NULL)
""")
def _w02(g):
    r = _raw(g)
    return W.symbols_missing_profile(r.ipo_events, r.company_profiles, limit=_P.profile_limit, **_WL)


def _unres_sql(v):
    return f"""(SELECT '{v}' AS vendor, symbol FROM w_recent s
  WHERE NOT EXISTS (SELECT 1 FROM raw_map m WHERE m.vendor = '{v}' AND m.ipo_symbol = s.symbol)
)"""


@register("unresolved_symbols", "SELECT * FROM " + _unres_sql("alphavantage")
          + " UNION ALL SELECT * FROM " + _unres_sql("yahoo"))
def _w03(g):
    r = _raw(g)
    out = None
    for v in ("alphavantage", "yahoo"):
        x = W.unresolved_symbols(r.ipo_events, r.symbol_map, vendor=v, limit=_P.resolve_limit, **_WL) \
            .select(F.lit(v).alias("vendor"), "symbol")
        out = x if out is None else out.unionByName(x)
    return out


def _pairs_sql(v):
    return f"(SELECT '{v}' AS vendor, * FROM w_pairs_{v})"


@register("priceable_pairs", "SELECT * FROM " + _pairs_sql("yahoo")
          + " UNION ALL SELECT * FROM " + _pairs_sql("alphavantage"))
def _w04(g):
    r = _raw(g)
    out = None
    for v in ("yahoo", "alphavantage"):
        x = W.priceable_pairs(r.ipo_events, r.symbol_map, vendor=v, limit=_P.price_pair_limit, **_WL) \
            .select(F.lit(v).alias("vendor"), "*")
        out = x if out is None else out.unionByName(x)
    return out


@register("symbols_with_profile", f"""SELECT DISTINCT upper(e.symbol) AS symbol FROM raw_events e
JOIN raw_profiles p ON p.symbol = upper(e.symbol)
WHERE e.ipo_date >= {_RECENT_SQL} AND {O._EQ.format(s='e.symbol')} AND p.source IN ('finnhub', 'yahoo')""")
def _w05(g):
    r = _raw(g)
    return W.symbols_with_profile(r.ipo_events, r.company_profiles, **_WL)


_BACKFILL_SQL = f"""SELECT event_id, ipo_symbol, price_symbol, price_vendor, ipo_date, coverage_status,
  coalesce(distinct_price_days, 0) AS distinct_price_days FROM m_coverage
WHERE coverage_status IN ('mapped_but_no_prices', 'very_low_coverage', 'partial_coverage')
  AND ipo_date <= {O._d(_P.as_of)} AND ipo_date >= {_RECENT_SQL} AND price_symbol IS NOT NULL"""


@register("backfill_candidates", _BACKFILL_SQL)
def _w06(g):
    # the backfill reads the coverage mart (a table in the reference)
    return W.backfill_candidates(_mart(g, "coverage"), limit=_P.backfill_limit, **_WL)


@register("alternate_symbol", f"""SELECT b.*, m.vendor_symbol AS alt_symbol FROM ({_BACKFILL_SQL}) b
LEFT JOIN raw_map m ON m.vendor = 'alphavantage' AND m.is_priceable AND m.ipo_symbol = b.ipo_symbol""")
def _w07(g):
    return W.alternate_symbol(_w06(g), _raw(g).symbol_map)


def _existing(g):
    return price_date_range(_raw(g).daily_prices, hi=O.LOAD_CUTOFF)


def _marks(g):
    """What the store holds up to the cutoff, from the days table: no price file is read."""
    return high_water_marks(g.price_days, lo=_LOAD_LO, hi=O.LOAD_CUTOFF)


def _staged(g):
    return price_date_range(_raw(g).daily_prices, lo=_LOAD_LO, hi=_P.as_of)


def _yahoo_pairs_all(g):
    r = _raw(g)
    return W.priceable_pairs(r.ipo_events, r.symbol_map, vendor="yahoo", limit=None, **_WL)


_LW_COLS = "ipo_symbol, vendor_symbol, ipo_date, load_to, hwm, load_from, load_status, source"


@register("load_windows", f"SELECT {_LW_COLS} FROM w_load_all")
def _w08(g):
    return W.load_windows(_yahoo_pairs_all(g), None, source="yahoo", as_of=_P.as_of,
                          window_days=_P.long_window, marks=_marks(g))


@register("incremental_prices", f"""SELECT s.source, s.symbol, s.price_date, {dbl('s.open')}, {dbl('s.high')},
  {dbl('s.low')}, {dbl('s.close')}, s.volume FROM raw_prices s
WHERE EXISTS (SELECT 1 FROM w_load_all w WHERE w.load_status = 'load' AND w.source = s.source
  AND w.vendor_symbol = s.symbol AND s.price_date >= w.load_from AND s.price_date <= w.load_to)""")
def _w09(g):
    return W.incremental_prices(_w08(g), _staged(g)).select(
        "source", "symbol", "price_date", "open", "high", "low", "close", "volume")


def _outcomes(g):
    r = _raw(g)
    pw, sw = W.fallback_windows(_yahoo_pairs_all(g), None, r.symbol_map, as_of=_P.as_of, window_days=_P.long_window,
                                marks=_marks(g), failures=failed_series(r.symbol_map))
    return W.turn_outcomes(pw, sw, _staged(g), use_fallback=True)


@register("primary_with_fallback", f"""SELECT ipo_symbol, listing_symbol, ipo_date, source, symbol, price_date,
  {dbl('open')}, {dbl('high')}, {dbl('low')}, {dbl('close')}, volume FROM w_loaded""")
def _w10(g):
    return W.loaded_bars(_outcomes(g)).drop("turn")


_W11_SQL = """SELECT count(*) AS attempted, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
  count(*) FILTER (WHERE n > 0) AS with_data, count(*) FILTER (WHERE n = 0) AS no_data,
  CAST(coalesce(sum(y_fail + a_fail), 0) AS BIGINT) AS failed,
  CAST(coalesce(sum(y_used), 0) AS BIGINT) AS yahoo_used, CAST(coalesce(sum(a_used), 0) AS BIGINT) AS alpha_used
FROM w_turns"""


@register("price_run_summary", _W11_SQL)
def _w11(g):
    return W.price_run_summary(_outcomes(g))


# ---------------------------------------------------------------- serving ---
from evwin.plans import serving as D  # noqa: E402

_FEED = ("event_id, ipo_date, ipo_symbol, price_symbol, industry, sector, price_days, first_price_date, "
         "last_price_date, CAST(first_close_30d AS DOUBLE) AS first_close_30d, "
         "CAST(last_close_30d AS DOUBLE) AS last_close_30d, avg_close_30d, "
         "CAST(min_close_30d AS DOUBLE) AS min_close_30d, CAST(max_close_30d AS DOUBLE) AS max_close_30d, "
         "return_30d_pct, coverage_status_30d")
_ENR = _FEED + ", coverage_band, price_range_pct_30d"


def _mart(g, name):
    """Serving queries read the written marts (as the dashboard reads tables)."""
    return g.mart(name)


def _filtered(g):
    return g._get("filtered", lambda: D.metrics_filtered(D.metrics_enriched(_mart(g, "metrics_short"))))


@register("metrics_feed", f"SELECT {_FEED} FROM m_metrics_30")
def _d01(g):
    return D.metrics_feed(_mart(g, "metrics_short"))


@register("coverage_feed", "SELECT * FROM m_cov_summary_30")
def _d02(g):
    return D.coverage_feed(_mart(g, "coverage_summary_short"))


@register("benchmark_feed", "SELECT * FROM m_bench_30")
def _d03(g):
    return D.benchmark_feed(_mart(g, "benchmarks_short"))


@register("dates_coerced", f"SELECT {_FEED} FROM m_metrics_30")
def _d04(g):
    # the feed as the dashboard receives it: date columns as text
    feed = D.metrics_feed(_mart(g, "metrics_short"))
    for c in ("ipo_date", "first_price_date", "last_price_date"):
        feed = feed.withColumn(c, F.col(c).cast("string"))
    return D.dates_coerced(feed)


@register("metrics_enriched", f"SELECT {_ENR} FROM d_enriched")
def _d05(g):
    return D.metrics_enriched(_mart(g, "metrics_short"))


@register("filter_domains", """SELECT DISTINCT 'industry' AS domain, industry AS value, false AS is_all FROM d_enriched
UNION ALL SELECT DISTINCT 'sector', sector, false FROM d_enriched
UNION ALL SELECT 'industry', 'All', true UNION ALL SELECT 'sector', 'All', true""")
def _d06(g):
    return D.filter_domains(D.metrics_enriched(_mart(g, "metrics_short")))


@register("metrics_filtered", f"SELECT {_ENR} FROM d_filtered")
def _d07(g):
    return _filtered(g)


@register("metrics_filtered_bounded", f"""SELECT {_ENR} FROM d_filtered
WHERE return_30d_pct IS NULL OR return_30d_pct BETWEEN {RETURN_FILTER_RANGE[0]} AND {RETURN_FILTER_RANGE[1]}""")
def _d07_bounded(g):
    low, high = RETURN_FILTER_RANGE
    return D.metrics_filtered(D.metrics_enriched(_mart(g, "metrics_short")), min_return=low, max_return=high)


@register("metrics_filtered_chosen", f"""SELECT {_ENR} FROM d_filtered WHERE coverage_band = 'partial_coverage'
  AND industry = 'Unknown' AND sector = 'Unknown'""")
def _d07_chosen(g):
    return D.metrics_filtered(D.metrics_enriched(_mart(g, "metrics_short")), industry="Unknown",
                              sector="Unknown", band="partial_coverage")


@register("kpis", f"""SELECT count(*) AS ipos, count(*) FILTER (WHERE price_days >= 1) AS with_any_prices,
  count(*) FILTER (WHERE price_days >= 15) AS good_coverage,
  CASE WHEN count(*) > 0 THEN {O.rdiv('CAST(sum(price_days) AS HUGEINT)', 'count(price_days)', 2)} END AS avg_price_days,
  CASE WHEN count(ret_cents) FILTER (WHERE price_days >= 15) > 0 THEN
    {O.rdiv('CAST(sum(ret_cents) FILTER (WHERE price_days >= 15) AS HUGEINT)', 'count(ret_cents) FILTER (WHERE price_days >= 15) * 100', 2)} END AS avg_return_30d_pct,
  coalesce({O.dec2(O.rdiv('CAST(sum(price_days) AS HUGEINT)', 'count(price_days)', 2))}, 'n/a') AS avg_price_days_text,
  CASE WHEN count(ret_cents) FILTER (WHERE price_days >= 15) > 0 THEN
    {O.dec2(O.rdiv('CAST(sum(ret_cents) FILTER (WHERE price_days >= 15) AS HUGEINT)', 'count(ret_cents) FILTER (WHERE price_days >= 15) * 100', 2))} || '%'
    ELSE 'n/a' END AS avg_return_text
FROM d_filtered""")
def _d08(g):
    return D.kpis(_filtered(g))


def _summary_sql():
    avg = "avg_return_30d_pct"
    perf = (f"CASE WHEN {avg} IS NULL THEN '{D.PERF_NONE}' WHEN {avg} >= 0 THEN {O.sql_fmt(D.PERF_POS, avg=O.dec2(avg))} "
            f"ELSE {O.sql_fmt(D.PERF_NEG, avg=O.dec2(avg))} END")
    pct = lambda c: f"regexp_replace({O.dec2(c)}, '0$', '')"
    text = O.sql_fmt(D.SUMMARY_TEXT, total="total", with_any="with_any", pct_any=pct("pct_any"), good="good",
                     pct_good=pct("pct_good"), partial="partial", weak="weak", none="no_prices", perf=perf)
    return f"""SELECT *, CASE WHEN total = 0 THEN '{D.NO_ROWS_TEXT}' ELSE {text} END AS summary FROM (
  SELECT *, CASE WHEN total > 0 THEN {O.rdiv('CAST(with_any AS HUGEINT) * 100', 'total', 2)} END AS pct_any,
         CASE WHEN total > 0 THEN {O.rdiv('CAST(good AS HUGEINT) * 100', 'total', 2)} END AS pct_good FROM (
    SELECT count(*) AS total, count(*) FILTER (WHERE price_days >= 1) AS with_any,
      count(*) FILTER (WHERE price_days >= 15) AS good,
      count(*) FILTER (WHERE price_days >= 7 AND price_days < 15) AS partial,
      count(*) FILTER (WHERE price_days >= 1 AND price_days < 7) AS weak,
      count(*) FILTER (WHERE price_days = 0) AS no_prices,
      CASE WHEN count(ret_cents) FILTER (WHERE price_days >= 15) > 0 THEN
        {O.rdiv('CAST(sum(ret_cents) FILTER (WHERE price_days >= 15) AS HUGEINT)', 'count(ret_cents) FILTER (WHERE price_days >= 15) * 100', 2)} END AS avg_return_30d_pct
    FROM d_filtered))"""


@register("executive_summary", _summary_sql())
def _d09(g):
    return D.executive_summary(_filtered(g))


def _best_worst_sql():
    g = "(SELECT industry, count(*) AS ipo_count, CAST(sum(ret_cents) AS HUGEINT) AS s, count(ret_cents) AS n FROM d_strong GROUP BY industry)"
    msg = O.sql_fmt(D.INDUSTRY_TEXT, top="top_industry", top_avg=O.dec2("top_avg_return_30d_pct"), top_n="top_ipo_count",
                    bottom="bottom_industry", bottom_avg=O.dec2("bottom_avg_return_30d_pct"), bottom_n="bottom_ipo_count")
    return f"""SELECT *, CASE WHEN top_industry IS NULL THEN '{D.INDUSTRY_NONE}' ELSE {msg} END AS message FROM (
  SELECT t.industry AS top_industry, {O.rdiv('t.s', 't.n * 100', 2)} AS top_avg_return_30d_pct, t.ipo_count AS top_ipo_count,
         b.industry AS bottom_industry, {O.rdiv('b.s', 'b.n * 100', 2)} AS bottom_avg_return_30d_pct, b.ipo_count AS bottom_ipo_count
  FROM (SELECT 1 AS one) o
  LEFT JOIN (SELECT * FROM {g} ORDER BY CAST(s AS DOUBLE) / n DESC, ipo_count DESC, industry LIMIT 1) t ON true
  LEFT JOIN (SELECT * FROM {g} ORDER BY CAST(s AS DOUBLE) / n ASC, ipo_count ASC, industry DESC LIMIT 1) b ON true)"""


@register("best_worst_industry", _best_worst_sql())
def _d10(g):
    return D.best_worst_industry(_filtered(g))


@register("band_distribution", "SELECT coverage_band, count(*) AS ipo_count FROM d_filtered GROUP BY coverage_band")
def _d11(g):
    return D.band_distribution(_filtered(g))


@register("price_days_histogram", """SELECT CAST(price_days // 2 * 2 AS BIGINT) AS bin_start, count(*) AS ipo_count,
  CAST(price_days // 2 * 2 + 1 AS BIGINT) AS bin_end FROM d_filtered GROUP BY 1, 3""")
def _d12(g):
    return D.price_days_histogram(_filtered(g))


@register("top_sectors", """SELECT sector, count(*) AS ipo_count FROM d_filtered WHERE sector IS NOT NULL
GROUP BY sector ORDER BY ipo_count DESC, sector LIMIT 15""")
def _d13(g):
    return D.top_sectors(_filtered(g))


_RANK = "ipo_symbol, industry, sector, price_days, return_30d_pct, price_range_pct_30d"


@register("top_returns", f"SELECT {_RANK} FROM d_strong ORDER BY return_30d_pct DESC, ipo_symbol, event_id LIMIT 10")
def _d14(g):
    return D.top_returns(_filtered(g))


@register("bottom_returns", f"SELECT {_RANK} FROM d_strong ORDER BY return_30d_pct ASC, ipo_symbol, event_id LIMIT 10")
def _d15(g):
    return D.bottom_returns(_filtered(g))


@register("return_ranking", "SELECT ipo_symbol, return_30d_pct, industry, sector, price_days FROM d_filtered WHERE price_days >= 15")
def _d16(g):
    return D.return_ranking(_filtered(g))


@register("return_vs_coverage", "SELECT price_days, return_30d_pct, industry, ipo_symbol, sector FROM d_strong")
def _d17(g):
    return D.return_vs_coverage(_filtered(g))


@register("top_ranges", """SELECT ipo_symbol, price_range_pct_30d, industry, sector, return_30d_pct FROM d_filtered
WHERE price_days >= 15 AND price_range_pct_30d IS NOT NULL ORDER BY price_range_pct_30d DESC, ipo_symbol, event_id LIMIT 15""")
def _d18(g):
    return D.top_ranges(_filtered(g))


@register("benchmarks_by_return", "SELECT * FROM m_bench_30")
def _d19(g):
    return D.benchmarks_by_return(_mart(g, "benchmarks_short"))


@register("industry_scale", "SELECT ipo_count, avg_return_30d_pct, avg_price_days, industry FROM m_bench_30")
def _d20(g):
    return D.industry_scale(_mart(g, "benchmarks_short"))


_SECTOR_SQL = """SELECT industry, sector, count(*) AS ipo_count,
  CAST(sum(ret_cents) AS DOUBLE) / 100 / count(*) AS avg_return_30d_pct,
  CAST(quantile_disc(CAST(ret_cents AS BIGINT), 0.5) - quantile_disc(-CAST(ret_cents AS BIGINT), 0.5) AS DOUBLE) / 200 AS median_return_30d_pct,
  CAST(sum(price_days) AS DOUBLE) / count(price_days) AS avg_price_days
FROM d_strong GROUP BY industry, sector"""


@register("sector_scan", _SECTOR_SQL)
def _d21(g):
    return D.sector_scan(_filtered(g))


@register("sector_scan_approx", _SECTOR_SQL)
def _d21b(g):
    """By quantile summaries; the same values while groups are small beside the accuracy."""
    return D.sector_scan(_filtered(g), accuracy=10_000)


def _detail_sql():
    parts = []
    for i, (label, c) in enumerate(D.DETAIL_FIELDS):
        if c in ("avg_close_30d", "price_range_pct_30d"):
            v = f"CAST(CAST(round({c}, 6) AS DECIMAL(38,6)) AS VARCHAR)"
        else:
            v = f"CAST({c} AS VARCHAR)"
        parts.append(f"SELECT ipo_symbol, {i} AS pos, '{label}' AS field, {v} AS value FROM d_newest")
    return ("SELECT * FROM (WITH d_newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ipo_symbol "
            "ORDER BY ipo_date DESC, event_id) AS rn FROM d_filtered) WHERE rn = 1)\n"
            + "\nUNION ALL ".join(parts) + ")")


@register("listing_detail", _detail_sql())
def _d22(g):
    return D.listing_detail(_filtered(g))


def _verdict_sql():
    r, dd, s = "return_30d_pct", "price_days", "ipo_symbol"
    strong = f"({dd} >= 15 AND {r} IS NOT NULL)"
    return f"""SELECT event_id, ipo_symbol,
  CASE WHEN {strong} AND {r} > 0 THEN 'positive' WHEN {strong} THEN 'negative' WHEN {dd} >= 7 THEN 'partial'
       WHEN {dd} >= 1 THEN 'minimal' ELSE 'none' END AS verdict,
  CASE WHEN {strong} AND {r} > 0 THEN {O.sql_fmt(D.VERDICT_POS, sym=s, ret=O.dec2(r))}
       WHEN {strong} THEN {O.sql_fmt(D.VERDICT_NEG, sym=s, ret=O.dec2(r))}
       WHEN {dd} >= 7 THEN {O.sql_fmt(D.VERDICT_PARTIAL, sym=s, days=dd)}
       WHEN {dd} >= 1 THEN {O.sql_fmt(D.VERDICT_MINIMAL, sym=s, days=dd)}
       ELSE {O.sql_fmt(D.VERDICT_NONE, sym=s)} END AS message
FROM d_filtered"""


@register("listing_symbols", "SELECT DISTINCT ipo_symbol FROM d_filtered WHERE ipo_symbol IS NOT NULL")
def _d22b(g):
    return D.listing_symbols(_filtered(g))


@register("listing_verdict", _verdict_sql())
def _d23(g):
    return D.listing_verdict(_filtered(g))


@register("listing_table", """SELECT ipo_date, ipo_symbol, price_symbol, industry, sector, price_days, coverage_band,
  CAST(first_close_30d AS DOUBLE) AS first_close_30d, CAST(last_close_30d AS DOUBLE) AS last_close_30d,
  return_30d_pct, price_range_pct_30d FROM d_filtered""")
def _d24(g):
    return D.listing_table(_filtered(g))


# ---------------------------------------------------------------- quality ---
from evwin.plans import quality as Q  # noqa: E402
from evwin.sources.schemas import KEYS  # noqa: E402

_MODEL_SRC = {"listings_recent": "m_listings", "window_prices_30d": "m_win_short", "metrics_30d": "m_metrics_30",
              "coverage_summary_30d": "m_cov_summary_30", "benchmarks_30d": "m_bench_30"}


def _status_sql(inner: str) -> str:
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END "
            f"AS status FROM ({inner})")


def _not_null_sql() -> str:
    parts = []
    for m, tests in Q.NOT_NULL_TESTS.items():
        for c, sev in tests:
            parts.append(f"SELECT '{m}' AS model, '{c}' AS column, 'not_null' AS test, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures, '{sev}' AS severity "
                         f"FROM {_MODEL_SRC[m]}")
    return _status_sql(" UNION ALL ".join(parts))


def _unique_sql() -> str:
    parts = []
    for m, cols in Q.UNIQUE_TESTS.items():
        for c in cols:
            parts.append(f"SELECT '{m}' AS model, '{c}' AS column, 'unique' AS test, CAST(count(*) AS BIGINT) AS failures, "
                         f"'error' AS severity FROM (SELECT {c} FROM {_MODEL_SRC[m]} WHERE {c} IS NOT NULL "
                         f"GROUP BY {c} HAVING count(*) > 1)")
    return _status_sql(" UNION ALL ".join(parts))


def _models(g):
    return {"listings_recent": g.listings, "window_prices_30d": g.mart("window_short"),
            "metrics_30d": g.mart("metrics_short"), "coverage_summary_30d": g.mart("coverage_summary_short"),
            "benchmarks_30d": g.mart("benchmarks_short")}


@register("dq_not_null", _not_null_sql())
def _q01(g):
    m = _models(g)
    return reduce(lambda a, b: a.unionByName(b),
                  [Q.not_null_checks(m[k], k, t) for k, t in Q.NOT_NULL_TESTS.items()])


@register("dq_unique", _unique_sql())
def _q02(g):
    m = _models(g)
    return reduce(lambda a, b: a.unionByName(b),
                  [Q.unique_check(m[k], k, c) for k, cols in Q.UNIQUE_TESTS.items() for c in cols])


@register("dq_severity", f"""SELECT count(*) AS tests, count(*) FILTER (WHERE status = 'pass') AS passed,
  count(*) FILTER (WHERE status = 'warn') AS warned, count(*) FILTER (WHERE status = 'fail') AS failed,
  CASE WHEN count(*) FILTER (WHERE status = 'fail') > 0 THEN 'fail'
       WHEN count(*) FILTER (WHERE status = 'warn') > 0 THEN 'warn' ELSE 'pass' END AS verdict
FROM ({_not_null_sql()} UNION ALL {_unique_sql()})""")
def _q03(g):
    return Q.verdict(Q.model_checks(_models(g)))


_RAW_SRC = {"ipo_events": "raw_events", "daily_prices": "raw_prices", "symbol_map": "raw_map",
            "company_profiles": "raw_profiles", "ingestion_runs": "(SELECT run_id FROM (VALUES ('main'), ('backfill'), ('lost')) v(run_id))"}


def _keys_sql() -> str:
    parts = []
    for t, src in _RAW_SRC.items():
        keys = KEYS[t]
        kt = ",".join(keys)
        anyn = " OR ".join(f"{k} IS NULL" for k in keys)
        parts.append(f"SELECT '{t}' AS model, '{kt}' AS column, 'not_null' AS test, "
                     f"CAST(count(*) FILTER (WHERE {anyn}) AS BIGINT) AS failures, 'error' AS severity FROM {src}")
        parts.append(f"SELECT '{t}', '{kt}', 'unique', CAST(count(*) AS BIGINT), 'error' FROM "
                     f"(SELECT {kt} FROM {src} GROUP BY {kt} HAVING count(*) > 1)")
    return _status_sql(" UNION ALL ".join(parts))


@register("dq_keys", _keys_sql())
def _q04(g):
    r = _raw(g)
    return Q.key_checks({"ipo_events": (r.ipo_events, KEYS["ipo_events"]),
                         "daily_prices": (r.daily_prices, KEYS["daily_prices"]),
                         "symbol_map": (r.symbol_map, KEYS["symbol_map"]),
                         "company_profiles": (r.company_profiles, KEYS["company_profiles"]),
                         "ingestion_runs": (_run_table(g), KEYS["ingestion_runs"])}, days=g.price_days)


@register("dq_key_violations", """SELECT 'ipo_events' AS model, ipo_symbol AS key, count(*) AS copies FROM (
  SELECT coalesce(upper(symbol), '') AS ipo_symbol FROM raw_events) GROUP BY ipo_symbol HAVING count(*) > 1
UNION ALL SELECT 'symbol_map', ipo_symbol, count(*) FROM raw_map GROUP BY ipo_symbol HAVING count(*) > 1""")
def _q04b(g):
    """The rows behind a failed check, on columns that are no keys, so that there are some."""
    r = _raw(g)
    ev = r.ipo_events.select(F.coalesce(F.upper("symbol"), F.lit("")).alias("key"))
    mp = r.symbol_map.select(F.col("ipo_symbol").alias("key"))
    return reduce(DataFrame.unionByName, [
        Q.key_violations(df, ("key",)).select(F.lit(name).alias("model"), "key", F.col("count").alias("copies"))
        for name, df in (("ipo_events", ev), ("symbol_map", mp))])


# ----------------------------------------------------------------- ingest ---
import datetime as _dt  # noqa: E402

from evwin.operators import ingest as I  # noqa: E402
from evwin.operators.upsert import upsert  # noqa: E402
from evwin.plans import load_run as R  # noqa: E402
from evwin.plans import window_state as WS  # noqa: E402
from evwin.session import new_folder  # noqa: E402
from evwin.sources import landing as L  # noqa: E402
from evwin.sources import payloads as PL  # noqa: E402
from evwin.sources import versioned  # noqa: E402
from evwin.sources.raw import code_version, publish  # noqa: E402

_BT = PL.BATCH_TS
_BT_SQL = f"'{_BT:%Y-%m-%d %H:%M:%S}'"
_CAL_LO = _P.as_of - _dt.timedelta(days=365)
_CAL_HI = _P.as_of + _dt.timedelta(days=14)
_YEAR_LO = _P.as_of.year - 2
_MONTH = re.compile(r"\d{4}-\d\d")
_EVENT_CUT = _P.as_of - _dt.timedelta(days=60)   # the store holds listings loaded before this date
_CAL_SRC = f"(SELECT * FROM raw_events WHERE ipo_date BETWEEN {O._d(_CAL_LO)} AND {O._d(_CAL_HI)})"
_OTC_OLD, _OTC_NEW = PL.REPLAY_EXCHANGE


def _published(g, name, write):
    """A folder beside the store, written once by the code that is there."""
    code = code_version(sys.modules[__name__], PL, I, L, R, W, M, WS)
    return publish(g.spark, f"{g.raw.root}/{name}-{code}", write)


def _landing(g, feed):
    """The folder that holds the folder of a feed, landed when it is first asked for."""
    return g._get(f"landing:{feed}", lambda: _published(g, f"landing-{feed}", lambda folder: PL.land(_raw(g), f"{folder}/{feed}", feed, _P.as_of)))


def _landings(g, feeds=PL.FEEDS):
    return {feed: _landing(g, feed) for feed in feeds}


def _feed(g, feed, per_line=True):
    """What has landed in a feed, read from its files."""
    return g._get(f"feed:{feed}", lambda: L.take(g.spark, _landing(g, feed), feed, f"{_landing(g, feed)}-record", per_line=per_line, run_id="query").rows)


def _cal_rows(g):
    return I.calendar_parse(_feed(g, "calendar", per_line=False), seq_col="seq")


@register("calendar_parse", f"""SELECT CAST(ipo_date AS VARCHAR) AS date, company_name AS name, symbol, exchange,
  {dbl('price_range_low')}, {dbl('price_range_high')}, shares FROM {_CAL_SRC}
WHERE (ipo_date - DATE '1970-01-01') % 4 <> 3
UNION ALL SELECT CAST(ipo_date AS VARCHAR), company_name, symbol, '{_OTC_NEW}', {dbl('price_range_low')},
  {dbl('price_range_high')}, shares FROM {_CAL_SRC} WHERE exchange = '{_OTC_OLD}'""")
def _i01(g):
    return _cal_rows(g).select("date", "name", "symbol", "exchange", "price_range_low",
                                      "price_range_high", "shares")


@register("calendar_windows", f"""SELECT {O._d(_CAL_LO)} AS window_from, {O._d(_CAL_HI)} AS window_to,
  count(*) AS events FROM raw_events WHERE ipo_date BETWEEN {O._d(_CAL_LO)} AND {O._d(_CAL_HI)}""")
def _i02(g):
    return I.calendar_windows(g.spark, _raw(g).ipo_events, as_of=_P.as_of)


@register("calendar_windows_yearly", f"""SELECT make_date(CAST(y AS INTEGER), 1, 1) AS window_from, make_date(CAST(y AS INTEGER), 12, 31) AS window_to,
  (SELECT count(*) FROM raw_events WHERE year(ipo_date) = y) AS events FROM range({_YEAR_LO}, {_P.as_of.year + 2}) t(y)""")
def _i02b(g):
    return I.calendar_windows(g.spark, _raw(g).ipo_events, as_of=_P.as_of, full=True, start_year=_YEAR_LO)


_EV_COLS = ("event_id, source, ipo_date, symbol, company_name, exchange, "
            "CAST(price_range_low AS DOUBLE) AS price_range_low, CAST(price_range_high AS DOUBLE) AS price_range_high, "
            "shares")
_DEDUPE_SQL = f"""SELECT {_EV_COLS}, {_BT_SQL} AS ingested_at FROM (
  SELECT * REPLACE (CASE WHEN exchange = '{_OTC_OLD}' THEN '{_OTC_NEW}' ELSE exchange END AS exchange)
  FROM {_CAL_SRC} WHERE (ipo_date - DATE '1970-01-01') % 4 <> 3 OR exchange = '{_OTC_OLD}')"""


def _dedupe(g):
    return I.event_key_dedupe(_cal_rows(g), batch_ts=_BT)


_EV_OUT = ["event_id", "source", "ipo_date", "symbol", "company_name", "exchange", "price_range_low",
           "price_range_high", "shares", "ingested_at"]


@register("event_key_dedupe", _DEDUPE_SQL)
def _i03(g):
    return _dedupe(g).select(*_EV_OUT)


@register("upsert_events", f"""SELECT {_EV_COLS}, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM raw_events WHERE ipo_date < {O._d(_EVENT_CUT)} AND event_id NOT IN (SELECT event_id FROM ({_DEDUPE_SQL}))
UNION ALL {_DEDUPE_SQL}""")
def _i04(g):
    target = _raw(g).ipo_events.filter(F.col("ipo_date") < F.lit(_EVENT_CUT))
    return upsert(target, _dedupe(g), ["event_id"]).select(*_EV_OUT)


_OHLCV_SQL = f"source, symbol, price_date, {dbl('open')}, {dbl('high')}, {dbl('low')}, {dbl('close')}, volume"
_PX_OUT = ["source", "symbol", "price_date", "open", "high", "low", "close", "volume"]
_FLAT_SQL = (f"SELECT {_OHLCV_SQL} FROM raw_prices WHERE source = 'alphavantage' "
             f"AND price_date BETWEEN {O._d(_CAL_LO)} AND {O._d(_P.as_of)}")


def _flat(g):
    pl = _feed(g, "series").select("symbol", "payload", F.lit(_CAL_LO).alias("date_from"), F.lit(_P.as_of).alias("date_to"))
    return I.daily_series_flatten(pl)


@register("daily_series_flatten", _FLAT_SQL)
def _i05(g):
    return _flat(g)


@register("series_faults", """SELECT s.symbol, r.reason FROM (SELECT DISTINCT symbol FROM raw_prices WHERE source = 'alphavantage') s
CROSS JOIN (VALUES ('unreadable payload'), ('bad date'), ('bad number')) r(reason)""")
def _i05b(g):
    pl = _feed(g, "series").filter("error is null").select("symbol", "payload", F.lit(_CAL_LO).alias("date_from"), F.lit(_P.as_of).alias("date_to"))
    return I.series_faults(pl).select("symbol", "reason")


@register("bars_normalise", f"""SELECT {_OHLCV_SQL} FROM raw_prices WHERE source = 'yahoo'
  AND price_date BETWEEN {O._d(_CAL_LO)} AND {O._d(_P.as_of)}""")
def _i06(g):
    bars = PL.bar_frames(_raw(g).daily_prices, as_of=_P.as_of)
    return I.bars_normalise(bars, symbol_col="symbol", date_col="Date")


@register("payload_triage", """SELECT 'ok' AS status, count(*) AS payloads FROM (
  SELECT DISTINCT symbol, date_trunc('month', price_date) FROM raw_prices WHERE source = 'alphavantage')
UNION ALL SELECT s, n FROM (SELECT count(DISTINCT symbol) AS n FROM raw_prices WHERE source = 'alphavantage')
  CROSS JOIN (VALUES ('rate_limited'), ('error'), ('info'), ('unexpected')) v(s)""")
def _i07(g):
    good, refused = _split(g)
    return good.select("status").unionByName(refused.select("status")).groupBy("status").agg(F.count(F.lit(1)).alias("payloads"))


def _split(g):
    return g._get("split", lambda: I.split_load(_feed(g, "triage").select("symbol", "payload"), new_folder(g.spark, "triage")))


@register("payload_quarantine", f"""SELECT symbol, status, message, 1 AS payloads FROM (SELECT DISTINCT symbol FROM raw_prices WHERE source = 'alphavantage')
CROSS JOIN (VALUES ('rate_limited', 'Thank you for using the API'), ('error', 'Invalid API call'), ('info', 'premium endpoint'), ('unexpected', NULL)) v(status, message)""")
def _i07b(g):
    """What a load sets aside, with the vendor's message."""
    return _split(g)[1].groupBy("symbol", "status", "message").agg(F.count(F.lit(1)).alias("payloads"))


def _fh_records(g):
    return I.profiles_finnhub(_feed(g, "finnhub_profile"))


def _yh_records(g):
    return I.profiles_yahoo(_feed(g, "yahoo_profile"))


@register("profiles_finnhub", f"""SELECT 'upserted' AS outcome, count(*) AS payloads FROM raw_profiles WHERE source = 'finnhub'
UNION ALL SELECT CASE WHEN ipo_symbol LIKE '%{PL.FAILED_SUFFIX}' THEN 'failed' ELSE 'empty' END, count(*) FROM (SELECT DISTINCT ipo_symbol FROM raw_map
  WHERE ipo_symbol NOT IN (SELECT symbol FROM raw_profiles WHERE source = 'finnhub')) GROUP BY 1""")
def _i08(g):
    return _fh_records(g).groupBy("outcome").agg(F.count(F.lit(1)).alias("payloads"))


@register("profiles_yahoo", """SELECT symbol, name, exchange, country, industry, nullif(sector, '') AS sector, market_cap,
  currency, weburl, 'upserted' AS outcome FROM raw_profiles WHERE source = 'yahoo'""")
def _i09(g):
    y = _yh_records(g)
    return y.select(F.col("symbol").cast("string"), *[F.col(c).cast("string") for c in
                    ("name", "exchange", "country", "industry", "sector")],
                    F.col("market_cap").cast("double"), F.col("currency").cast("string"),
                    F.col("weburl").cast("string"), "outcome")


_PROF_OUT = ["source", "symbol", "name", "exchange", "country", "ipo", "currency", "market_cap", "industry",
             "sector", "weburl", "logo", "ingested_at"]


@register("profiles_upsert", f"""SELECT source, symbol, name, exchange, country, ipo, currency,
  CASE WHEN source = 'yahoo' AND market_cap = 0 THEN NULL ELSE market_cap END AS market_cap,
  nullif(trim(industry), '') AS industry, nullif(trim(sector), '') AS sector, weburl, CAST(NULL AS VARCHAR) AS logo,
  {_BT_SQL} AS ingested_at, source AS record_source, symbol AS record_symbol,
  CASE source WHEN 'finnhub' THEN symbol END AS record_ticker, CASE source WHEN 'yahoo' THEN name END AS record_name,
  CASE source WHEN 'yahoo' THEN name END AS payload_name FROM raw_profiles""")
def _i10(g):
    r = _raw(g)
    cols = r.company_profiles.columns
    fh = I.profiles_conform(_fh_records(g).filter("outcome = 'upserted'"), cols, _BT)
    yh = I.profiles_conform(_yh_records(g).filter("outcome = 'upserted'"), cols, _BT)
    merged = upsert(r.company_profiles, fh.unionByName(yh), ["source", "symbol"])
    rec = {"record_source": "source", "record_symbol": "symbol", "record_ticker": "ticker"}
    of_yahoo = F.col("source") == "yahoo"   # the payload keeps the vendor's own names inside the record
    return merged.select(*_PROF_OUT, *[F.get_json_object("raw_json", f"$.{k}").alias(c) for c, k in rec.items()],
                         F.when(of_yahoo, F.get_json_object("raw_json", "$.name")).alias("record_name"),
                         F.when(of_yahoo, F.get_json_object("raw_json", "$.raw_json.longName")).alias("payload_name"))


def _alpha_resolved(g):
    return I.resolve_first_or_exact(_feed(g, "alpha_search"))


_ALPHA_SQL = f"""SELECT ipo_symbol,
  CASE WHEN vendor_symbol LIKE 'X%' OR is_priceable OR vendor_symbol LIKE 'N%' THEN ipo_symbol ELSE vendor_symbol END AS vendor_symbol,
  CASE WHEN vendor_symbol LIKE 'X%' THEN false WHEN is_priceable THEN true WHEN vendor_symbol LIKE 'N%' THEN false ELSE true END AS is_priceable,
  CASE WHEN vendor_symbol LIKE 'X%' THEN 'resolve_error: {I.RATE_LIMIT_PREFIX}{PL.NOTE_TEXT}'
       WHEN is_priceable THEN 'match=' || ipo_symbol || ' name=exact region=None'
       WHEN vendor_symbol LIKE 'N%' THEN '{I.NO_MATCH_NOTE}'
       ELSE 'match=' || vendor_symbol || ' name=only region=United States' END AS notes
FROM raw_map WHERE vendor = 'alphavantage'"""


@register("resolve_first_or_exact", _ALPHA_SQL)
def _i13(g):
    return _alpha_resolved(g)


@register("symbol_map_upsert", f"""SELECT vendor, ipo_symbol, vendor_symbol, is_priceable, notes,
  strftime(last_checked_at, '%Y-%m-%d %H:%M:%S') AS last_checked_at FROM raw_map WHERE vendor <> 'alphavantage'
UNION ALL SELECT 'alphavantage', ipo_symbol, vendor_symbol, is_priceable, notes, {_BT_SQL} FROM ({_ALPHA_SQL})""")
def _i11(g):
    batch = I.symbol_map_rows(_alpha_resolved(g), vendor="alphavantage", batch_ts=_BT)
    return upsert(_raw(g).symbol_map, batch, ["vendor", "ipo_symbol"])


def _num_json(c):
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


_RAW_ROW_SQL = ("'{\"source\":\"' || source || '\",\"symbol\":\"' || symbol || '\",\"date\":\"' || CAST(price_date AS VARCHAR) || '\"' || "
                + " || ".join(f"',\"{c}\":' || {_num_json(c)}" for c in ("open", "high", "low", "close", "volume"))
                + " || '}'")


@register("prices_upsert", f"""SELECT {_OHLCV_SQL}, CAST(NULL AS VARCHAR) AS raw_row, '2001-06-30 08:00:00' AS ingested_at FROM raw_prices
WHERE price_date <= {O._d(O.LOAD_CUTOFF)} AND (source, symbol, price_date) NOT IN
  (SELECT (source, symbol, price_date) FROM raw_prices WHERE source = 'alphavantage'
   AND price_date BETWEEN {O._d(_CAL_LO)} AND {O._d(_P.as_of)})
UNION ALL SELECT {_OHLCV_SQL}, {_RAW_ROW_SQL}, {_BT_SQL} FROM raw_prices WHERE source = 'alphavantage'
  AND price_date BETWEEN {O._d(_CAL_LO)} AND {O._d(_P.as_of)}""")
def _i12(g):
    """A table of what was loaded before, merged with the landed series and read again.  The
    table is there once a store; a merge commits a new state of it, the same each time."""
    t = R.Tables(g.spark, _published(g, "prices-before", lambda folder: R.Tables(g.spark, folder).create("daily_prices", _existing(g).drop("price_month"))))
    t.upsert("daily_prices", I.price_rows(_flat(g), batch_ts=_BT).drop("price_month"))
    return t.read("daily_prices").select(*_PX_OUT, "raw_row", "ingested_at")


_YREQ = "(SELECT DISTINCT vendor_symbol AS v FROM raw_map WHERE vendor = 'yahoo')"
_SHAPE = "(regexp_full_match(v, '[A-Za-z0-9]{1,5}') AND NOT (length(v) >= 2 AND (v LIKE '%W' OR v LIKE '%R')))"
_RESOLVED = f"""SELECT v AS ipo_symbol, CASE WHEN {_SHAPE} AND (v LIKE 'X%' OR (v LIKE 'S%' AND v NOT LIKE '%7'))
  THEN v END AS resolved FROM {_YREQ}"""
_HIST = f"""SELECT r.*, EXISTS (SELECT 1 FROM raw_prices p WHERE p.source = 'yahoo' AND p.symbol = r.resolved
  AND p.price_date BETWEEN {O._d(_P.as_of - _dt.timedelta(days=30))} AND {O._d(_P.as_of)}) AS has_history FROM ({_RESOLVED}) r"""


def _yreq(g):
    return _feed(g, "vendor_search")


def _yhist(g):
    return I.history_check(I.resolve_ranked_exact(_yreq(g)), None, as_of=_P.as_of, days=g.price_days)


@register("resolve_ranked_exact", _RESOLVED)
def _i14(g):
    return I.resolve_ranked_exact(_yreq(g))


@register("history_check", _HIST)
def _i15(g):
    return _yhist(g)


@register("symbol_map_rows", f"""SELECT ipo_symbol, ipo_symbol AS vendor_symbol,
  coalesce(NOT err AND resolved IS NOT NULL AND has_history, false) AS is_priceable,
  CASE WHEN err THEN '{I.YAHOO_NOTES['error']}{PL.ERROR_TEXT}' WHEN resolved IS NULL THEN '{I.YAHOO_NOTES['no_match']}'
       WHEN has_history THEN '{I.YAHOO_NOTES['match']}' ELSE '{I.YAHOO_NOTES['no_history']}' END AS notes
FROM (SELECT *, ipo_symbol LIKE 'S%7' AS err FROM ({_HIST}))""")
def _i16(g):
    return I.yahoo_map_rows(_yreq(g), _yhist(g))


# The store before the two runs, and what they leave.  I17: a row a run, with the run's
# own counters; Q04 checks the same table.
_RUN_END = _BT + _dt.timedelta(minutes=5)
_MAIN_ID, _BACK_ID, _LOST_ID = (f"{k}-{_P.as_of}" for k in ("main", "backfill", "lost"))


def _seed(g, name):
    """The store before the runs: a table that each run's own begins as a clone of,
    written once and never again."""
    def write(folder):
        r, t = _raw(g), R.Tables(g.spark, folder)
        if name == "ipo_events":
            t.create(name, r.ipo_events.filter(F.col("ipo_date") < F.lit(_EVENT_CUT)))
        elif name == "company_profiles":
            t.create(name, r.company_profiles.filter(~PL.is_new("symbol", PL.NEW_PROFILE)))
        elif name == "symbol_map":
            t.create(name, r.symbol_map.filter(F.when(F.col("vendor") == "yahoo", ~PL.is_new("ipo_symbol", PL.NEW_YAHOO)).otherwise(~PL.is_new("ipo_symbol", PL.NEW_ALPHA))))
        else:   # whole months as the raw store has them, the cutoff's to its day
            stored = r.folder(name)
            whole = {m: stored for m in versioned.partitions(g.spark, stored, "price_month") if _MONTH.fullmatch(m) and m < f"{O.LOAD_CUTOFF:%Y-%m}"}
            t.create(name, _existing(g).filter(~F.col("price_month").isin(*whole)).drop("price_month"), whole)
    return R.Tables(g.spark, _published(g, f"runs-before-{name}", write))


def _run_options():
    return dict(p=_P, use_fallback=True, clock=iter((_BT, _BT, _RUN_END)).__next__)


def _main_run(g):
    """The tables that the load run leaves; their run table has a lost run's row too."""
    def write(folder):
        main = R.Tables(g.spark, f"{folder}/main")
        for name in ("ipo_events", "company_profiles", "symbol_map", "daily_prices"):
            main.clone(name, _seed(g, name))
        R.load_run(main, _landings(g, R.MAIN_FEEDS), _MAIN_ID, **_run_options())
        try:
            R.load_run(R.Tables(g.spark, f"{folder}/lost", runs=main.root), f"{folder}/nothing-landed", _LOST_ID, **_run_options())
        except R.MissingFeed:
            pass   # as a scheduler would see it; the run table has the row
    return R.Tables(g.spark, g._get("run-main", lambda: _published(g, "run-main", write)) + "/main")


def _backfill_run(g):
    """The tables that the backfill run leaves, of those that it reads or writes."""
    def write(folder):
        back = R.Tables(g.spark, folder)
        for name in ("symbol_map", "daily_prices"):
            back.clone(name, _seed(g, name))
        R.backfill_run(back, _landings(g, R.BACKFILL_FEEDS), _BACK_ID, g.mart("coverage"), **_run_options())
    return R.Tables(g.spark, g._get("run-backfill", lambda: _published(g, "run-backfill", write)))


def _runs(g):
    """The folder of the run table of all runs."""
    def write(folder):
        rows = _main_run(g).read("ingestion_runs").unionByName(_backfill_run(g).read("ingestion_runs"))
        R.Tables(g.spark, folder).create("ingestion_runs", rows)
    return g._get("runs", lambda: _published(g, "runs", write))


def _run_table(g):
    return R.Tables(g.spark, _runs(g)).read("ingestion_runs")


def _letters(c, letters):
    return f"substr({c}, 4, 1) BETWEEN '{letters[0]}' AND '{letters[1]}'"


_RUN_EVENTS = FINAL_SQL["upsert_events"]
_RUN_STATE = f"""
run_events AS MATERIALIZED ({_RUN_EVENTS}),
run_map0 AS (SELECT * FROM raw_map WHERE NOT (CASE vendor WHEN 'yahoo' THEN {_letters('ipo_symbol', PL.NEW_YAHOO)} ELSE {_letters('ipo_symbol', PL.NEW_ALPHA)} END)),
run_profiles0 AS (SELECT source, symbol, industry, sector FROM raw_profiles WHERE NOT {_letters('symbol', PL.NEW_PROFILE)}),
run_recent AS (SELECT DISTINCT upper(symbol) AS symbol FROM run_events
  WHERE symbol IS NOT NULL AND symbol <> '' AND {O._EQ.format(s='symbol')} AND ipo_date >= {_RECENT_SQL}),
run_fh AS (SELECT symbol, nullif(trim(industry), '') AS industry, nullif(trim(sector), '') AS sector FROM raw_profiles
  WHERE source = 'finnhub' AND symbol IN (SELECT s.symbol FROM run_recent s LEFT JOIN
    (SELECT symbol, max(nullif(industry, '')) AS i, max(nullif(sector, '')) AS c FROM run_profiles0 GROUP BY symbol) p ON p.symbol = s.symbol
    WHERE p.i IS NULL AND p.c IS NULL)),
run_profiles1 AS (SELECT * FROM run_profiles0 WHERE source <> 'finnhub' OR symbol NOT IN (SELECT symbol FROM run_fh)
  UNION ALL SELECT 'finnhub', * FROM run_fh),
run_yh AS (SELECT symbol FROM raw_profiles WHERE source = 'yahoo' AND symbol IN (SELECT s.symbol FROM run_recent s LEFT JOIN
    (SELECT symbol, max(nullif(industry, '')) AS i, max(nullif(sector, '')) AS c FROM run_profiles1 GROUP BY symbol) p ON p.symbol = s.symbol
    WHERE p.i IS NULL AND p.c IS NULL)),
run_alpha AS (SELECT * FROM ({_ALPHA_SQL}) WHERE ipo_symbol IN (SELECT symbol FROM run_recent)
  AND ipo_symbol NOT IN (SELECT ipo_symbol FROM run_map0 WHERE vendor = 'alphavantage')),
run_yahoo AS (SELECT DISTINCT ipo_symbol, EXISTS (SELECT 1 FROM raw_prices p WHERE p.source = 'yahoo' AND p.symbol = m.ipo_symbol
    AND p.price_date BETWEEN {O._d(_P.as_of - _dt.timedelta(days=30))} AND {O._d(_P.as_of)}) AND ipo_symbol NOT LIKE '%{PL.FAILED_SUFFIX}' AND ipo_symbol NOT LIKE '%Z' AS is_priceable
  FROM raw_map m WHERE vendor = 'yahoo' AND ipo_symbol IN (SELECT symbol FROM run_recent)
  AND ipo_symbol NOT IN (SELECT ipo_symbol FROM run_map0 WHERE vendor = 'yahoo')),
run_map AS (SELECT vendor, ipo_symbol, vendor_symbol, is_priceable FROM run_map0
  UNION ALL SELECT 'alphavantage', ipo_symbol, vendor_symbol, is_priceable FROM run_alpha
  UNION ALL SELECT 'yahoo', ipo_symbol, ipo_symbol, is_priceable FROM run_yahoo)"""
_BACK_TURNS = f"""SELECT ipo_symbol, price_symbol AS vendor_symbol, ipo_date, row_number() OVER (ORDER BY CASE coverage_status
  WHEN 'mapped_but_no_prices' THEN 1 WHEN 'very_low_coverage' THEN 2 ELSE 3 END, ipo_date DESC, ipo_symbol, event_id) AS pos FROM ({_BACKFILL_SQL})"""


def _loop_sql(turns: str, map_name: str, final: str) -> str:
    return f"(WITH RECURSIVE {O.load_ctes(_P, turns).strip().replace('raw_map', map_name)} {final})"


_MAIN_TURNS = f"""SELECT ipo_symbol, vendor_symbol, ipo_date, row_number() OVER (ORDER BY ipo_date DESC, ipo_symbol, vendor_symbol) AS pos FROM (
  SELECT DISTINCT upper(e.symbol) AS ipo_symbol, m.vendor_symbol, e.ipo_date FROM run_events e JOIN run_map m ON m.vendor = 'yahoo' AND m.ipo_symbol = upper(e.symbol)
  WHERE m.is_priceable AND m.vendor_symbol IS NOT NULL AND e.ipo_date IS NOT NULL AND e.ipo_date <= {O._d(_P.as_of)}
    AND {O._EQ.format(s='e.symbol')} AND e.ipo_date >= {_RECENT_SQL})"""
_MAP_COUNTS = "count(*) AS attempted, count(*) FILTER (WHERE is_priceable) AS priceable, count(*) FILTER (WHERE NOT is_priceable) AS not_priceable"
_RUN_ROWS = f"""SELECT '{_MAIN_ID}' AS run_id, '{R.MAIN_RUN}' AS source, 'success' AS status, 'ipos=' || (SELECT count(*) FROM ({FINAL_SQL["calendar_parse"]}))
    || ', fh_profiles=' || (SELECT count(*) FROM run_fh) || ', yh_profiles=' || (SELECT count(*) FROM run_yh)
    || ', alpha_map_attempted=' || a.attempted || ', alpha_map_priceable=' || a.priceable || ', alpha_map_not_priceable=' || a.not_priceable
    || ', yahoo_map_attempted=' || y.attempted || ', yahoo_map_priceable=' || y.priceable || ', yahoo_map_not_priceable=' || y.not_priceable
    || ', prices_tickers=' || l.attempted || ', prices_rows=' || l.rows || ', with_data=' || l.with_data || ', no_data=' || l.no_data
    || ', failed=' || l.failed || ', yahoo_used=' || l.yahoo_used || ', alpha_used=' || l.alpha_used AS notes
  FROM (SELECT {_MAP_COUNTS} FROM run_alpha) a, (SELECT {_MAP_COUNTS} FROM run_yahoo) y, {_loop_sql(_MAIN_TURNS, "run_map", _W11_SQL)} l
UNION ALL SELECT '{_BACK_ID}', '{R.BACKFILL_RUN}', 'success', 'attempted=' || attempted || ', rows=' || rows || ', with_data=' || with_data || ', no_data=' || no_data
    || ', failed=' || failed || ', yahoo_used=' || yahoo_used || ', alpha_used=' || alpha_used FROM {_loop_sql(_BACK_TURNS, "run_map0", _W11_SQL)}
UNION ALL SELECT '{_LOST_ID}', '{R.MAIN_RUN}', 'failed', 'feed ''calendar'' has not landed'"""


def _run_ctes(final: str) -> str:
    """``final`` after the state that the runs work on; its own CTEs come first."""
    return f"SELECT * FROM (WITH {_RUN_STATE.strip()}\n{final})"


@register("run_audit", _run_ctes(f"""SELECT run_id, source, {_BT_SQL} AS started_at, '{_RUN_END:%Y-%m-%d %H:%M:%S}' AS finished_at, status, notes FROM ({_RUN_ROWS})"""))
def _i17(g):
    return _run_table(g)


def _after_sql(turns, map_name):
    return f"""SELECT {_OHLCV_SQL} FROM raw_prices WHERE price_date <= {O._d(O.LOAD_CUTOFF)}
UNION SELECT * FROM {_loop_sql(turns, map_name, f"SELECT DISTINCT {_OHLCV_SQL} FROM w_loaded")}"""


@register("load_run_prices", _run_ctes(_after_sql(_MAIN_TURNS, "run_map")))
def _i12b(g):
    """The price table as the load run leaves it."""
    return _main_run(g).read("daily_prices").select(*_PX_OUT)


@register("backfill_run_prices", _run_ctes(_after_sql(_BACK_TURNS, "run_map0")))
def _i12c(g):
    return _backfill_run(g).read("daily_prices").select(*_PX_OUT)


@register("load_run_symbol_map", _run_ctes("SELECT * FROM run_map"))
def _i11b(g):
    """The symbol map as the load run leaves it."""
    return _main_run(g).read("symbol_map").select("vendor", "ipo_symbol", "vendor_symbol", "is_priceable")


@register("map_counters", f"""SELECT 'alphavantage' AS vendor, {_MAP_COUNTS} FROM ({_ALPHA_SQL})
UNION ALL SELECT 'yahoo', {_MAP_COUNTS} FROM ({FINAL_SQL["symbol_map_rows"]})""")
def _i16b(g):
    rows = {"alphavantage": _alpha_resolved(g), "yahoo": I.yahoo_map_rows(_yreq(g), _yhist(g))}
    return reduce(DataFrame.unionByName, [df.agg(*[c.alias(n) for n, c in I.map_counters().items()]).select(F.lit(v).alias("vendor"), "*")
                                          for v, df in rows.items()])


@register("profile_source_default", """SELECT source, symbol, name, industry, sector FROM raw_profiles""")
def _i18(g):
    legacy = _raw(g).company_profiles.withColumn(
        "source", F.when(F.col("source") == "finnhub", F.lit(None).cast("string")).otherwise(F.col("source")))
    return I.profile_source_default(legacy).select("source", "symbol", "name", "industry", "sector")


# W02, second call: the yahoo budget, after the finnhub profiles of the first
# list have been upserted (as the reference recomputes it after that step).
_W02_FIRST = FINAL_SQL["symbols_missing_profile"]


@register("symbols_missing_profile_second", f"""SELECT s.symbol FROM w_recent s
LEFT JOIN (SELECT symbol, max(nullif(industry, '')) AS ia, max(nullif(sector, '')) AS sa FROM (
    SELECT source, symbol,
           CASE WHEN source = 'finnhub' AND symbol IN (SELECT symbol FROM ({_W02_FIRST}))
                THEN nullif(trim(industry), '') ELSE industry END AS industry,
           CASE WHEN source = 'finnhub' AND symbol IN (SELECT symbol FROM ({_W02_FIRST}))
                THEN nullif(trim(sector), '') ELSE sector END AS sector
    FROM raw_profiles) WHERE source IN ('finnhub', 'yahoo') GROUP BY symbol) p ON p.symbol = s.symbol
WHERE p.symbol IS NULL OR (p.ia IS NULL AND p.sa IS NULL)
""")
def _w02b(g):
    r = _raw(g)
    first = _w02(g)
    pl = _feed(g, "finnhub_profile").join(first, "symbol", "left_semi")
    rec = I.profiles_finnhub(pl).filter("outcome = 'upserted'")
    profiles2 = upsert(r.company_profiles, I.profiles_conform(rec, r.company_profiles.columns, _BT),
                       ["source", "symbol"])
    return W.symbols_missing_profile(r.ipo_events, profiles2, limit=_P.profile_limit, **_WL)


# ---- marts kept by month: the store of before the cutoff, then a load of all after it ----
def _states(g, days):
    listings, prices = g.listings, _raw(g).daily_prices
    options = dict(as_of=_P.as_of, recent_days=_P.model_recent_days, days=days, bucket_days=_P.bucket_days)

    def write(folder):
        early, late = price_date_range(prices, hi=O.LOAD_CUTOFF), prices.filter(F.col("price_month") >= f"{O.LOAD_CUTOFF:%Y-%m}")
        WS.refresh(g.spark, folder, listings, early, early.select("price_month"), **options)
        WS.refresh(g.spark, folder, listings, prices, late.select("price_month"), **options)
    return versioned.read(g.spark, _published(g, f"states-{days}", write))


@register("coverage_100d_by_month", FINAL_SQL["coverage_100d"])
def _m08b(g):
    return M.coverage_long(g.listings, None, _P.long_limits, _P.long_window, stats=WS.long_stats(_states(g, _P.long_window)))


@register("metrics_100d_by_month", FINAL_SQL["metrics_100d"])
def _m10b(g):
    return M.metrics_long(g.listings, None, _P.long_limits, _P.long_window, stats=WS.long_stats(_states(g, _P.long_window)))


@register("metrics_30d_by_month", FINAL_SQL["metrics_30d"])
def _m12b(g):
    return M.metrics_short(g.listings, None, _P.short_limits, _P.short_window, stats=WS.short_stats(_states(g, _P.short_window)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["metrics_30d"](spark, sf_dir)
