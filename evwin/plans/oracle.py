"""Independent DuckDB SQL for every registered query (the correctness
oracle).  Tables ``part supplier lineitem ...`` are views in the oracle's
connection; the raw tables are re-derived here in SQL (FIXTURES.md §2) and the
models are restated in plain SQL.

Numeric parity rules (SURVEY §5): decimal outputs are DOUBLE on both sides;
rounded ratios/averages are computed in integers (HUGEINT) with half away
from zero, so true ties round like PostgreSQL's numeric ``round``."""

from __future__ import annotations

import datetime as dt

from evwin.config import DEFAULT_PARAMS, Params

E19 = "CAST('10000000000000000000' AS HUGEINT)"


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def hi(expr: str) -> str:
    """decimal(18,6)-valued expression -> exact HUGEINT in millionths."""
    return f"CAST(({expr}) * 1000000 AS HUGEINT)"


def rdiv(num: str, den: str, digits: int) -> str:
    """round_half_away(num/den, digits) as DOUBLE; num, den integers, den<>0."""
    m = 10 ** digits
    return (f"(CAST(sign({num}) * sign({den}) * ((abs({num}) * {2 * m} + abs({den})) "
            f"// (2 * abs({den}))) AS DOUBLE) / {m})")


def ratio19(num: str, den: str) -> str:
    """round_half_away(num/den, 19) as a HUGEINT scaled by 10^19 (Spark's
    decimal(38,19) quotient of two decimal(18,6) values)."""
    return (f"(sign({num}) * sign({den}) * ((abs({num}) * 2 * {E19} + abs({den})) "
            f"// (2 * abs({den}))))")


def fixture_ctes(p: Params = DEFAULT_PARAMS) -> str:
    a = p.as_of
    return f"""
fx_stem AS (
  SELECT p_partkey AS k, p_name, p_brand, p_type, p_size, p_retailprice,
         chr(CAST(65 + (p_partkey // 17576) % 26 AS INTEGER)) || chr(CAST(65 + (p_partkey // 676) % 26 AS INTEGER))
      || chr(CAST(65 + (p_partkey // 26) % 26 AS INTEGER)) || chr(CAST(65 + p_partkey % 26 AS INTEGER)) AS s4
  FROM part),
fx_listing AS (
  SELECT *, CASE WHEN k % 37 = 0 THEN s4 || '7' WHEN k % 41 = 0 THEN s4 || 'XX' ELSE s4 END AS sym
  FROM fx_stem),
fx_events0 AS (
  SELECT 'finnhub' AS source,
         CAST({_d(a)} - CAST((k * 37) % 400 - 10 AS INTEGER) AS DATE) AS ipo_date,
         CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN '' WHEN k % 13 = 0 THEN lower(sym) ELSE sym END AS symbol,
         p_name || ' #' || CAST(k AS VARCHAR) AS company_name,
         CASE k % 4 WHEN 0 THEN 'NASDAQ Global' WHEN 1 THEN 'NYSE' WHEN 2 THEN 'nyse american' ELSE 'OTC' END AS exchange,
         CAST(p_retailprice * 0.9 AS DECIMAL(18,6)) AS price_range_low,
         CAST(p_retailprice * 1.1 AS DECIMAL(18,6)) AS price_range_high,
         CAST(p_size AS BIGINT) * 1000 AS shares
  FROM fx_listing),
raw_events AS (
  SELECT md5(source || '|' || CAST(ipo_date AS VARCHAR) || '|' || coalesce(company_name, '') || '|' || coalesce(symbol, '')) AS event_id,
         *, TIMESTAMP '2001-06-30 08:00:00' AS ingested_at
  FROM fx_events0),
fx_symbol AS (SELECT * FROM fx_listing QUALIFY row_number() OVER (PARTITION BY sym ORDER BY k) = 1),
raw_map AS (
  SELECT 'alphavantage' AS vendor, sym AS ipo_symbol,
         CASE WHEN k % 17 = 0 THEN 'X' || CAST(k AS VARCHAR) WHEN k % 3 = 0 THEN 'N' || CAST(k % 25 AS VARCHAR)
              ELSE 'S' || CAST(k % (SELECT count(*) FROM supplier) AS VARCHAR) END AS vendor_symbol,
         k % 5 <> 0 AS is_priceable, CAST(NULL AS VARCHAR) AS notes, TIMESTAMP '2001-06-01 00:00:00' AS last_checked_at
  FROM fx_symbol WHERE k % 2 = 0
  UNION ALL
  SELECT 'yahoo', sym,
         CASE WHEN k % 17 = 0 THEN 'X' || CAST(k AS VARCHAR) WHEN k % 3 = 1 THEN 'N' || CAST(k % 25 AS VARCHAR)
              ELSE 'S' || CAST(k % (SELECT count(*) FROM supplier) AS VARCHAR) END,
         k % 7 <> 0, NULL, TIMESTAMP '2001-06-02 00:00:00'
  FROM fx_symbol WHERE k % 11 <> 0),
raw_profiles AS (
  SELECT 'finnhub' AS source, sym AS symbol, p_name AS name, 'US' AS exchange, 'US' AS country,
         CAST(NULL AS VARCHAR) AS ipo, 'USD' AS currency, CAST(k * 1000 AS DOUBLE) AS market_cap,
         CASE WHEN k % 8 = 0 THEN NULL WHEN k % 10 = 0 THEN ' ' ELSE p_type END AS industry,
         CAST(NULL AS VARCHAR) AS sector, 'web/' || lower(sym) AS weburl
  FROM fx_symbol WHERE k % 3 <> 0
  UNION ALL
  SELECT 'yahoo', sym, p_name, 'US', 'US', NULL, 'USD', CAST(k * 1000 AS DOUBLE),
         CASE WHEN k % 6 = 0 THEN NULL ELSE p_type END,
         CASE WHEN k % 9 = 0 THEN '' ELSE p_brand END, 'web/' || lower(sym)
  FROM fx_symbol WHERE k % 2 = 0),
fx_ticks AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate
  FROM lineitem
  UNION ALL
  SELECT 'N' || CAST(s_nationkey AS VARCHAR), l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
fx_bars AS (
  SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'alphavantage' ELSE 'yahoo' END AS source, symbol,
         CAST(l_shipdate AS DATE) AS price_date,
         arg_min(px, (l_orderkey, l_linenumber, px)) AS open, max(px) AS high, min(px) AS low,
         arg_max(px, (l_orderkey, l_linenumber, px)) AS close0, CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM (SELECT *, CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(18,6)) AS px FROM fx_ticks)
  GROUP BY 1, 2, 3),
raw_prices AS (
  SELECT source, symbol, price_date, open, high, low,
         CASE WHEN volume % 23 = 0 THEN NULL WHEN volume % 101 = 0 THEN CAST(0 AS DECIMAL(18,6)) ELSE close0 END AS close,
         volume, TIMESTAMP '2001-06-30 08:00:00' AS ingested_at
  FROM fx_bars)"""


def model_ctes(p: Params = DEFAULT_PARAMS) -> str:
    lo = p.as_of - dt.timedelta(days=p.model_recent_days)
    L, S = p.long_window, p.short_window
    low, good = p.long_limits
    g30, p30, l30 = p.short_limits
    return f"""
m_base AS (
  SELECT event_id, ipo_date, upper(symbol) AS ipo_symbol, company_name, exchange
  FROM raw_events
  WHERE ipo_date >= {_d(lo)} AND symbol IS NOT NULL AND symbol <> ''
    AND regexp_full_match(upper(symbol), '[A-Z]{{1,5}}') AND NOT regexp_matches(upper(symbol), '[UWR]$')
    AND (upper(exchange) LIKE '%NASDAQ%' OR upper(exchange) LIKE '%NYSE%')),
m_map AS (
  SELECT * FROM (
    SELECT ipo_symbol, vendor, vendor_symbol, is_priceable, notes, last_checked_at,
           row_number() OVER (PARTITION BY ipo_symbol ORDER BY
             CASE WHEN vendor = 'alphavantage' AND is_priceable THEN 1 WHEN vendor = 'yahoo' AND is_priceable THEN 2
                  WHEN vendor = 'alphavantage' THEN 3 WHEN vendor = 'yahoo' THEN 4 ELSE 99 END,
             last_checked_at DESC NULLS LAST, vendor) AS rn
    FROM raw_map) WHERE rn = 1),
m_prof AS (
  SELECT * FROM (
    SELECT symbol, source, industry, sector, country, currency, market_cap, weburl,
           row_number() OVER (PARTITION BY symbol ORDER BY
             CASE WHEN source = 'finnhub' AND industry IS NOT NULL THEN 1 WHEN source = 'yahoo' AND industry IS NOT NULL THEN 2
                  WHEN source = 'finnhub' AND sector IS NOT NULL THEN 3 WHEN source = 'yahoo' AND sector IS NOT NULL THEN 4
                  WHEN source = 'finnhub' THEN 5 WHEN source = 'yahoo' THEN 6 ELSE 99 END, source) AS rn
    FROM raw_profiles) WHERE rn = 1),
m_listings AS (
  SELECT b.event_id, b.ipo_date, b.ipo_symbol, b.company_name, b.exchange,
         sm.vendor AS price_vendor, sm.vendor_symbol AS price_symbol, coalesce(sm.is_priceable, false) AS is_priceable,
         pp.source AS profile_source, pp.industry, pp.sector, pp.country, pp.currency, pp.market_cap, pp.weburl
  FROM m_base b LEFT JOIN m_map sm ON b.ipo_symbol = sm.ipo_symbol LEFT JOIN m_prof pp ON b.ipo_symbol = pp.symbol),
m_pref AS (
  SELECT * FROM (
    SELECT source, symbol, price_date, open, high, low, close, volume,
           row_number() OVER (PARTITION BY symbol, price_date ORDER BY
             CASE source WHEN 'alphavantage' THEN 1 WHEN 'yahoo' THEN 2 ELSE 99 END, source) AS rn
    FROM raw_prices) WHERE rn = 1),
m_win_long AS (
  SELECT i.event_id, i.ipo_symbol, i.ipo_date, i.price_symbol, p.source AS price_source, p.price_date,
         p.open, p.high, p.low, p.close, p.volume, CAST(p.price_date - i.ipo_date AS BIGINT) AS day_num
  FROM m_listings i JOIN m_pref p ON p.symbol = i.price_symbol
  WHERE i.is_priceable AND i.price_symbol IS NOT NULL
    AND p.price_date >= i.ipo_date AND p.price_date <= i.ipo_date + {L}),
m_win_short AS (SELECT * FROM m_win_long WHERE price_date <= ipo_date + {S}),
m_cov_stats AS (
  SELECT event_id, count(*) AS price_rows, count(DISTINCT price_date) AS days,
         min(price_date) AS first_price_date, max(price_date) AS last_price_date
  FROM m_win_long GROUP BY event_id),
m_coverage AS (
  SELECT i.event_id, i.ipo_date, i.ipo_symbol, i.company_name, i.exchange, i.industry, i.sector,
         i.price_vendor, i.price_symbol, i.is_priceable,
         coalesce(s.price_rows, 0) AS price_rows, coalesce(s.days, 0) AS distinct_price_days,
         s.first_price_date, s.last_price_date,
         CASE WHEN NOT i.is_priceable THEN 'not_priceable' WHEN i.price_symbol IS NULL THEN 'unmapped'
              WHEN coalesce(s.days, 0) = 0 THEN 'mapped_but_no_prices'
              WHEN coalesce(s.days, 0) < {low} THEN 'very_low_coverage'
              WHEN coalesce(s.days, 0) < {good} THEN 'partial_coverage' ELSE 'good_coverage' END AS coverage_status,
         coalesce(s.days, 0) >= {good} AS is_analysis_ready
  FROM m_listings i LEFT JOIN m_cov_stats s ON s.event_id = i.event_id),
m_close_stats AS (
  SELECT event_id, count(*) AS n_days, arg_min(close, price_date) AS first_close,
         arg_max(close, price_date) AS last_close, min(close) AS min_close, max(close) AS max_close
  FROM m_win_long WHERE close IS NOT NULL GROUP BY event_id),
m_metrics_long AS (
  SELECT c.event_id, c.ipo_date, c.ipo_symbol, c.company_name, c.exchange,
         coalesce(nullif(trim(c.industry), ''), 'Not available') AS industry,
         coalesce(nullif(trim(c.sector), ''), 'Not available') AS sector,
         c.price_vendor, c.price_symbol, c.coverage_status, c.is_analysis_ready,
         s.n_days, s.first_close, s.last_close, s.min_close, s.max_close,
         CASE WHEN s.first_close IS NULL OR s.last_close IS NULL OR s.first_close = 0 THEN NULL
              ELSE CAST(s.last_close - s.first_close AS DOUBLE) / CAST(s.first_close AS DOUBLE) END AS return_100d,
         CASE WHEN s.first_close IS NULL OR s.max_close IS NULL OR s.first_close = 0 THEN NULL
              ELSE CAST(s.max_close - s.first_close AS DOUBLE) / CAST(s.first_close AS DOUBLE) END AS max_gain_100d,
         CASE WHEN s.first_close IS NULL OR s.min_close IS NULL OR s.first_close = 0 THEN NULL
              ELSE CAST(s.min_close - s.first_close AS DOUBLE) / CAST(s.first_close AS DOUBLE) END AS max_drawdown_100d
  FROM m_coverage c LEFT JOIN m_close_stats s ON s.event_id = c.event_id),
m_bench_base AS (
  SELECT coalesce(nullif(trim(industry), ''), 'Not available') AS industry,
         coalesce(nullif(trim(sector), ''), 'Not available') AS sector, exchange, n_days,
         {ratio19(hi('last_close - first_close'), hi('first_close'))} AS r,
         {ratio19(hi('max_close - first_close'), hi('first_close'))} AS g,
         {ratio19(hi('min_close - first_close'), hi('first_close'))} AS dd
  FROM m_metrics_long
  WHERE return_100d IS NOT NULL AND coverage_status IN ('partial_coverage', 'good_coverage')),
m_bench_long AS (
  SELECT industry, sector, exchange, count(*) AS cohort_size,
         {rdiv('sum(r)', f'count(r) * {E19}', 4)} AS avg_return_100d,
         {rdiv('sum(g)', f'count(g) * {E19}', 4)} AS avg_max_gain_100d,
         {rdiv('sum(dd)', f'count(dd) * {E19}', 4)} AS avg_max_drawdown_100d,
         {rdiv('CAST(sum(n_days) AS HUGEINT)', 'count(n_days)', 2)} AS avg_price_days
  FROM m_bench_base GROUP BY industry, sector, exchange),
m_short_stats AS (
  SELECT event_id, count(DISTINCT price_date) AS price_days, min(price_date) AS first_price_date,
         max(price_date) AS last_price_date,
         arg_min_null(close, price_date) AS first_close_30d, arg_max_null(close, price_date) AS last_close_30d,
         CASE WHEN count(close) > 0 THEN CAST(sum(close) AS DOUBLE) / count(close) END AS avg_close_30d,
         min(close) AS min_close_30d, max(close) AS max_close_30d
  FROM m_win_short GROUP BY event_id),
m_metrics_short AS (
  SELECT i.event_id, i.ipo_date, i.ipo_symbol, i.price_symbol, i.industry, i.sector,
         coalesce(s.price_days, 0) AS price_days, s.first_price_date, s.last_price_date,
         s.first_close_30d, s.last_close_30d, s.avg_close_30d, s.min_close_30d, s.max_close_30d,
         CASE WHEN s.first_close_30d IS NOT NULL AND s.last_close_30d IS NOT NULL AND s.first_close_30d <> 0
              THEN {hi('s.last_close_30d - s.first_close_30d')} * 100 END AS ret_num,
         CASE WHEN s.first_close_30d <> 0 THEN {hi('s.first_close_30d')} END AS ret_den,
         CASE WHEN coalesce(s.price_days, 0) >= {g30} THEN 'good_coverage'
              WHEN coalesce(s.price_days, 0) >= {p30} THEN 'partial_coverage'
              WHEN coalesce(s.price_days, 0) >= {l30} THEN 'very_low_coverage' ELSE 'no_prices' END AS coverage_status_30d
  FROM m_listings i LEFT JOIN m_short_stats s ON s.event_id = i.event_id),
m_metrics_short2 AS (
  SELECT * EXCLUDE (ret_num, ret_den),
         CASE WHEN ret_num IS NOT NULL THEN sign(ret_num) * sign(ret_den) * ((abs(ret_num) * 200 + abs(ret_den)) // (2 * abs(ret_den))) END AS ret_cents
  FROM m_metrics_short),
m_metrics_30 AS (
  SELECT * EXCLUDE (ret_cents), CAST(ret_cents AS DOUBLE) / 100 AS return_30d_pct, ret_cents
  FROM m_metrics_short2),
m_cov_summary_30 AS (
  SELECT coverage_status_30d AS coverage_status, count(*) AS ipo_count, count(industry) AS with_industry,
         count(sector) AS with_sector, {rdiv('CAST(sum(price_days) AS HUGEINT)', 'count(price_days)', 2)} AS avg_price_days
  FROM m_metrics_30 GROUP BY coverage_status_30d),
m_bench_30 AS (
  SELECT coalesce(industry, 'Unknown') AS industry, count(*) AS ipo_count,
         {rdiv('CAST(sum(ret_cents) AS HUGEINT)', 'count(ret_cents) * 100', 2)} AS avg_return_30d_pct,
         {rdiv('CAST(sum(price_days) AS HUGEINT)', 'count(price_days)', 2)} AS avg_price_days
  FROM m_metrics_30 WHERE price_days >= {g30} AND ret_cents IS NOT NULL
  GROUP BY coalesce(industry, 'Unknown'))"""


# Incremental-load scenario: the store already holds bars up to this date;
# the vendor feed ("staged") is the whole derived price table.
LOAD_CUTOFF = dt.date(2001, 4, 15)
FAILED_SUFFIX = "7"   # vendor series whose download fails in that scenario

_EQ = "regexp_full_match(upper({s}), '[A-Z0-9]{{1,5}}') AND NOT regexp_matches(upper({s}), '[UWR]$')"


def worklist_ctes(p: Params = DEFAULT_PARAMS) -> str:
    a = p.as_of
    lo = a - dt.timedelta(days=p.worklist_recent_days)
    N = p.long_window

    def pairs(v):
        return f"""
w_pairs_{v} AS (
  SELECT upper(e.symbol) AS ipo_symbol, m.vendor_symbol, e.ipo_date
  FROM raw_events e JOIN raw_map m ON m.vendor = '{v}' AND m.ipo_symbol = upper(e.symbol)
  WHERE m.is_priceable AND m.vendor_symbol IS NOT NULL AND e.ipo_date IS NOT NULL AND e.ipo_date <= {_d(a)}
    AND {_EQ.format(s='e.symbol')} AND e.ipo_date >= {_d(lo)}
  GROUP BY 1, 2, 3)"""

    def windows(name, src, wl):
        return f"""
{name} AS (
  SELECT *, CASE WHEN ipo_date > load_to THEN 'not_listed_yet' WHEN load_from > load_to THEN 'up_to_date'
                 ELSE 'load' END AS load_status
  FROM (SELECT w.*, least(w.ipo_date + {N}, {_d(a)}) AS load_to, h.hwm,
               greatest(h.hwm + 1, w.ipo_date) AS load_from, '{src}' AS source
        FROM {wl} w LEFT JOIN w_hwm h ON h.source = '{src}' AND h.symbol = w.vendor_symbol))"""

    return f"""
w_recent AS (
  SELECT DISTINCT upper(symbol) AS symbol FROM raw_events
  WHERE symbol IS NOT NULL AND symbol <> '' AND {_EQ.format(s='symbol')} AND ipo_date >= {_d(lo)}),""" + \
        pairs("yahoo") + "," + pairs("alphavantage") + f""",
w_existing AS (SELECT * FROM raw_prices WHERE price_date <= {_d(LOAD_CUTOFF)}),
w_hwm AS (SELECT source, symbol, max(price_date) AS hwm FROM w_existing WHERE price_date >= {_d(lo)} GROUP BY source, symbol),""" + \
        windows("w_load_all", "yahoo", "w_pairs_yahoo")


MAIN_TURNS = "SELECT ipo_symbol, vendor_symbol, ipo_date, row_number() OVER (ORDER BY ipo_date DESC, ipo_symbol, vendor_symbol) AS pos FROM w_pairs_yahoo"


def load_ctes(p: Params = DEFAULT_PARAMS, turns: str = MAIN_TURNS) -> str:
    """The price load as a loop, one listing of a series after the other: each
    turn reads the mark the turn before left and moves it to its newest bar.
    ``turns``: ipo_symbol, vendor_symbol, ipo_date and pos of the listings."""
    a = p.as_of
    lo = a - dt.timedelta(days=p.worklist_recent_days)

    def loop(seq, src):
        return f"""
{seq}_loop AS (
  SELECT q.vendor_symbol, CAST(0 AS BIGINT) AS n, h.hwm AS mark, CAST(NULL AS BIGINT) AS pos,
         CAST(NULL AS DATE) AS load_from, CAST(NULL AS DATE) AS load_to
  FROM (SELECT DISTINCT vendor_symbol FROM {seq}) q
  LEFT JOIN w_hwm h ON h.source = '{src}' AND h.symbol = q.vendor_symbol
  UNION ALL
  SELECT l.vendor_symbol, l.n + 1,
         coalesce((SELECT max(s.price_date) FROM w_staged s WHERE s.source = '{src}' AND s.symbol = l.vendor_symbol
                   AND NOT q.down AND s.price_date >= greatest(l.mark + 1, q.ipo_date) AND s.price_date <= q.load_to),
                  l.mark), q.pos, greatest(l.mark + 1, q.ipo_date), q.load_to
  FROM {seq}_loop l JOIN {seq} q ON q.vendor_symbol = l.vendor_symbol AND q.n = l.n + 1),
{seq}_bars AS (
  SELECT q.pos, q.ipo_symbol, q.listing_symbol, q.ipo_date, s.*
  FROM {seq}_loop l JOIN {seq} q ON q.pos = l.pos
  JOIN w_staged s ON s.source = '{src}' AND s.symbol = q.vendor_symbol
   AND s.price_date >= l.load_from AND s.price_date <= l.load_to
  WHERE NOT q.down),
{seq}_failed AS (
  SELECT q.pos FROM {seq}_loop l JOIN {seq} q ON q.pos = l.pos WHERE q.down AND l.load_from <= l.load_to)"""

    return f"""
w_staged AS MATERIALIZED (
  SELECT source, symbol, price_date, open, high, low, close, volume FROM raw_prices
  WHERE price_date BETWEEN {_d(lo)} AND {_d(a)}),
w_pos AS (
  SELECT ipo_symbol, vendor_symbol AS listing_symbol, ipo_date, least(ipo_date + {p.long_window}, {_d(a)}) AS load_to, pos
  FROM ({turns})),
w_y AS (
  SELECT *, listing_symbol AS vendor_symbol, listing_symbol LIKE '%{FAILED_SUFFIX}' AS down,
         row_number() OVER (PARTITION BY listing_symbol ORDER BY pos) AS n
  FROM w_pos WHERE ipo_date <= load_to),""" + loop("w_y", "yahoo") + f""",
w_a AS (
  SELECT w.*, m.vendor_symbol, m.vendor_symbol LIKE '%{FAILED_SUFFIX}' AS down,
         row_number() OVER (PARTITION BY m.vendor_symbol ORDER BY w.pos) AS n
  FROM w_pos w JOIN raw_map m ON m.vendor = 'alphavantage' AND m.is_priceable AND m.ipo_symbol = w.ipo_symbol
  WHERE w.ipo_date <= w.load_to AND m.vendor_symbol <> '' AND w.pos NOT IN (SELECT pos FROM w_y_bars)),""" + \
        loop("w_a", "alphavantage") + """,
w_loaded AS (SELECT * FROM w_y_bars UNION ALL SELECT * FROM w_a_bars),
w_turns AS (
  SELECT w.pos, coalesce(r.n, 0) AS n, CAST(yf.pos IS NOT NULL AS INT) AS y_fail, CAST(af.pos IS NOT NULL AS INT) AS a_fail,
         CAST(w.ipo_date <= w.load_to AND yf.pos IS NULL AS INT) AS y_used,
         CAST(q.pos IS NOT NULL AND af.pos IS NULL AS INT) AS a_used
  FROM w_pos w LEFT JOIN (SELECT pos, count(*) AS n FROM w_loaded GROUP BY pos) r ON r.pos = w.pos
  LEFT JOIN w_y_failed yf ON yf.pos = w.pos LEFT JOIN w_a_failed af ON af.pos = w.pos
  LEFT JOIN w_a q ON q.pos = w.pos)"""


def _loads(final_select: str, p: Params) -> str:
    return load_ctes(p).strip() + ",\n" if "w_loaded" in final_select or "w_turns" in final_select else ""


def sql_fmt(template: str, **parts: str) -> str:
    """Fill a fixed text template with SQL string expressions."""
    import re
    out, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        out.append("'" + template[pos:m.start()].replace("'", "''") + "'")
        out.append(f"CAST(({parts[m.group(1)]}) AS VARCHAR)")
        pos = m.end()
    out.append("'" + template[pos:].replace("'", "''") + "'")
    return "(" + " || ".join(out) + ")"


def dec2(x: str) -> str:
    return f"CAST(CAST(({x}) AS DECIMAL(38,2)) AS VARCHAR)"


def serving_ctes(p: Params = DEFAULT_PARAMS) -> str:
    g, pa, lo = p.short_limits
    return f"""
d_enriched AS (
  SELECT event_id, ipo_date, ipo_symbol, price_symbol, coalesce(industry, 'Unknown') AS industry,
         coalesce(sector, 'Unknown') AS sector, price_days, first_price_date, last_price_date,
         first_close_30d, last_close_30d, avg_close_30d, min_close_30d, max_close_30d, return_30d_pct,
         ret_cents, coverage_status_30d,
         CASE WHEN price_days >= {g} THEN 'good_coverage' WHEN price_days >= {pa} THEN 'partial_coverage'
              WHEN price_days >= {lo} THEN 'very_low_coverage' ELSE 'no_prices' END AS coverage_band,
         CASE WHEN first_close_30d IS NULL OR first_close_30d = 0 THEN NULL
              ELSE (CAST(max_close_30d AS DOUBLE) - CAST(min_close_30d AS DOUBLE)) / CAST(first_close_30d AS DOUBLE) * 100.0
         END AS price_range_pct_30d
  FROM m_metrics_30),
d_filtered AS (
  SELECT * FROM d_enriched),
d_strong AS (SELECT * FROM d_filtered WHERE price_days >= {g} AND ret_cents IS NOT NULL)"""


def on_stored_tables(final_select: str, p: Params = DEFAULT_PARAMS) -> str:
    """The same statement over views ``raw_events raw_prices raw_map
    raw_profiles`` (e.g. the stored raw tables) instead of re-deriving them."""
    return ("WITH RECURSIVE " + model_ctes(p).strip() + ",\n" + worklist_ctes(p).strip() + ",\n"
            + _loads(final_select, p) + serving_ctes(p).strip() + "\n" + final_select)


def with_ctes(final_select: str, p: Params = DEFAULT_PARAMS) -> str:
    return ("WITH RECURSIVE " + fixture_ctes(p).strip() + ",\n" + model_ctes(p).strip() + ",\n"
            + worklist_ctes(p).strip() + ",\n" + _loads(final_select, p) + serving_ctes(p).strip() + "\n" + final_select)
