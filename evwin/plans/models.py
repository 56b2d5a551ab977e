"""Model layer M01-M14: listings, precedence, the post-listing price windows,
coverage, return metrics and cohort benchmarks.  All functions are lazy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evwin.config import DEFAULT_PARAMS, Params
from evwin.functions.exprs import (coverage_class_long, coverage_class_short, distinct_days,
                                   guarded_ratio, is_us_listing, label_or, letters_shape, lit_date, price_date_range,
                                   pct_return_2dp, rank_by, round_avg)
from evwin.operators.precedence import top1
from evwin.operators.price_days import days_of
from evwin.operators.window_join import touched_months, window_join
from evwin.sources.raw import code_version, publish, with_month

# --- fixed values ------------------------------------------------------------
VENDOR_RANK = ("alphavantage", "yahoo")          # symbol map, priceable first
PROFILE_RANK = ("finnhub", "yahoo")              # profiles: industry, sector, any
PRICE_SOURCE_RANK = ("alphavantage", "yahoo")    # per-day price precedence
LONG_STATUSES = ("partial_coverage", "good_coverage")
SHORT_CLASS_ORDER = ("good_coverage", "partial_coverage", "very_low_coverage", "no_prices")
# -----------------------------------------------------------------------------


# ---- M01 / M02: plain projections -------------------------------------------
def view_ipos(events: DataFrame) -> DataFrame:
    return events.select("ipo_date", "symbol", "company_name", "exchange",
                         "price_range_low", "price_range_high", "shares")


def view_prices(prices: DataFrame) -> DataFrame:
    return prices.select("symbol", "price_date", "open", "high", "low", "close", "volume")


# ---- M03: valid listings (regex on the raw symbol, no upper()) -------------
def listings_valid(events: DataFrame) -> DataFrame:
    s = F.col("symbol")
    return (events.filter(s.isNotNull() & (s != "") & letters_shape(s, upper=False)
                          & F.col("ipo_date").isNotNull())
            .select("event_id", "ipo_date", "symbol", "company_name", "exchange",
                    "price_range_low", "price_range_high", "shares", "ingested_at"))


# ---- M04a / M04b: one mapping row and one profile per symbol ---------------
def preferred_symbol_map(symbol_map: DataFrame) -> DataFrame:
    v, p = F.col("vendor"), F.col("is_priceable")
    rank = rank_by([((v == VENDOR_RANK[0]) & (p == True), 1),  # noqa: E712
                    ((v == VENDOR_RANK[1]) & (p == True), 2),  # noqa: E712
                    (v == VENDOR_RANK[0], 3),
                    (v == VENDOR_RANK[1], 4)])
    return top1(symbol_map.select("ipo_symbol", "vendor", "vendor_symbol", "is_priceable",
                                  "notes", "last_checked_at"),
                ["ipo_symbol"], [rank, F.col("last_checked_at").desc_nulls_last(), v])


def preferred_profile(profiles: DataFrame) -> DataFrame:
    s, ind, sec = F.col("source"), F.col("industry"), F.col("sector")
    a, b = PROFILE_RANK
    rank = rank_by([((s == a) & ind.isNotNull(), 1), ((s == b) & ind.isNotNull(), 2),
                    ((s == a) & sec.isNotNull(), 3), ((s == b) & sec.isNotNull(), 4),
                    (s == a, 5), (s == b, 6)])
    return top1(profiles.select("symbol", "source", "industry", "sector", "country",
                                "currency", "market_cap", "weburl"),
                ["symbol"], [rank, s])


# ---- M04: recent US listings with mapping and profile ----------------------
def listings_recent(events: DataFrame, symbol_map: DataFrame, profiles: DataFrame, *,
                    as_of: dt.date, recent_days: int = 180) -> DataFrame:
    sym = F.col("symbol")
    u = F.upper(sym)
    base = (events
            .filter((F.col("ipo_date") >= F.date_sub(lit_date(as_of), recent_days))
                    & sym.isNotNull() & (sym != "") & letters_shape(sym)
                    & ~u.rlike("[UWR]\\z") & is_us_listing(F.col("exchange")))
            .select("event_id", "ipo_date", u.alias("ipo_symbol"), "company_name", "exchange"))
    sm = preferred_symbol_map(symbol_map).select(
        F.col("ipo_symbol").alias("_sm_sym"), F.col("vendor").alias("price_vendor"),
        F.col("vendor_symbol").alias("price_symbol"), F.col("is_priceable").alias("_sm_priceable"))
    pp = preferred_profile(profiles).select(
        F.col("symbol").alias("_pp_sym"), F.col("source").alias("profile_source"),
        "industry", "sector", "country", "currency", "market_cap", "weburl")
    out = (base.join(sm, base["ipo_symbol"] == sm["_sm_sym"], "left")
           .join(pp, F.col("ipo_symbol") == pp["_pp_sym"], "left"))
    return out.select("event_id", "ipo_date", "ipo_symbol", "company_name", "exchange",
                      "price_vendor", "price_symbol",
                      F.coalesce(F.col("_sm_priceable"), F.lit(False)).alias("is_priceable"),
                      "profile_source", "industry", "sector", "country", "currency",
                      "market_cap", "weburl")


# ---- M05a: one price per (symbol, day) ---------------------------------------
def preferred_prices(prices: DataFrame, *, min_date: dt.date | None = None,
                     max_date: dt.date | Column | None = None,
                     wanted: DataFrame | None = None) -> DataFrame:
    """``min_date``, ``max_date`` and ``wanted`` (symbol, month) prune before the
    precedence shuffle; all are safe because the dedupe key (symbol, price_date)
    contains or decides the pruned columns.  The dates reach the parquet scan
    and its partitions; so do the wanted months, while the query runs."""
    p = price_date_range(prices, lo=min_date, hi=max_date)
    if wanted is not None:
        w = wanted.select(F.col("symbol").alias("_psym"), F.col("month").alias("_pmonth")).distinct()
        p = p if "price_month" in p.columns else with_month(p)
        p = p.join(w, (F.col("symbol") == F.col("_psym")) & (F.col("price_month") == F.col("_pmonth")), "left_semi")
    s = F.col("source")
    rank = rank_by([(s == PRICE_SOURCE_RANK[0], 1), (s == PRICE_SOURCE_RANK[1], 2)])
    return top1(p.select("source", "symbol", "price_date", "open", "high", "low", "close", "volume"),
                ["symbol", "price_date"], [rank, s])


# ---- M05 / M06: post-listing price windows ----------------------------------
def window_prices(listings: DataFrame, prices: DataFrame, *, as_of: dt.date,
                  recent_days: int = 180, days: int = 100, bucket_days: int = 32) -> DataFrame:
    """Priceable listings x preferred prices with
    ``ipo_date <= price_date <= ipo_date + days``; ``day_num`` in days."""
    ipos = (listings.filter((F.col("is_priceable") == True) & F.col("price_symbol").isNotNull())  # noqa: E712
            .select("event_id", "ipo_date", "ipo_symbol", "price_symbol", "price_vendor"))
    # Listings are at most recent_days old, so no window starts earlier, and
    # none ends later than the newest listing's.
    last = ipos.select(F.date_add(F.max("ipo_date"), days)).scalar()
    months = F.explode(touched_months(F.col("ipo_date"), F.date_add("ipo_date", days))).alias("month")
    pref = preferred_prices(prices, min_date=as_of - dt.timedelta(days=recent_days), max_date=last,
                            wanted=ipos.select(F.col("price_symbol").alias("symbol"), months))
    j = window_join(ipos, pref, anchor_key="price_symbol", series_key="symbol",
                    anchor_date="ipo_date", series_date="price_date", days=days,
                    bucket_days=bucket_days)
    return j.select("event_id", "ipo_symbol", "ipo_date", "price_symbol",
                    F.col("source").alias("price_source"), "price_date", "open", "high", "low",
                    "close", "volume",
                    F.datediff("price_date", "ipo_date").cast("bigint").alias("day_num"))


def cut_window(window_rows: DataFrame, days: int) -> DataFrame:
    return window_rows.filter((F.col("price_date") >= F.col("ipo_date"))
                              & (F.col("price_date") <= F.date_add("ipo_date", days)))


# ---- M07 ---------------------------------------------------------------------
def dim_industry(listings: DataFrame) -> DataFrame:
    return listings.select(label_or(F.col("industry")).alias("industry"),
                           label_or(F.col("sector")).alias("sector")).distinct()


# ---- M08 / M10: long-window coverage and metrics ------------------------------
def _long_stats(window_rows: DataFrame, days: int = 100) -> DataFrame:
    """One aggregation per listing serves both coverage (all rows) and
    metrics (rows with a close): one shuffle on event_id.  ``day_num`` of
    the rows runs from 0 to ``days``."""
    c, d = F.col("close"), F.col("price_date")
    dated_close = F.when(c.isNotNull(), d)
    return window_rows.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("price_rows"),
        distinct_days(F.col("day_num"), days).alias("distinct_price_days"),
        F.min(d).alias("first_price_date"),
        F.max(d).alias("last_price_date"),
        F.count(c).alias("_n_close"),
        F.min_by(c, dated_close).alias("first_close"),
        F.max_by(c, dated_close).alias("last_close"),
        F.min(c).alias("min_close"),
        F.max(c).alias("max_close"))


def _coverage_wide(listings: DataFrame, window_rows: DataFrame | None, limits=(20, 60), window_days: int = 100,
                   stats: DataFrame | None = None) -> DataFrame:
    st = (_long_stats(window_rows, window_days) if stats is None else stats).withColumnRenamed("event_id", "_eid")
    j = listings.join(st, listings["event_id"] == st["_eid"], "left")
    days = F.coalesce(F.col("distinct_price_days"), F.lit(0))
    return j.select(
        "event_id", "ipo_date", "ipo_symbol", "company_name", "exchange", "industry", "sector",
        "price_vendor", "price_symbol", "is_priceable",
        F.coalesce(F.col("price_rows"), F.lit(0)).alias("price_rows"),
        days.alias("distinct_price_days"), "first_price_date", "last_price_date",
        coverage_class_long(F.col("is_priceable"), F.col("price_symbol"), days, limits)
        .alias("coverage_status"),
        (days >= limits[1]).alias("is_analysis_ready"),
        F.when(F.col("_n_close") > 0, F.col("_n_close")).alias("n_days"),
        "first_close", "last_close", "min_close", "max_close")


COVERAGE_COLUMNS = ["event_id", "ipo_date", "ipo_symbol", "company_name", "exchange", "industry",
                    "sector", "price_vendor", "price_symbol", "is_priceable", "price_rows",
                    "distinct_price_days", "first_price_date", "last_price_date",
                    "coverage_status", "is_analysis_ready"]


def coverage_long(listings: DataFrame, window_rows: DataFrame | None, limits=(20, 60), window_days: int = 100,
                  stats: DataFrame | None = None) -> DataFrame:
    """``stats``: kept per-listing figures (``window_state.long_stats``) instead of window rows."""
    return _coverage_wide(listings, window_rows, limits, window_days, stats).select(*COVERAGE_COLUMNS)


def coverage_summary_long(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("coverage_status").agg(
        F.count(F.lit(1)).alias("ipo_count"),
        F.count_if(F.col("industry").isNotNull()).alias("with_industry"),
        F.count_if(F.col("sector").isNotNull()).alias("with_sector"),
        round_avg(F.sum("distinct_price_days"), F.count("distinct_price_days"), 2)
        .alias("avg_price_days"))


def _ratio_double(num, den):
    """(num - den) / den in binary floating point, from exact decimal inputs:
    the unrounded return as a DOUBLE (bit-identical across engines)."""
    return F.when(den.isNull() | num.isNull() | (den == 0), F.lit(None).cast("double")) \
        .otherwise((num - den).cast("double") / den.cast("double"))


def metrics_long(listings: DataFrame, window_rows: DataFrame | None, limits=(20, 60), window_days: int = 100,
                 stats: DataFrame | None = None) -> DataFrame:
    w = _coverage_wide(listings, window_rows, limits, window_days, stats)
    f = F.col("first_close")
    return w.select(
        "event_id", "ipo_date", "ipo_symbol", "company_name", "exchange",
        label_or(F.col("industry")).alias("industry"), label_or(F.col("sector")).alias("sector"),
        "price_vendor", "price_symbol", "coverage_status", "is_analysis_ready", "n_days",
        "first_close", "last_close", "min_close", "max_close",
        _ratio_double(F.col("last_close"), f).alias("return_100d"),
        _ratio_double(F.col("max_close"), f).alias("max_gain_100d"),
        _ratio_double(F.col("min_close"), f).alias("max_drawdown_100d"))


def benchmarks_long(metrics: DataFrame) -> DataFrame:
    """Cohort averages, rounded exactly: each return is recomputed as an exact
    decimal from the first/last/min/max closes (the same quantity the DOUBLE
    columns show), averaged as sum/count in decimal, rounded once."""
    f = F.col("first_close")
    base = (metrics.filter(F.col("return_100d").isNotNull()
                           & F.col("coverage_status").isin(*LONG_STATUSES))
            .select(label_or(F.col("industry")).alias("industry"),
                    label_or(F.col("sector")).alias("sector"), "exchange", "n_days",
                    guarded_ratio(F.col("last_close"), f).alias("r"),
                    guarded_ratio(F.col("max_close"), f).alias("g"),
                    guarded_ratio(F.col("min_close"), f).alias("dd")))
    exact = "decimal(38,19)"
    return (base.groupBy("industry", "sector", "exchange").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        round_avg(F.sum("r"), F.count("r"), 4, exact).alias("avg_return_100d"),
        round_avg(F.sum("g"), F.count("g"), 4, exact).alias("avg_max_gain_100d"),
        round_avg(F.sum("dd"), F.count("dd"), 4, exact).alias("avg_max_drawdown_100d"),
        round_avg(F.sum("n_days"), F.count("n_days"), 2).alias("avg_price_days"))
        .filter(F.col("cohort_size") >= 1))


# ---- M12-M14: short-window metrics -------------------------------------------
def _short_stats(window_rows: DataFrame, window_days: int = 30) -> DataFrame:
    c, d = F.col("close"), F.col("price_date")
    return window_rows.groupBy("event_id").agg(
        distinct_days(F.col("day_num"), window_days).alias("price_days"),
        F.min(d).alias("first_price_date"),
        F.max(d).alias("last_price_date"),
        F.min_by(c, d).alias("first_close_30d"),   # NULL close on the first day stays NULL
        F.max_by(c, d).alias("last_close_30d"),
        F.sum(c).alias("_sum_close"),
        F.count(c).alias("_n_close"),
        F.min(c).alias("min_close_30d"),
        F.max(c).alias("max_close_30d"))


def metrics_short(listings: DataFrame, window_rows: DataFrame | None, limits=(15, 7, 1), window_days: int = 30,
                  stats: DataFrame | None = None) -> DataFrame:
    """``day_num`` of the window rows runs from 0 to ``window_days``; ``stats``: kept
    per-listing figures (``window_state.short_stats``) instead of window rows."""
    st = (_short_stats(window_rows, window_days) if stats is None else stats).withColumnRenamed("event_id", "_eid")
    j = listings.join(st, listings["event_id"] == st["_eid"], "left")
    days = F.coalesce(F.col("price_days"), F.lit(0))
    first, last = F.col("first_close_30d"), F.col("last_close_30d")
    return j.select(
        "event_id", "ipo_date", "ipo_symbol", "price_symbol", "industry", "sector",
        days.alias("price_days"), "first_price_date", "last_price_date",
        first.alias("first_close_30d"), last.alias("last_close_30d"),
        F.when(F.col("_n_close") > 0,
               F.col("_sum_close").cast("double") / F.col("_n_close").cast("double"))
        .alias("avg_close_30d"),
        "min_close_30d", "max_close_30d",
        pct_return_2dp(first, last).alias("return_30d_pct"),
        coverage_class_short(days, limits).alias("coverage_status_30d"))


def coverage_summary_short(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(F.col("coverage_status_30d").alias("coverage_status")).agg(
        F.count(F.lit(1)).alias("ipo_count"),
        F.count("industry").alias("with_industry"),
        F.count("sector").alias("with_sector"),
        round_avg(F.sum("price_days"), F.count("price_days"), 2).alias("avg_price_days"))


def short_class_rank(c):
    return rank_by([(c == v, i + 1) for i, v in enumerate(SHORT_CLASS_ORDER)], default=5)


def benchmarks_short(metrics: DataFrame, min_days: int = 15) -> DataFrame:
    return (metrics.filter((F.col("price_days") >= min_days) & F.col("return_30d_pct").isNotNull())
            .groupBy(F.coalesce(F.col("industry"), F.lit("Unknown")).alias("industry"))
            .agg(F.count(F.lit(1)).alias("ipo_count"),
                 round_avg(F.sum("return_30d_pct"), F.count("return_30d_pct"), 2,
                           "decimal(28,2)").alias("avg_return_30d_pct"),
                 round_avg(F.sum("price_days"), F.count("price_days"), 2).alias("avg_price_days")))


# ---- the whole model graph ---------------------------------------------------
class ModelGraph:
    """Lazily builds every model from the raw tables with one set of params.
    ``materialize`` names intermediates (listings, the long window) that are
    written to the checkpoint folder once, so later models do not recompute
    the window join.  Models built from another mart (M09, M11, M13, M14) read
    the written one, as marts are tables in the reference."""

    def __init__(self, raw, params: Params = DEFAULT_PARAMS, materialize: tuple = ()):
        self.raw, self.p, self._mat = raw, params, tuple(materialize)
        self._cache: dict[str, DataFrame] = {}

    @property
    def spark(self):
        return self.raw.ipo_events.sparkSession

    def _get(self, name, build):
        if name not in self._cache:
            df = build()
            if name in self._mat:
                df = self._store(name, df)
            self._cache[name] = df
        return self._cache[name]

    def mart(self, name: str) -> DataFrame:
        """The stored (materialized) version of a model, written once: what
        downstream readers such as the dashboard queries read, as marts are
        tables in the reference while staging models are views."""
        key = f"mart:{name}"
        if key not in self._cache:
            self._cache[key] = self._store(name, getattr(self, name))
        return self._cache[key]

    def written(self, name: str, df: DataFrame) -> None:
        """Take ``df`` as the stored version of a model a run has written itself."""
        self._cache[f"mart:{name}"] = df

    def _store(self, name, df):
        """Write a shared intermediate once (next to the raw store when there
        is one, keyed by the parameters) and read it back."""
        import hashlib
        spark = df.sparkSession
        root = getattr(self.raw, "root", None)
        if root is None:
            from evwin.session import materialize
            return materialize(df, name)
        import sys
        from evwin.functions import exprs
        from evwin.operators import precedence, price_days, window_join
        code = code_version(sys.modules[__name__], precedence, price_days, window_join, exprs)
        key = hashlib.sha1(repr((name, code, self.p.as_of, self.p.model_recent_days, self.p.long_window,
                                 self.p.short_window, self.p.long_limits, self.p.short_limits,
                                 self.p.bucket_days)).encode()).hexdigest()[:12]
        path = publish(spark, f"{root}/models/{name}-{key}", lambda tmp: df.write.parquet(f"{tmp}/data"))
        return spark.read.parquet(f"{path}/data")

    @property
    def listings(self):
        r, p = self.raw, self.p
        return self._get("listings", lambda: listings_recent(
            r.ipo_events, r.symbol_map, r.company_profiles,
            as_of=p.as_of, recent_days=p.model_recent_days))

    @property
    def price_days(self):
        """Which days each series has (``operators.price_days``)."""
        p = self.raw.daily_prices
        return self._get("price_days", lambda: days_of(p if "price_month" in p.columns else with_month(p)))

    @property
    def window_long(self):
        p = self.p
        return self._get("window_long", lambda: window_prices(
            self.listings, self.raw.daily_prices, as_of=p.as_of,
            recent_days=p.model_recent_days, days=p.long_window, bucket_days=p.bucket_days))

    @property
    def window_short(self):
        """Cut from the long window where that is stored; else joined at its own length."""
        p = self.p
        if "window_long" in self._mat and p.short_window <= p.long_window:
            return self._get("window_short", lambda: cut_window(self.window_long, p.short_window))
        return self._get("window_short", lambda: window_prices(
            self.listings, self.raw.daily_prices, as_of=p.as_of,
            recent_days=p.model_recent_days, days=p.short_window, bucket_days=p.bucket_days))

    @property
    def coverage(self):
        return self._get("coverage", lambda: coverage_long(self.listings, self.window_long,
                                                           self.p.long_limits, self.p.long_window))

    @property
    def coverage_summary(self):
        return self._get("coverage_summary", lambda: coverage_summary_long(self.mart("coverage")))

    @property
    def metrics_long(self):
        return self._get("metrics_long", lambda: metrics_long(self.listings, self.window_long,
                                                              self.p.long_limits, self.p.long_window))

    @property
    def benchmarks_long(self):
        return self._get("benchmarks_long", lambda: benchmarks_long(self.mart("metrics_long")))

    @property
    def metrics_short(self):
        return self._get("metrics_short", lambda: metrics_short(self.listings, self.window_short,
                                                                self.p.short_limits, self.p.short_window))

    @property
    def coverage_summary_short(self):
        return self._get("coverage_summary_short", lambda: coverage_summary_short(self.mart("metrics_short")))

    @property
    def benchmarks_short(self):
        return self._get("benchmarks_short", lambda: benchmarks_short(self.mart("metrics_short"),
                                                                      self.p.short_limits[0]))

    @property
    def dim_industry(self):
        return self._get("dim_industry", lambda: dim_industry(self.listings))
