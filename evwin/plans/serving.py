"""Serving queries D01-D24: the dashboard's data work as distributed
aggregates over the 30-day metrics.  Charts and widgets are not built; every
panel is a DataFrame.  Means that are displayed rounded are computed exactly
(decimal sum / count, one half-away-from-zero rounding) [design: pandas
rounds half-even on the binary value, so the two can differ on exact ties]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evwin.functions.exprs import coverage_class_short, round_avg
from evwin.plans.models import short_class_rank

# --- fixed values (dashboard texts) -------------------------------------------
NO_ROWS_TEXT = "No IPOs match the current filters."
SUMMARY_TEXT = ("Out of {total} IPOs in the filtered dataset, {with_any} ({pct_any}%) have at least one "
                "retrieved price observation. {good} IPOs ({pct_good}%) have strong coverage in the first "
                "30 calendar days after IPO, defined as at least 15 observed trading days. {partial} IPOs "
                "have partial 7–14 day coverage, {weak} have only 1–6 days, and {none} currently "
                "have no retrieved prices. {perf}")
PERF_NONE = ("There are currently no strongly covered IPOs with usable return metrics under the "
             "selected filters.")
PERF_POS = "Among strongly covered IPOs, the average 30-day return is {avg}%."
PERF_NEG = ("Among strongly covered IPOs, the average 30-day return is {avg}%, indicating weak "
            "short-term post-IPO performance.")
INDUSTRY_NONE = ("No industry-level performance insight is available under the current filters because "
                 "there are no strongly covered IPOs with returns.")
INDUSTRY_TEXT = ("Best-performing industry in the current filtered view: {top} (avg 30D return {top_avg}%, "
                 "{top_n} IPOs). Weakest industry: {bottom} (avg 30D return {bottom_avg}%, {bottom_n} IPOs).")
VERDICT_POS = ("{sym} has strong short-term coverage and a positive 30-day return of {ret}%. This makes it "
               "suitable for comparative post-IPO analysis.")
VERDICT_NEG = ("{sym} has strong short-term coverage but a negative 30-day return of {ret}%. It is suitable "
               "for analysis and may indicate weak early aftermarket performance.")
VERDICT_PARTIAL = ("{sym} has only partial coverage ({days} trading days). It can support directional "
                   "analysis, but should be treated cautiously in benchmarking.")
VERDICT_MINIMAL = ("{sym} has minimal price coverage ({days} trading days). It is not reliable for "
                   "benchmarking.")
VERDICT_NONE = "{sym} currently has no retrieved prices, so performance analysis is not available."
DETAIL_FIELDS = (("Event ID", "event_id"), ("IPO Date", "ipo_date"), ("Price Symbol", "price_symbol"),
                 ("Industry", "industry"), ("Sector", "sector"), ("Price Days", "price_days"),
                 ("First Price Date", "first_price_date"), ("Last Price Date", "last_price_date"),
                 ("First Close 30D", "first_close_30d"), ("Last Close 30D", "last_close_30d"),
                 ("Average Close 30D", "avg_close_30d"), ("Min Close 30D", "min_close_30d"),
                 ("Max Close 30D", "max_close_30d"), ("Price Range % 30D", "price_range_pct_30d"))
STRONG_DAYS = 15
# -----------------------------------------------------------------------------

FEED_COLUMNS = ["event_id", "ipo_date", "ipo_symbol", "price_symbol", "industry", "sector", "price_days",
                "first_price_date", "last_price_date", "first_close_30d", "last_close_30d", "avg_close_30d",
                "min_close_30d", "max_close_30d", "return_30d_pct", "coverage_status_30d"]
RANK_COLUMNS = ["ipo_symbol", "industry", "sector", "price_days", "return_30d_pct", "price_range_pct_30d"]


def _fmt(template: str, **parts: Column) -> Column:
    """Fill a fixed text template with string columns (concat, JVM-side)."""
    import re
    out, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        out.append(F.lit(template[pos:m.start()]))
        out.append(parts[m.group(1)].cast("string"))
        pos = m.end()
    out.append(F.lit(template[pos:]))
    return F.concat(*out)


def _py_float_text(c: Column) -> Column:
    """str() of Python's round(x, 2) for a 2-dp decimal: '45.50' -> '45.5'."""
    return F.regexp_replace(c.cast("string"), "0$", "")


def _dec2(c: Column) -> Column:
    return c.cast("decimal(38,2)").cast("string")


# D01-D03
def metrics_feed(metrics: DataFrame) -> DataFrame:
    return metrics.select(*FEED_COLUMNS).orderBy(F.col("ipo_date").desc(), "event_id")


def coverage_feed(summary: DataFrame) -> DataFrame:
    return summary.orderBy(short_class_rank(F.col("coverage_status")))


def benchmark_feed(bench: DataFrame) -> DataFrame:
    return bench.orderBy(F.col("ipo_count").desc(), "industry")


# D04
def dates_coerced(df: DataFrame, cols=("ipo_date", "first_price_date", "last_price_date")) -> DataFrame:
    """Coerce the listed columns to dates; unparseable text -> NULL; columns
    that are absent are skipped."""
    out = df
    types = dict(df.dtypes)
    for c in cols:
        if c not in types:
            continue
        if types[c] == "string":
            out = out.withColumn(c, F.expr(f"try_to_date(`{c}`)"))
        elif types[c] != "date":
            out = out.withColumn(c, F.col(c).cast("date"))
    return out


# D05
def metrics_enriched(metrics: DataFrame, limits=(15, 7, 1)) -> DataFrame:
    first, mx, mn = F.col("first_close_30d"), F.col("max_close_30d"), F.col("min_close_30d")
    days = F.coalesce(F.col("price_days"), F.lit(0)).cast("bigint")
    rng = F.when(first.isNull() | (first == 0), F.lit(None).cast("double")) \
        .otherwise((mx.cast("double") - mn.cast("double")) / first.cast("double") * F.lit(100.0))
    return (dates_coerced(metrics)
            .withColumn("industry", F.coalesce(F.col("industry"), F.lit("Unknown")))
            .withColumn("sector", F.coalesce(F.col("sector"), F.lit("Unknown")))
            .withColumn("price_days", days)
            .withColumn("coverage_band", coverage_class_short(days, limits))
            .withColumn("price_range_pct_30d", rng))


# D06
def filter_domains(enriched: DataFrame) -> DataFrame:
    vals = (enriched.select(F.lit("industry").alias("domain"), F.col("industry").alias("value"))
            .unionByName(enriched.select(F.lit("sector").alias("domain"), F.col("sector").alias("value")))
            .filter(F.col("value").isNotNull()).distinct()
            .withColumn("is_all", F.lit(False)))
    alls = enriched.sparkSession.createDataFrame([("industry", "All", True), ("sector", "All", True)],
                                                 "domain string, value string, is_all boolean")
    return vals.unionByName(alls).orderBy("domain", F.col("is_all").desc(), "value")


# D07
def metrics_filtered(enriched: DataFrame, *, industry: str = "All", sector: str = "All",
                     band: str = "All", min_return: float | None = None,
                     max_return: float | None = None) -> DataFrame:
    """Listings without a return pass any bound."""
    df = enriched
    if industry != "All":
        df = df.filter(F.col("industry") == industry)
    if sector != "All":
        df = df.filter(F.col("sector") == sector)
    if band != "All":
        df = df.filter(F.col("coverage_band") == band)
    r = F.col("return_30d_pct")
    if min_return is not None:
        df = df.filter(r.isNull() | (r >= F.lit(min_return)))
    if max_return is not None:
        df = df.filter(r.isNull() | (r <= F.lit(max_return)))
    return df


def _strong_returns(df: DataFrame) -> DataFrame:
    return df.filter((F.col("price_days") >= STRONG_DAYS) & F.col("return_30d_pct").isNotNull())


# D08
def kpis(filtered: DataFrame) -> DataFrame:
    d, r = F.col("price_days"), F.col("return_30d_pct")
    strong_r = F.when(d >= STRONG_DAYS, r)
    agg = filtered.agg(
        F.count(F.lit(1)).alias("ipos"),
        F.count_if(d >= 1).alias("with_any_prices"),
        F.count_if(d >= STRONG_DAYS).alias("good_coverage"),
        round_avg(F.sum(d), F.count(d), 2).alias("avg_price_days"),
        round_avg(F.sum(strong_r), F.count(strong_r), 2, "decimal(28,2)").alias("avg_return_30d_pct"))
    return agg.select(
        "*",
        F.coalesce(_dec2(F.col("avg_price_days")), F.lit("n/a")).alias("avg_price_days_text"),
        F.coalesce(F.concat(_dec2(F.col("avg_return_30d_pct")), F.lit("%")), F.lit("n/a"))
        .alias("avg_return_text"))


# D09
def executive_summary(filtered: DataFrame) -> DataFrame:
    d, r = F.col("price_days"), F.col("return_30d_pct")
    strong_r = F.when(d >= STRONG_DAYS, r)
    a = filtered.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(d >= 1).alias("with_any"),
        F.count_if(d >= STRONG_DAYS).alias("good"),
        F.count_if((d >= 7) & (d < STRONG_DAYS)).alias("partial"),
        F.count_if((d >= 1) & (d < 7)).alias("weak"),
        F.count_if(d == 0).alias("no_prices"),
        round_avg(F.sum(strong_r), F.count(strong_r), 2, "decimal(28,2)").alias("avg_return_30d_pct"))
    tot = F.col("total")
    pct_any = round_avg(F.col("with_any") * 100, tot, 2)
    pct_good = round_avg(F.col("good") * 100, tot, 2)
    avg = F.col("avg_return_30d_pct")
    perf = (F.when(avg.isNull(), F.lit(PERF_NONE))
            .when(avg >= 0, _fmt(PERF_POS, avg=_dec2(avg)))
            .otherwise(_fmt(PERF_NEG, avg=_dec2(avg))))
    text = F.when(tot == 0, F.lit(NO_ROWS_TEXT)).otherwise(_fmt(
        SUMMARY_TEXT, total=tot, with_any=F.col("with_any"), pct_any=_py_float_text(pct_any),
        good=F.col("good"), pct_good=_py_float_text(pct_good), partial=F.col("partial"),
        weak=F.col("weak"), none=F.col("no_prices"), perf=perf))
    return a.select("*", pct_any.alias("pct_any"), pct_good.alias("pct_good"), text.alias("summary"))


def _industry_means(filtered: DataFrame) -> DataFrame:
    return (_strong_returns(filtered).groupBy("industry")
            .agg(F.count(F.lit(1)).alias("ipo_count"),
                 F.sum("return_30d_pct").alias("_s"), F.count("return_30d_pct").alias("_n"))
            .select("industry", "ipo_count",
                    (F.col("_s").cast("decimal(28,2)") / F.col("_n").cast("decimal(20,0)")).alias("_avg"),
                    round_avg(F.col("_s"), F.col("_n"), 2, "decimal(28,2)").alias("avg_return_30d_pct")))


# D10
def best_worst_industry(filtered: DataFrame) -> DataFrame:
    """pandas order: mean desc, count desc, then groupby order (industry asc);
    the last row of that order is the weakest.  Both ends are distributed
    top-1s over the per-industry aggregate."""
    g = _industry_means(filtered)
    top = g.orderBy(F.col("_avg").desc(), F.col("ipo_count").desc(), "industry").limit(1)
    bot = g.orderBy(F.col("_avg").asc(), F.col("ipo_count").asc(), F.col("industry").desc()).limit(1)
    t = top.select(F.lit(1).alias("_j"), F.col("industry").alias("top_industry"),
                   F.col("avg_return_30d_pct").alias("top_avg_return_30d_pct"),
                   F.col("ipo_count").alias("top_ipo_count"))
    b = bot.select(F.lit(1).alias("_j"), F.col("industry").alias("bottom_industry"),
                   F.col("avg_return_30d_pct").alias("bottom_avg_return_30d_pct"),
                   F.col("ipo_count").alias("bottom_ipo_count"))
    one = filtered.sparkSession.range(1).select(F.lit(1).alias("_j"))
    j = one.join(t, "_j", "left").join(b, "_j", "left").drop("_j")
    msg = F.when(F.col("top_industry").isNull(), F.lit(INDUSTRY_NONE)).otherwise(_fmt(
        INDUSTRY_TEXT, top=F.col("top_industry"), top_avg=_dec2(F.col("top_avg_return_30d_pct")),
        top_n=F.col("top_ipo_count"), bottom=F.col("bottom_industry"),
        bottom_avg=_dec2(F.col("bottom_avg_return_30d_pct")), bottom_n=F.col("bottom_ipo_count")))
    return j.select("*", msg.alias("message"))


# D11-D13
def band_distribution(filtered: DataFrame) -> DataFrame:
    return (filtered.groupBy("coverage_band").agg(F.count(F.lit(1)).alias("ipo_count"))
            .orderBy(F.col("ipo_count").desc(), "coverage_band"))


def price_days_histogram(filtered: DataFrame, width: int = 2) -> DataFrame:
    """[design] fixed-width bins (the chart library chose its own edges)."""
    b = F.floor(F.col("price_days") / F.lit(width)).cast("bigint")
    return (filtered.groupBy((b * width).alias("bin_start"))
            .agg(F.count(F.lit(1)).alias("ipo_count"))
            .withColumn("bin_end", F.col("bin_start") + F.lit(width - 1))
            .orderBy("bin_start"))


def top_sectors(filtered: DataFrame, k: int = 15) -> DataFrame:
    return (filtered.filter(F.col("sector").isNotNull()).groupBy("sector")
            .agg(F.count(F.lit(1)).alias("ipo_count"))
            .orderBy(F.col("ipo_count").desc(), "sector").limit(k))


# D14-D18
def top_returns(filtered: DataFrame, k: int = 10) -> DataFrame:
    return (_strong_returns(filtered).orderBy(F.col("return_30d_pct").desc(), "ipo_symbol", "event_id")
            .limit(k).select(*RANK_COLUMNS))


def bottom_returns(filtered: DataFrame, k: int = 10) -> DataFrame:
    return (_strong_returns(filtered).orderBy(F.col("return_30d_pct").asc(), "ipo_symbol", "event_id")
            .limit(k).select(*RANK_COLUMNS))


def return_ranking(filtered: DataFrame) -> DataFrame:
    return (filtered.filter(F.col("price_days") >= STRONG_DAYS)
            .orderBy(F.col("return_30d_pct").desc_nulls_last(), "ipo_symbol")
            .select("ipo_symbol", "return_30d_pct", "industry", "sector", "price_days"))


def return_vs_coverage(filtered: DataFrame) -> DataFrame:
    return _strong_returns(filtered).select("price_days", "return_30d_pct", "industry", "ipo_symbol", "sector")


def top_ranges(filtered: DataFrame, k: int = 15) -> DataFrame:
    return (filtered.filter((F.col("price_days") >= STRONG_DAYS) & F.col("price_range_pct_30d").isNotNull())
            .orderBy(F.col("price_range_pct_30d").desc(), "ipo_symbol", "event_id").limit(k)
            .select("ipo_symbol", "price_range_pct_30d", "industry", "sector", "return_30d_pct"))


# D19-D21
def benchmarks_by_return(bench: DataFrame) -> DataFrame:
    return bench.orderBy(F.col("avg_return_30d_pct").desc(), "industry")


def industry_scale(bench: DataFrame) -> DataFrame:
    return bench.select("ipo_count", "avg_return_30d_pct", "avg_price_days", "industry")


def sector_scan(filtered: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Mean and exact median per (industry, sector).  The median is the mean
    of the lower and upper discrete medians, taken on integer cents (Spark's
    percentile_disc returns DOUBLE, exact for integers); each is a
    percentile aggregate whose buffer holds one entry per distinct return,
    bounded by the value domain, not by the group size.  With ``accuracy`` the
    medians come from mergeable quantile summaries of bounded size instead:
    their rank is off by at most 1 / accuracy of the group, so by nothing where
    a group is small beside the accuracy."""
    r = F.col("return_30d_pct")
    if accuracy is None:
        lo, hi = (F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY _rc{d})") for d in ("", " DESC"))
    else:
        lo, hi = F.percentile_approx("_rc", 0.5, accuracy), -F.percentile_approx(-F.col("_rc"), 0.5, accuracy)
    return (_strong_returns(filtered).withColumn("_rc", (r * 100).cast("bigint"))
            .groupBy("industry", "sector").agg(
                F.count(F.lit(1)).alias("ipo_count"),
                (F.sum(r).cast("double") / F.count(r)).alias("avg_return_30d_pct"),
                lo.alias("_lo"), hi.alias("_hi"),
                (F.sum("price_days").cast("double") / F.count("price_days")).alias("avg_price_days"))
            .select("industry", "sector", "ipo_count", "avg_return_30d_pct",
                    ((F.col("_lo") + F.col("_hi")) / F.lit(200.0)).alias("median_return_30d_pct"),
                    "avg_price_days")
            .orderBy(F.col("avg_return_30d_pct").desc(), F.col("ipo_count").desc(), "industry", "sector"))


# D22
def _text(c: Column, dtype: str) -> Column:
    """Field value as text; doubles as exact 6-decimal strings so that both
    engines print them alike."""
    if dtype == "double":
        return F.round(c, 6).cast("decimal(38,6)").cast("string")
    return c.cast("string")


def listing_symbols(filtered: DataFrame) -> DataFrame:
    """The symbols to choose a detail from, sorted, each once."""
    return filtered.filter(F.col("ipo_symbol").isNotNull()).select("ipo_symbol").distinct().orderBy("ipo_symbol")


def listing_detail(filtered: DataFrame, symbol: str | None = None) -> DataFrame:
    """Per symbol (or just ``symbol``), the newest listing as (field, value)
    rows.  The dashboard shows the first symbol of the sorted list."""
    df = filtered if symbol is None else filtered.filter(F.col("ipo_symbol") == symbol)
    w = Window.partitionBy("ipo_symbol").orderBy(F.col("ipo_date").desc(), "event_id")
    row = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    types = dict(df.dtypes)
    kv = [F.struct(F.lit(i).alias("pos"), F.lit(label).alias("field"),
                   _text(F.col(c), types[c]).alias("value"))
          for i, (label, c) in enumerate(DETAIL_FIELDS)]
    long = row.select("ipo_symbol", F.explode(F.array(*kv)).alias("kv"))
    return long.select("ipo_symbol", F.col("kv.pos").alias("pos"), F.col("kv.field").alias("field"),
                       F.col("kv.value").alias("value"))


# D23
def listing_verdict(filtered: DataFrame) -> DataFrame:
    d, r, s = F.col("price_days"), F.col("return_30d_pct"), F.col("ipo_symbol")
    strong = (d >= STRONG_DAYS) & r.isNotNull()
    verdict = (F.when(strong & (r > 0), "positive").when(strong, "negative").when(d >= 7, "partial")
               .when(d >= 1, "minimal").otherwise("none"))
    msg = (F.when(strong & (r > 0), _fmt(VERDICT_POS, sym=s, ret=_dec2(r)))
           .when(strong, _fmt(VERDICT_NEG, sym=s, ret=_dec2(r)))
           .when(d >= 7, _fmt(VERDICT_PARTIAL, sym=s, days=d))
           .when(d >= 1, _fmt(VERDICT_MINIMAL, sym=s, days=d))
           .otherwise(_fmt(VERDICT_NONE, sym=s)))
    return filtered.select("event_id", "ipo_symbol", verdict.alias("verdict"), msg.alias("message"))


# D24
def listing_table(filtered: DataFrame) -> DataFrame:
    return (filtered.select("ipo_date", "ipo_symbol", "price_symbol", "industry", "sector", "price_days",
                            "coverage_band", "first_close_30d", "last_close_30d", "return_30d_pct",
                            "price_range_pct_30d")
            .orderBy(F.col("price_days").desc(), F.col("ipo_date").desc(), "ipo_symbol"))
