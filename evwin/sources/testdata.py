"""Raw tables derived from the TPC-H-ish test tables (FIXTURES.md §2).

The reference ships no data; its five raw tables are rebuilt here from
``part``, ``supplier`` and ``lineitem`` so that every query's work grows with
the given tables.  All derivations are lazy Spark plans: ``part`` gives one
listing per key, ``lineitem`` gives two tick series per line (per supplier
and, denser, per supplier nation) that are aggregated to daily OHLCV bars.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evwin.config import FIXTURE_AS_OF
from evwin.functions.exprs import ts_lit
from evwin.operators.precedence import top1
from evwin.sources.schemas import PRICE_LAYOUT

# --- fixed values (derivation rules of the test inputs) --------------------
EXCHANGES = ("NASDAQ Global", "NYSE", "nyse american", "OTC")  # by k % 4
MAP_LAST_CHECKED = {"alphavantage": dt.datetime(2001, 6, 1), "yahoo": dt.datetime(2001, 6, 2)}
INGESTED_AT = dt.datetime(2001, 6, 30, 8, 0, 0)
# ---------------------------------------------------------------------------


@dataclass
class RawTables:
    ipo_events: DataFrame
    daily_prices: DataFrame
    symbol_map: DataFrame
    company_profiles: DataFrame


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _letter(k, div: int):
    return F.expr(f"chr(65 + ({k} div {div}) % 26)") if div > 1 else F.expr(f"chr(65 + {k} % 26)")


def listings(part: DataFrame) -> DataFrame:
    """One listing per part key: k, its four-letter stem and symbol."""
    k = F.col("k")
    s4 = F.concat(_letter("k", 17576), _letter("k", 676), _letter("k", 26), _letter("k", 1))
    sym = (F.when(k % 37 == 0, F.concat(s4, F.lit("7")))
           .when(k % 41 == 0, F.concat(s4, F.lit("XX"))).otherwise(s4))
    return (part.select(F.col("p_partkey").alias("k"), "p_name", "p_brand", "p_type",
                        "p_size", "p_retailprice")
            .withColumn("sym", sym))


def ipo_events(part: DataFrame, as_of: dt.date = FIXTURE_AS_OF) -> DataFrame:
    k = F.col("k")
    ex = F.element_at(F.array(*[F.lit(e) for e in EXCHANGES]), (k % 4 + 1).cast("int"))
    symbol = (F.when(k % 29 == 0, F.lit(None).cast("string"))
              .when(k % 31 == 0, F.lit(""))
              .when(k % 13 == 0, F.lower("sym")).otherwise(F.col("sym")))
    base = listings(part).select(
        F.lit("finnhub").alias("source"),
        F.date_sub(F.lit(as_of), ((k * 37) % 400 - 10).cast("int")).alias("ipo_date"),
        symbol.alias("symbol"),
        F.concat(F.col("p_name"), F.lit(" #"), k.cast("string")).alias("company_name"),
        ex.alias("exchange"),
        (F.col("p_retailprice") * 0.9).cast("decimal(18,6)").alias("price_range_low"),
        (F.col("p_retailprice") * 1.1).cast("decimal(18,6)").alias("price_range_high"),
        (F.col("p_size").cast("bigint") * 1000).alias("shares"),
    )
    from evwin.operators.ingest import event_id_expr  # local: avoid import cycle
    return base.select(
        event_id_expr("source", "ipo_date", "company_name", "symbol").alias("event_id"),
        "*",
        F.to_json(F.struct(
            F.col("ipo_date").cast("string").alias("date"), F.col("company_name").alias("name"),
            "symbol", "exchange", F.col("price_range_low").alias("priceRangeLow"),
            F.col("price_range_high").alias("priceRangeHigh"),
            F.col("shares").alias("numberOfShares"))).alias("raw_json"),
        ts_lit(INGESTED_AT).alias("ingested_at"),
    )


def _vendor_symbol(k, r: int, n_suppliers):
    return (F.when(k % 17 == 0, F.concat(F.lit("X"), k.cast("string")))
            .when(k % 3 == r, F.concat(F.lit("N"), (k % 25).cast("string")))
            .otherwise(F.concat(F.lit("S"), (k % n_suppliers).cast("string"))))


def symbols(part: DataFrame) -> DataFrame:
    """One row per symbol, that of its lowest key: four letters give fewer
    symbols than a large ``part`` has keys.  Listings may share a symbol;
    mappings and profiles are keyed by it."""
    return top1(listings(part), ["sym"], [F.col("k")])


def symbol_map(part: DataFrame, supplier: DataFrame) -> DataFrame:
    k = F.col("k")
    n_supp = supplier.select(F.count(F.lit(1))).scalar()  # scalar subquery, one small job
    lst = symbols(part)

    def rows(vendor, keep, r, priceable):
        return lst.filter(keep).select(
            F.lit(vendor).alias("vendor"), F.col("sym").alias("ipo_symbol"),
            _vendor_symbol(k, r, n_supp).alias("vendor_symbol"),
            priceable.alias("is_priceable"), F.lit(None).cast("string").alias("notes"),
            ts_lit(MAP_LAST_CHECKED[vendor]).alias("last_checked_at"))

    return rows("alphavantage", k % 2 == 0, 0, k % 5 != 0).unionByName(
        rows("yahoo", k % 11 != 0, 1, k % 7 != 0))


def company_profiles(part: DataFrame, as_of: dt.date = FIXTURE_AS_OF) -> DataFrame:
    k = F.col("k")
    lst = symbols(part)

    def rows(source, keep, industry, sector):
        return lst.filter(keep).select(
            F.lit(source).alias("source"), F.col("sym").alias("symbol"),
            F.col("p_name").alias("name"), F.lit("US").alias("exchange"),
            F.lit("US").alias("country"), F.lit(None).cast("string").alias("ipo"),
            F.lit("USD").alias("currency"), (k * 1000).cast("double").alias("market_cap"),
            industry.alias("industry"), sector.alias("sector"),
            F.concat(F.lit("web/"), F.lower("sym")).alias("weburl"),
            F.lit(None).cast("string").alias("logo"), F.lit(None).cast("string").alias("raw_json"),
            ts_lit(INGESTED_AT).alias("ingested_at"))

    fh = rows("finnhub", k % 3 != 0,
              F.when(k % 8 == 0, F.lit(None).cast("string")).when(k % 10 == 0, F.lit(" "))
              .otherwise(F.col("p_type")),
              F.lit(None).cast("string"))
    yh = rows("yahoo", k % 2 == 0,
              F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")),
              F.when(k % 9 == 0, F.lit("")).otherwise(F.col("p_brand")))
    return fh.unionByName(yh)


def _ticks(lineitem: DataFrame) -> DataFrame:
    """What a line adds to the bars of a series, in few bytes."""
    px = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(18,6)")
    day = F.to_date("l_shipdate")
    return lineitem.select("l_suppkey", F.coalesce(F.col("l_linenumber") % 2 == 0, F.lit(False)).alias("even"), day.alias("price_date"),
                           F.date_format(day, "yyyy-MM").alias("price_month"), px.alias("px"), "l_orderkey", "l_linenumber", "l_quantity")


def _bars(ticks: DataFrame, *keys: str) -> DataFrame:
    order = F.struct("l_orderkey", "l_linenumber", "px")
    return ticks.groupBy(*keys, "even").agg(
        F.min_by("px", order).alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", order).alias("close_raw"),
        F.sum("l_quantity").alias("quantity"))


def _price_rows(bars: DataFrame) -> DataFrame:
    v = F.col("volume")
    close = (F.when(v % 23 == 0, F.lit(None).cast("decimal(18,6)"))
             .when(v % 101 == 0, F.lit(0).cast("decimal(18,6)"))
             .otherwise(F.col("close_raw")))
    return bars.withColumn("volume", F.col("quantity").cast("bigint")).select(
        F.when(F.col("even"), F.lit("alphavantage")).otherwise(F.lit("yahoo")).alias("source"),
        "symbol", "price_date", "open", "high", "low", close.alias("close"), "volume",
        F.lit(None).cast("string").alias("raw_row"), ts_lit(INGESTED_AT).alias("ingested_at"), "price_month")


def supplier_prices(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Bars of the suppliers' series, nearly as many as lines: their lines are shuffled
    once, into the order in which prices are stored, and need no other shuffle to be
    grouped or written.  A line counts once for each row of its supplier."""
    ticks = _ticks(lineitem.filter(F.col("l_suppkey").isNotNull()))
    ticks = ticks.withColumn("symbol", F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).drop("l_suppkey")
    bars = _bars(ticks.repartitionByRange(*PRICE_LAYOUT), *PRICE_LAYOUT)
    key = F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("_twice")
    many = supplier.groupBy("s_suppkey").count().filter("count > 1").select(key, F.col("count").alias("_times"))
    bars = bars.join(F.broadcast(many), F.col("symbol") == F.col("_twice"), "left")   # a key's rows: one
    return _price_rows(bars.withColumn("quantity", F.col("quantity") * F.coalesce("_times", F.lit(1))))


def nation_prices(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Bars of the nations' series: few, so they are grouped before the shuffle."""
    sup = supplier.filter(F.col("s_nationkey").isNotNull()).select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    bars = _bars(_ticks(lineitem).join(sup, "l_suppkey"), "s_nationkey", "price_date")
    return _price_rows(bars.select(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("symbol"), "*",
                                   F.date_format("price_date", "yyyy-MM").alias("price_month")))


def daily_prices(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Daily OHLCV bars per (source, symbol, date).  Each line feeds two series
    (supplier and supplier nation)."""
    return supplier_prices(lineitem, supplier).unionByName(nation_prices(lineitem, supplier)).drop("price_month")


def price_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``daily_prices`` in two parts with their month, the first as it is to be stored."""
    lineitem, supplier = _read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "supplier")
    return supplier_prices(lineitem, supplier), nation_prices(lineitem, supplier)


def raw_tables(spark: SparkSession, sf_dir: str, as_of: dt.date = FIXTURE_AS_OF) -> RawTables:
    part = _read(spark, sf_dir, "part")
    supplier = _read(spark, sf_dir, "supplier")
    lineitem = _read(spark, sf_dir, "lineitem")
    return RawTables(
        ipo_events=ipo_events(part, as_of),
        daily_prices=daily_prices(lineitem, supplier),
        symbol_map=symbol_map(part, supplier),
        company_profiles=company_profiles(part, as_of),
    )
