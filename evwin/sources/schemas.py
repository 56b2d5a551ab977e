"""StructTypes of the five raw tables (keys noted per table)."""

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 6)

# key: event_id
IPO_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("ipo_date", T.DateType(), False),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("company_name", T.StringType(), False),
    T.StructField("exchange", T.StringType(), True),
    T.StructField("price_range_low", PRICE, True),
    T.StructField("price_range_high", PRICE, True),
    T.StructField("shares", T.LongType(), True),
    T.StructField("raw_json", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), False),
])

# key: (source, symbol, price_date)
DAILY_PRICES = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("price_date", T.DateType(), False),
    T.StructField("open", PRICE, True),
    T.StructField("high", PRICE, True),
    T.StructField("low", PRICE, True),
    T.StructField("close", PRICE, True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("raw_row", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), False),
])

# key: (vendor, ipo_symbol)
SYMBOL_MAP = T.StructType([
    T.StructField("vendor", T.StringType(), False),
    T.StructField("ipo_symbol", T.StringType(), False),
    T.StructField("vendor_symbol", T.StringType(), False),
    T.StructField("is_priceable", T.BooleanType(), True),
    T.StructField("notes", T.StringType(), True),
    T.StructField("last_checked_at", T.TimestampType(), True),
])

# key: (source, symbol)
COMPANY_PROFILES = T.StructType([
    T.StructField("source", T.StringType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("exchange", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("ipo", T.StringType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("market_cap", T.DoubleType(), True),
    T.StructField("industry", T.StringType(), True),
    T.StructField("sector", T.StringType(), True),
    T.StructField("weburl", T.StringType(), True),
    T.StructField("logo", T.StringType(), True),
    T.StructField("raw_json", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

# key: run_id
INGESTION_RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("finished_at", T.TimestampType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("notes", T.StringType(), True),
])

# order in which stored prices are range-partitioned and sorted
PRICE_LAYOUT = ("price_month", "symbol", "price_date")

KEYS = {
    "ipo_events": ("event_id",),
    "daily_prices": ("source", "symbol", "price_date"),
    "symbol_map": ("vendor", "ipo_symbol"),
    "company_profiles": ("source", "symbol"),
    "ingestion_runs": ("run_id",),
}
