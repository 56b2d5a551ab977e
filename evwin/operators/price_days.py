"""Which days a series has, kept beside the prices: one row a (source, symbol, month) with
a bit a day, a thirtieth of the price table or less.

Rows of different loads merge by ``bit_or``, so the table follows each load's delta.  It
answers what would otherwise scan prices: high-water marks (W08), whether a series has
history (I15), and whether a key stands twice (Q04), exactly and to the day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evwin.sources import versioned

KEYS = ["source", "symbol", "price_month"]
SCHEMA = "source string, symbol string, n_rows bigint, days int, undated bigint, price_month string"


def _bit(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)


def days_of(prices: DataFrame) -> DataFrame:
    """n_rows, days (bit d - 1: day d of the month) and undated rows of each series and
    month; ``price_month`` is that of the date, null without one."""
    return prices.groupBy("source", "symbol", "price_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_or(F.when(F.col("price_date").isNotNull(), _bit(F.col("price_date"))).otherwise(0)).alias("days"),
        F.count_if(F.col("price_date").isNull()).alias("undated")).select("source", "symbol", "n_rows", "days", "undated", "price_month")


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Days of two sets of rows of which an upsert has made one: a key stands once."""
    both = a.unionByName(b).groupBy(*KEYS).agg(F.bit_or("days").alias("days"))
    return both.select("source", "symbol", F.bit_count("days").cast("bigint").alias("n_rows"), "days", F.lit(0).cast("bigint").alias("undated"), "price_month")


def follow(spark: SparkSession, table: str, batch: DataFrame) -> versioned.Snapshot:
    """Merge the days of an upserted batch into the days table: reads and writes only the
    months of the batch.  To be called after the prices are committed: a run that dies in
    between leaves days out, so the next load asks for them again."""
    before = versioned.snapshot(spark, table)
    delta = days_of(batch)
    touched = [versioned.partition_name(r[0]) for r in batch.select("price_month").distinct().collect()]
    old = versioned.read(spark, table, before, touched) if before.schema is not None else spark.createDataFrame([], SCHEMA)
    version, holds = versioned.write(spark, table, merge(old, delta), "price_month", ("price_month", "symbol", "source"))
    after = versioned.commit(spark, table, before, version, holds, touched, delta.schema, "price_month")
    versioned.vacuum(spark, table)
    return after


def between(days: DataFrame, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """The same rows with only the days in [lo, hi]; months outside it are not read."""
    out, mask = days, F.col("days")
    if lo is not None:
        out = out.filter(F.col("price_month") >= f"{lo:%Y-%m}")
        mask = F.when(F.col("price_month") == f"{lo:%Y-%m}", mask.bitwiseAND(F.lit(-(1 << (lo.day - 1))))).otherwise(mask)
    if hi is not None:
        out = out.filter(F.col("price_month") <= f"{hi:%Y-%m}")
        last = F.lit((1 << hi.day) - 1 if hi.day < 31 else -1)
        mask = F.when(F.col("price_month") == f"{hi:%Y-%m}", mask.bitwiseAND(last)).otherwise(mask)
    return out.withColumn("days", mask).filter("days <> 0")


def high_water_marks(days: DataFrame, source: str | None = None, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """Newest day per (source, symbol) in [lo, hi], from the days table."""
    d = between(days, lo, hi)
    d = d if source is None else d.filter(F.col("source") == source)
    newest = F.date_add(F.to_date(F.concat("price_month", F.lit("-01"))), F.length(F.bin("days")).cast("int") - 1)
    return d.groupBy("source", "symbol").agg(F.max(newest).alias("hwm"))


def with_history(days: DataFrame, source: str, as_of: dt.date, lookback_days: int) -> DataFrame:
    """Symbols with a bar in the last ``lookback_days``."""
    return (between(days, as_of - dt.timedelta(days=lookback_days), as_of).filter(F.col("source") == source)
            .select("symbol").distinct())


def doubtful(days: DataFrame) -> DataFrame:
    """Series and months with more dated rows than days: where a key stands twice."""
    return days.filter(F.col("n_rows") - F.col("undated") > F.bit_count("days"))
