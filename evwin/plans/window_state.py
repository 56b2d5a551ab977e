"""Marts that follow loads: per listing and month, what its window holds there.

A state row is the aggregate of a listing's window rows in one month.  Months are
disjoint, so the figures of a listing merge from its months by sums, minima, maxima and the
earliest and latest of dated values.  Within a month nothing is merged: a load may correct
a price or bring the preferred vendor's, so the months it touches are computed anew from
the price table, and replaced together.  A load of one day reads one month of prices
instead of every window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evwin.operators.window_join import touched_months
from evwin.plans.models import window_prices
from evwin.sources import versioned


def state_of(window_rows: DataFrame) -> DataFrame:
    """One row a (event_id, price_month) of window rows."""
    c, d = F.col("close"), F.col("price_date")
    dated = F.when(c.isNotNull(), d)
    return window_rows.groupBy("event_id", F.date_format(d, "yyyy-MM").alias("price_month")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(d) - 1)).alias("days"),
        F.min(d).alias("first_date"), F.max(d).alias("last_date"),
        F.min_by(c, d).alias("first_close"), F.max_by(c, d).alias("last_close"),      # of the first and last day, NULL or not
        F.min(dated).alias("first_dated"), F.max(dated).alias("last_dated"),
        F.min_by(c, dated).alias("first_known"), F.max_by(c, dated).alias("last_known"),
        F.count(c).alias("n_close"), F.sum(c).alias("sum_close"), F.min(c).alias("min_close"), F.max(c).alias("max_close"))


def long_stats(states: DataFrame) -> DataFrame:
    """The figures of the long window's marts, merged from its months."""
    return states.groupBy("event_id").agg(
        F.sum("n_rows").alias("price_rows"), F.sum(F.bit_count("days")).cast("bigint").alias("distinct_price_days"),
        F.min("first_date").alias("first_price_date"), F.max("last_date").alias("last_price_date"),
        F.sum("n_close").alias("_n_close"),
        F.min_by("first_known", "first_dated").alias("first_close"), F.max_by("last_known", "last_dated").alias("last_close"),
        F.min("min_close").alias("min_close"), F.max("max_close").alias("max_close"))


def short_stats(states: DataFrame) -> DataFrame:
    """The figures of the short window's mart, merged from its months."""
    return states.groupBy("event_id").agg(
        F.sum(F.bit_count("days")).cast("bigint").alias("price_days"),
        F.min("first_date").alias("first_price_date"), F.max("last_date").alias("last_price_date"),
        F.min_by("first_close", "first_date").alias("first_close_30d"), F.max_by("last_close", "last_date").alias("last_close_30d"),
        F.sum("sum_close").alias("_sum_close"), F.sum("n_close").alias("_n_close"),
        F.min("min_close").alias("min_close_30d"), F.max("max_close").alias("max_close_30d"))


_IDENTITY = ("event_id", "ipo_date", "price_symbol", "is_priceable")


def months_of_change(before: DataFrame, after: DataFrame, days: int) -> DataFrame:
    """(price_month): the months in the windows of listings that are new, gone, or have
    another symbol or date than before."""
    old, new = before.select(*_IDENTITY), after.select(*_IDENTITY)
    changed = new.exceptAll(old).unionByName(old.exceptAll(new))
    return changed.select(F.explode(touched_months(F.col("ipo_date"), F.date_add("ipo_date", days))).alias("price_month")).distinct()


def refresh(spark: SparkSession, table: str, listings: DataFrame, prices: DataFrame, months: DataFrame, *, as_of: dt.date,
            recent_days: int, days: int, bucket_days: int = 32) -> versioned.Snapshot:
    """Compute the states of ``months`` (price_month: those of a load's batch, and
    ``months_of_change``) anew and put them in force together.  Months pass
    through the driver, by name."""
    before = versioned.snapshot(spark, table)
    touched = sorted(r[0] for r in months.select("price_month").distinct().collect() if r[0] is not None)
    rows = window_prices(listings, prices.filter(F.col("price_month").isin(touched)), as_of=as_of, recent_days=recent_days,
                         days=days, bucket_days=bucket_days)
    states = state_of(rows).select(*[c for c in state_of(rows).columns if c != "price_month"], "price_month")
    version, holds = versioned.write(spark, table, states, "price_month", ("price_month", "event_id"))
    after = versioned.commit(spark, table, before, version, holds, touched, states.schema, "price_month")
    versioned.vacuum(spark, table)
    return after
