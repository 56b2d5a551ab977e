"""Interval joins: rows of ``series`` (key, date) that fall inside each
anchor's ``[start, end]`` date interval, on matching keys.

Spark has no native range join, and an equi-join on the series key alone
evaluates every (anchor, bar) pair of a key: a symbol shared by many anchors
(a third of them, say) times its whole history.  We cut the date axis into
``bucket_days``-wide buckets, replicate each anchor to the few buckets its
interval touches, and equi-join on (key, bucket); the range test then only
sees pairs from overlapping buckets, so the work stays proportional to the
output.  Where the series is stored by month its ``price_month`` is the bucket:
then the months that anchors touch prune the scan's partitions while the query
runs.  Whether the anchor side is broadcast is decided by AQE from runtime
sizes (autoBroadcastJoinThreshold); beyond it the join stays a shuffle join
with skew splitting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = dt.date(1970, 1, 1)


def date_bucket(d: Column, bucket_days: int) -> Column:
    return F.floor(F.datediff(d, F.lit(_EPOCH)) / F.lit(bucket_days)).cast("int")


def touched_months(start: Column, end: Column) -> Column:
    """The months ('yyyy-MM') of the days from ``start`` to ``end``; none if ``end`` is earlier."""
    first = F.trunc(start, "month").cast("date")
    months = F.when(start <= end, F.sequence(first, end, F.expr("interval 1 month")))
    return F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))


def interval_join(anchors: DataFrame, series: DataFrame, *, keys: list[tuple[str, str]],
                  start: str, end: str, series_date: str, bucket_days: int = 32,
                  how: str = "inner") -> DataFrame:
    """``keys`` pairs (anchor column, series column).  ``how`` is ``inner`` or
    ``left_semi`` (series rows inside any interval)."""
    if series_date == "price_date" and "price_month" in series.columns:
        a = anchors.withColumn("_wb", F.explode(touched_months(F.col(start), F.col(end))))
        s = series.withColumnRenamed("price_month", "_sb")   # the plain partition column: prunes
    else:
        a = anchors.withColumn("_wb", F.explode(F.sequence(date_bucket(F.col(start), bucket_days),
                                                           date_bucket(F.col(end), bucket_days))))
        s = series.withColumn("_sb", date_bucket(F.col(series_date), bucket_days))
    cond = a["_wb"] == s["_sb"]
    for ak, sk in keys:
        cond = cond & (a[ak] == s[sk])
    cond = cond & (s[series_date] >= a[start]) & (s[series_date] <= a[end])
    if how == "left_semi":
        return s.join(a, cond, "left_semi").drop("_sb")
    return a.join(s, cond, how).drop("_wb", "_sb")


def window_join(anchors: DataFrame, series: DataFrame, *, anchor_key: str, series_key: str,
                anchor_date: str, series_date: str, days: int,
                bucket_days: int = 32) -> DataFrame:
    """``anchor_date <= date <= anchor_date + days`` on ``anchor_key = series_key``."""
    a = anchors.withColumn("_wend", F.date_add(F.col(anchor_date), days))
    return interval_join(a, series, keys=[(anchor_key, series_key)], start=anchor_date, end="_wend",
                         series_date=series_date, bucket_days=bucket_days).drop("_wend")
