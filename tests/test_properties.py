"""Brute-force checks on random fixtures: the bucketed interval join against a
plain pair scan, and the exact rounding helpers against Python's decimal."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from evwin.functions.exprs import pct_return_2dp, round_avg
from evwin.operators.window_join import interval_join, window_join

BASE = dt.date(2001, 1, 1)


@pytest.mark.parametrize("bucket_days", [1, 7, 32, 101, 400])
def test_window_join_equals_brute_force(spark, bucket_days):
    rnd = random.Random(bucket_days)
    anchors = [(f"e{i}", rnd.choice("ABC"), BASE + dt.timedelta(days=rnd.randint(0, 300))) for i in range(60)]
    series = [(rnd.choice("ABCD"), BASE + dt.timedelta(days=rnd.randint(-20, 420)), i) for i in range(600)]
    a = spark.createDataFrame(anchors, "event_id string, sym string, d date")
    s = spark.createDataFrame(series, "symbol string, price_date date, v int")
    got = sorted((r.event_id, r.v) for r in window_join(
        a, s, anchor_key="sym", series_key="symbol", anchor_date="d", series_date="price_date",
        days=100, bucket_days=bucket_days).collect())
    want = sorted((e, v) for e, sym, d in anchors for s_sym, pd, v in series
                  if sym == s_sym and d <= pd <= d + dt.timedelta(days=100))
    assert got == want


def test_interval_join_semi_equals_brute_force(spark):
    rnd = random.Random(7)
    wins = []
    for i in range(40):
        lo = BASE + dt.timedelta(days=rnd.randint(0, 300))
        wins.append((rnd.choice("XY"), rnd.choice("ST"), lo, lo + dt.timedelta(days=rnd.randint(-5, 120))))
    rows = [(rnd.choice("XY"), rnd.choice("ST"), BASE + dt.timedelta(days=rnd.randint(0, 450)), i) for i in range(500)]
    w = spark.createDataFrame(wins, "src string, sym string, lo date, hi date")
    s = spark.createDataFrame(rows, "source string, symbol string, price_date date, v int")
    got = sorted(r.v for r in interval_join(w, s, keys=[("src", "source"), ("sym", "symbol")], start="lo", end="hi",
                                            series_date="price_date", bucket_days=16, how="left_semi").collect())
    want = sorted(v for src, sym, d, v in rows if any(src == a and sym == b and lo <= d <= hi for a, b, lo, hi in wins))
    assert got == want


def _half_up(x: Decimal, digits: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


def test_exact_rounding_helpers(spark):
    rnd = random.Random(3)
    pairs = [(Decimal(rnd.randint(1, 5000)), Decimal(rnd.randint(0, 5000))) for _ in range(400)]
    pairs += [(Decimal(480), Decimal(477)), (Decimal(1600), Decimal(1601)), (Decimal(8), Decimal(9))]
    df = spark.createDataFrame(pairs, "f decimal(18,6), l decimal(18,6)")
    got = [r[0] for r in df.select(pct_return_2dp(F.col("f"), F.col("l"))).collect()]
    want = [_half_up((l - f) * 100 / f, 2) for f, l in pairs]
    assert got == want
    groups = [(rnd.randint(0, 30), rnd.randint(0, 40)) for _ in range(300)]
    g = spark.createDataFrame(groups, "k int, x bigint").groupBy("k").agg(
        round_avg(F.sum("x"), F.count("x"), 2).alias("a"), F.sum("x").alias("s"), F.count("x").alias("n"))
    for r in g.collect():
        assert r.a == _half_up(Decimal(r.s) / Decimal(r.n), 2)
