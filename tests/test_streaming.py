"""Streaming incremental price load: file stream -> windowed, idempotent upsert."""

import datetime as dt
import os
import tempfile
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from evwin.sources import versioned
from evwin.sources.raw import PRICE_LAYOUT, with_month
from evwin.sources.schemas import DAILY_PRICES
from evwin.streaming import price_stream as PS


def _bars(spark, rows):
    return spark.createDataFrame([(s, sym, d, Decimal(c), Decimal(c), Decimal(c), Decimal(c), 1)
                                  for s, sym, d, c in rows], PS.BAR_SCHEMA)


def test_stream_upserts_incrementally(spark):
    base = tempfile.mkdtemp(prefix="evwin-stream-")
    land, store, ckpt = (os.path.join(base, x) for x in ("landing", "store", "ckpt"))
    seed = spark.createDataFrame([("yahoo", "S1", dt.date(2001, 1, 2), Decimal(1), Decimal(1), Decimal(1),
                                   Decimal(1), 1, None, dt.datetime(2001, 1, 1))], DAILY_PRICES)
    versioned.create(spark, store, with_month(seed), "price_month", PRICE_LAYOUT)
    _bars(spark, [("yahoo", "S1", dt.date(2001, 1, 2), 5), ("yahoo", "S1", dt.date(2001, 2, 3), 6)]) \
        .write.parquet(os.path.join(land, f"b-{uuid.uuid4().hex[:6]}"))
    q = PS.start(spark, land + "/*", store, checkpoint=ckpt)
    q.awaitTermination(120)
    got = sorted((r.price_date, float(r.close)) for r in versioned.read(spark, store).collect())
    assert got == [(dt.date(2001, 1, 2), 5.0), (dt.date(2001, 2, 3), 6.0)]
    # a second file: only it is processed; replaying the same content changes nothing
    _bars(spark, [("yahoo", "S1", dt.date(2001, 2, 3), 7), ("alphavantage", "S1", dt.date(2001, 3, 1), 8)]) \
        .write.parquet(os.path.join(land, f"b-{uuid.uuid4().hex[:6]}"))
    q = PS.start(spark, land + "/*", store, checkpoint=ckpt)
    q.awaitTermination(120)
    got = sorted((r.source, r.price_date, float(r.close)) for r in versioned.read(spark, store).collect())
    assert got == [("alphavantage", dt.date(2001, 3, 1), 8.0), ("yahoo", dt.date(2001, 1, 2), 5.0),
                   ("yahoo", dt.date(2001, 2, 3), 7.0)]


def test_load_batch_respects_windows(spark):
    base = tempfile.mkdtemp(prefix="evwin-stream-")
    store = os.path.join(base, "store")
    seed = spark.createDataFrame([], DAILY_PRICES)
    versioned.create(spark, store, with_month(seed), "price_month", PRICE_LAYOUT)
    windows = spark.createDataFrame([("yahoo", "S1", dt.date(2001, 1, 1), dt.date(2001, 1, 31), "load")],
                                    "source string, vendor_symbol string, load_from date, load_to date, load_status string")
    bars = _bars(spark, [("yahoo", "S1", dt.date(2001, 1, 5), 1), ("yahoo", "S1", dt.date(2001, 2, 5), 2),
                         ("yahoo", "S2", dt.date(2001, 1, 5), 3)])
    PS.load_batch(spark, bars, store, windows=windows, batch_ts=dt.datetime(2001, 2, 6))
    got = [(r.symbol, r.price_date) for r in versioned.read(spark, store).collect()]
    assert got == [("S1", dt.date(2001, 1, 5))]


def test_last_landed_file_wins_with_file_backed_windows(spark):
    """Landing order decides, also behind a join with windows read from files; a replay changes nothing."""
    base = tempfile.mkdtemp(prefix="evwin-stream-")
    land, store, win = (os.path.join(base, x) for x in ("landing", "store", "windows"))
    spark.createDataFrame([("yahoo", "S1", dt.date(2001, 1, 1), dt.date(2001, 1, 31), "load")],
                          "source string, vendor_symbol string, load_from date, load_to date, load_status string") \
        .write.parquet(win)
    day = dt.date(2001, 1, 5)
    for i, (name, close) in enumerate((("z", 1), ("a", 2), ("m", 3))):    # by time of landing, not by name
        out = os.path.join(land, name)
        _bars(spark, [("yahoo", "S1", day, close), ("yahoo", "S1", day, close + 10)]).coalesce(1).write.parquet(out)
        for f in os.listdir(out):
            os.utime(os.path.join(out, f), (1_000_000_000 + i, 1_000_000_000 + i))
    bars = PS.with_landing(spark.read.schema(PS.BAR_SCHEMA).parquet(*[os.path.join(land, n) for n in "zam"]))
    seen = []
    for _ in range(2):
        PS.load_batch(spark, bars, store, windows=spark.read.parquet(win))
        (r,) = versioned.read(spark, store).collect()
        seen.append((float(r.close), r.ingested_at))
    assert seen[0] == seen[1] and seen[0][0] == 13.0
