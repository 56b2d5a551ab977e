"""The raw store: the derived raw tables, each written once per input folder to the
shared checkpoint folder (``spark.checkpoint.dir``) and read back by every
query, as the reference's models read stored raw tables.

Layout: ``daily_prices`` is partitioned by ``price_month`` ('yyyy-MM') and
range-partitioned/sorted by (month, symbol, date) so a date bound prunes
whole partitions and parquet min/max statistics skip row groups; the other
three tables are plain parquet.  Each table is written when a query first asks for
it, to a folder of its own, and an empty marker file, created last, makes it visible; nothing is renamed,
so the same holds on object stores, and concurrent or failed writers never
expose a partial store."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import inspect
import re
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.config import FIXTURE_AS_OF
from evwin.session import ensure_checkpoint_dir
from evwin.sources import schemas
from evwin.sources.testdata import price_parts, raw_tables

STORE_VERSION = "raw-v4"   # bump when the derivation changes
_MARK = "_COMPLETE-"
_TABLES = {"ipo_events": schemas.IPO_EVENTS,
           "daily_prices": T.StructType([*schemas.DAILY_PRICES, T.StructField("price_month", T.StringType())]),
           "symbol_map": schemas.SYMBOL_MAP, "company_profiles": schemas.COMPANY_PROFILES}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def with_month(prices: DataFrame) -> DataFrame:
    return prices.withColumn("price_month", F.date_format("price_date", "yyyy-MM"))


PRICE_LAYOUT = schemas.PRICE_LAYOUT


def write_prices(prices: DataFrame, path: str, mode: str = "errorifexists", dealt: bool = False) -> None:
    """``dealt``: the rows have their month and come range-partitioned by the layout."""
    # range keys end in the date, so even one symbol holding a large share of
    # the rows is split over several writers; without a stated number of
    # partitions AQE may join small ones
    rows = prices if dealt else with_month(prices).repartitionByRange(*PRICE_LAYOUT)
    rows.sortWithinPartitions(*PRICE_LAYOUT).write.mode(mode).partitionBy("price_month").parquet(path)


@functools.cache
def code_version(*modules) -> str:
    """Hash of the source of the modules that produce a stored table, so a
    code change never reuses data written by older code."""
    h = hashlib.sha1()
    for m in modules:
        h.update(inspect.getsource(m).encode())
    return h.hexdigest()[:12]


def published(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete folders under ``root`` (those with a marker file)."""
    fs, rp, _ = _fs(spark, root)
    names = [f.getPath().getName() for f in fs.listStatus(rp)] if fs.exists(rp) else []
    return sorted(n[len(_MARK):] for n in names if n.startswith(_MARK))


def mark(spark: SparkSession, root: str, name: str) -> None:
    fs, p, _ = _fs(spark, f"{root}/{_MARK}{name}")
    fs.create(p).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, root: str, write) -> str:
    """Write a folder once and return it: ``write(folder)`` fills a new folder
    under ``root``, whose marker follows.  A complete one is reused; of two
    written at the same time (they hold the same) all readers take one."""
    if not published(spark, root):
        name = f"v-{uuid.uuid4().hex[:8]}"
        write(f"{root}/{name}")
        mark(spark, root, name)
    return f"{root}/{published(spark, root)[0]}"


_STATUS = re.compile(r"path=([^;]*); isDirectory=(?:false; length=(\d+)|true).*?modification_time=(\d+)")


def _files(fs, src, jvm) -> str:
    """Path, length and time of change of every input file; one call to the JVM a level
    of folders, whatever the number of files."""
    found, level = [], f"{src}/*"
    while True:
        here = fs.globStatus(jvm.org.apache.hadoop.fs.Path(level))
        entries = _STATUS.findall(jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(here).toString())
        if not entries:
            return "\n".join(sorted(found))
        found += [" ".join(e) for e in entries if e[1]]
        level += "/*"


def store_root(spark: SparkSession, sf_dir: str, as_of: dt.date = FIXTURE_AS_OF) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    fs, src, jvm = _fs(spark, sf_dir)
    real = fs.resolvePath(src)   # behind a mount table; its own file system tells lengths and times
    size = _files(real.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), real, jvm)
    tz = spark.conf.get("spark.sql.session.timeZone")
    from evwin.functions import exprs
    from evwin.operators import ingest
    from evwin.sources import testdata
    code = code_version(testdata, sys.modules[__name__], exprs, ingest)
    key = hashlib.sha1(f"{STORE_VERSION}|{code}|{src.toString()}|{size}|{as_of}|{tz}".encode()).hexdigest()[:16]
    return f"{base}/evwin/store-{key}"


class StoredTables:
    """The raw tables of a folder as stored; each is derived and written when it is first
    asked for, so that a query builds what it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date, root: str):
        self.spark, self.sf_dir, self.as_of, self.root = spark, sf_dir, as_of, root

    def _write(self, name: str, path: str) -> None:
        if name == "daily_prices":
            series, nations = price_parts(self.spark, self.sf_dir)
            write_prices(series, path, dealt=True)
            write_prices(nations, path, "append")
        else:
            getattr(raw_tables(self.spark, self.sf_dir, self.as_of), name).write.parquet(path)

    def folder(self, name: str) -> str:
        """Where a table's files are; no one writes to them again."""
        return publish(self.spark, f"{self.root}/{name}", lambda tmp: self._write(name, f"{tmp}/data")) + "/data"

    def _table(self, name: str) -> DataFrame:
        # schemas are given, so that opening a table reads no file
        return self.spark.read.schema(_TABLES[name]).parquet(self.folder(name))

    @functools.cached_property
    def ipo_events(self) -> DataFrame:
        return self._table("ipo_events")

    @functools.cached_property
    def daily_prices(self) -> DataFrame:
        return self._table("daily_prices")

    @functools.cached_property
    def symbol_map(self) -> DataFrame:
        return self._table("symbol_map")

    @functools.cached_property
    def company_profiles(self) -> DataFrame:
        return self._table("company_profiles")


def stored_raw_tables(spark: SparkSession, sf_dir: str, as_of: dt.date = FIXTURE_AS_OF, root: str | None = None) -> StoredTables:
    """The store of a folder; ``root``: its known ``store_root``."""
    return StoredTables(spark, sf_dir, as_of, root or store_root(spark, sf_dir, as_of))
