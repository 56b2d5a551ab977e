"""Keyed upserts (I04, I10-I12) without a table format.

Parquet has no MERGE, so an upsert is ``target LEFT ANTI batch ∪ batch`` on
the key, with the batch first reduced to one row per key (last wins).
``upsert_within`` leaves out of the join what lies outside the batch's
dates; ``upsert_partitioned`` commits to a versioned table, of which it reads
and rewrites only the partitions the batch touches.  Upserting twice equals
upserting once."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evwin.functions.exprs import lit_date, price_date_range
from evwin.sources import versioned
from evwin.sources.raw import remove
from evwin.sources.versioned import Snapshot


def last_wins(batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last by ``order`` (e.g. batch sequence, position)."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return batch.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column] | None = None
           ) -> DataFrame:
    """Replace target rows whose key is in the batch, insert the others.
    Batch columns absent from the target are dropped (projection to the
    target schema); target columns absent from the batch become NULL.  The
    batch is reduced to one row per key first: the last by ``order`` when
    given, else a deterministic pick on the row values [design]."""
    cols = target.columns
    if order is not None:
        batch = last_wins(batch, keys, order)
    else:
        rest = [c for c, t in batch.dtypes if c not in keys and not t.startswith(("map", "variant"))]
        batch = last_wins(batch, keys, [F.col(c) for c in rest] or [F.lit(0)])
    b = batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(t).alias(c)
                       for c, t in target.dtypes])
    kept = target.join(b.select(*keys), keys, "left_anti")
    return kept.unionByName(b).select(*cols)


def upsert_within(target: DataFrame, batch: DataFrame, keys: list[str], date_col: str, lo: dt.date, hi: dt.date,
                  order: list[Column] | None = None) -> DataFrame:
    """``upsert`` for a batch whose ``date_col``, a key column, lies in [lo, hi]
    (a load's request window): target rows outside it cannot be replaced, so
    they are passed on without a shuffle.  Batch rows outside it, or without a
    date, are a caller's error and raise."""
    inside = price_date_range(target, lo, hi)
    outside = target.filter((F.col(date_col) < lit_date(lo)) | (F.col(date_col) > lit_date(hi))
                            | F.col(date_col).isNull())
    ok = F.coalesce(F.col(date_col).between(lit_date(lo), lit_date(hi)), F.lit(False))
    checked = batch.withColumn(date_col, F.when(ok, F.col(date_col)).otherwise(
        F.raise_error(F.lit(f"{date_col} outside the batch's window")).cast("date")))
    return outside.unionByName(upsert(inside, checked, keys, order))


def key_bucket(keys: list[str], buckets: int = 16) -> Column:
    """A partition for tables without a date: the same for all rows of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def upsert_partitioned(spark: SparkSession, table: str, batch: DataFrame, keys: list[str], partition_col: str,
                       layout: tuple[str, ...] | None = None, keep: int = 2,
                       then: Callable[[DataFrame], object] | None = None) -> Snapshot:
    """Merge ``batch`` into the versioned table at ``table`` (see
    ``sources.versioned``) and return the table's new state.  Only the
    partitions the batch touches are read and rewritten, range-partitioned and
    sorted by ``layout`` (default: partition, keys); the partition has to follow
    from the key.  The batch is written first, so it is computed once and its
    partitions can be named; the merge is visible when its pointer is, and a run
    that dies before that changes nothing.  ``then`` gets the written batch after
    the commit, before it is removed: for tables that follow this one."""
    layout = layout or (partition_col, *keys)
    before = versioned.snapshot(spark, table)
    staged = f"{table}/_batches/{uuid.uuid4().hex[:12]}"
    batch.write.parquet(staged)
    new = spark.read.schema(batch.schema).parquet(staged)
    # one value a partition of the table, so as many as its folders
    touched = [versioned.partition_name(r[0]) for r in new.select(partition_col).distinct().collect()]
    if before.schema is None:
        target = spark.createDataFrame([], batch.schema)
    else:
        target = versioned.read(spark, table, before, touched)
    merged = upsert(target, new.select(*[c for c in target.columns if c in new.columns]), keys)
    version, holds = versioned.write(spark, table, merged, partition_col, layout)
    after = versioned.commit(spark, table, before, version, holds, touched, target.schema, partition_col)
    if then:
        then(new)
    remove(spark, staged)
    versioned.vacuum(spark, table, keep)
    return after
