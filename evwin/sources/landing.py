"""Landed payload files: what a vendor's responses are after a download.

A feed is a folder of text files.  A file is one whole document (``per_line=False``), or
holds one envelope a line, a JSON object with the request's ``symbol``, ``date_from`` and
``date_to`` beside the response's ``payload`` or the ``error`` of a failed call.  Small
responses belong into envelopes: a file each would make as many tasks as responses.

The order of documents is that of their landing: time of change of the file, its path,
the line.  Which files have been loaded is kept in a record table (one row a file, with
a digest of its bytes).  A load takes the files that the record does not know by path
and time, and of those with equal bytes, here or in the record, the first to land.  So a
file landed twice counts once.  The record is written by ``settle``, after the load's own
writes; a load that dies before that takes the same files again.

Envelopes are read line by line, a large file by several tasks, so that no task holds a
file: the digest of such a file is made of its size and, for each line, its hashes times
its number, which blocks of any cut sum up to.  A whole document is one row, with the
SHA-256 of its bytes.  Empty files hold nothing and are passed over by Spark's readers.

Paths of new files pass through the driver, as in any file listing; contents don't.  A
listing reads no content, and a file's bytes are read twice: for the digest and the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evwin.operators.upsert import upsert_partitioned
from evwin.session import materialize
from evwin.sources import versioned
from evwin.sources.raw import _fs

ENVELOPE = "symbol string, date_from date, date_to date, payload string, error string"
RECORD_KEYS = ["feed", "path", "landed_at"]
_PRIME, _HASHES = 2**31 - 1, 4   # products of two remainders, and sums of 2**32 of them, are longs


@dataclass
class Load:
    """Files of one load (rows of the record) and what they hold: ``seq`` (a struct that
    orders documents by landing) and ``payload``, or an envelope's fields."""
    files: DataFrame
    rows: DataFrame
    record: str


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path, landed_at and bytes of a feed's files, and ``open``, the path as readers take
    it; reads no content.  No folder: no file."""
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return spark.createDataFrame([], "path string, landed_at timestamp, bytes bigint, open string")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(*_file(), F.col("path").alias("open"))


def _file() -> list[Column]:
    m = F.col("_metadata")
    return [m["file_path"].alias("path"), m["file_modification_time"].alias("landed_at"), m["file_size"].alias("bytes")]


def _text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row a file."""
    if not paths:
        return spark.createDataFrame([], "path string, landed_at timestamp, bytes bigint, value string")
    return spark.read.text(paths, wholetext=True).select(*_file(), "value")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row a line, by whichever task its block of the file falls to; ``line`` ascends
    within a block."""
    if not paths:
        return spark.createDataFrame([], "path string, landed_at timestamp, bytes bigint, block bigint, line bigint, value string")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))   # within the task
    return spark.read.text(paths, lineSep="\n").select(*_file(), F.col("_metadata.file_block_start").alias("block"), at.alias("line"), "value")


def _line_digests(lines: DataFrame) -> DataFrame:
    """path and digest: a line's number is its block's first one plus its place there, so
    hashes times numbers sum up by block before the blocks of a file are put in order."""
    hashes = [F.pmod(F.xxhash64(F.lit(k), "value"), F.lit(_PRIME)) for k in range(_HASHES)]
    blocks = lines.groupBy("path", "bytes", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("line").alias("first"), *[F.sum(h).alias(f"h{k}") for k, h in enumerate(hashes)],
        *[F.sum(F.pmod(F.pmod("line", F.lit(_PRIME)) * h, F.lit(_PRIME))).alias(f"t{k}") for k, h in enumerate(hashes)])
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("shift", F.pmod(before - F.col("first") + 1, F.lit(_PRIME)))
    sums = [F.sum(F.pmod(F.col(f"t{k}") + F.col("shift") * F.pmod(f"h{k}", F.lit(_PRIME)), F.lit(_PRIME))).alias(f"s{k}") for k in range(_HASHES)]
    files = blocks.groupBy("path", "bytes").agg(F.sum("n").alias("n"), *sums)
    return files.select("path", F.sha2(F.concat_ws(" ", "bytes", "n", *[F.pmod(f"s{k}", F.lit(_PRIME)) for k in range(_HASHES)]), 256).alias("digest"))


def _known(spark: SparkSession, record: str, feed: str) -> DataFrame | None:
    at = versioned.snapshot(spark, record)
    return versioned.read(spark, record, at, [feed]).filter(F.col("feed") == feed) if at.number else None


def take(spark: SparkSession, folder: str, feed: str, record: str, *, per_line: bool, run_id: str) -> Load:
    """What has landed in ``folder/feed`` and has not been loaded."""
    files, known = listing(spark, f"{folder}/{feed}"), _known(spark, record, feed)
    if known is not None:
        files = files.join(known.select("path", "landed_at"), ["path", "landed_at"], "left_anti")
    files = materialize(files, "listed-files")
    paths = [r.open for r in files.select("open").collect()]
    digests = _line_digests(_lines(spark, paths)) if per_line else _text(spark, paths).select("path", F.sha2("value", 256).alias("digest"))
    new = files.join(digests, "path").select(F.lit(feed).alias("feed"), "path", "landed_at", "bytes", "digest", F.lit(run_id).alias("run_id"), "open")
    new = materialize(new, "landed-files")
    first = new.withColumn("_rn", F.row_number().over(Window.partitionBy("digest").orderBy("landed_at", "path"))).filter("_rn = 1")
    if known is not None:
        first = first.join(known.select("digest").distinct(), "digest", "left_anti")
    taken = [r.open for r in first.select("open").collect()]
    return Load(new.drop("open"), documents(spark, taken, per_line=per_line), record)


def documents(spark: SparkSession, paths: list[str], *, per_line: bool) -> DataFrame:
    """The rows of the named files."""
    if not per_line:
        return _text(spark, paths).select(_seq(F.lit(0).alias("line")).alias("seq"), F.col("value").alias("payload"))
    ended = F.when(F.col("value").contains("\r"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))   # few lines need the expression
    lines = _lines(spark, paths).withColumn("text", ended).filter("trim(text) <> ''")
    # a line that is no envelope is handed on whole, for the parsers to set aside
    # read by a generator: filters on fields stay above it, so that a line is parsed once
    read = lines.select(_seq("block", "line").alias("seq"), "text", F.explode_outer(F.array(F.from_json("text", ENVELOPE))).alias("e"))
    return read.select("seq", "e.symbol", "e.date_from", "e.date_to",
                       F.when(F.coalesce("e.symbol", "e.payload", "e.error").isNull(), F.col("text")).otherwise(F.col("e.payload")).alias("payload"), "e.error")


def _seq(*place: Column | str) -> Column:
    return F.struct("landed_at", "path", *place)


def settle(load: Load) -> None:
    """Record a load's files, once what they hold is written."""
    spark = load.files.sparkSession
    upsert_partitioned(spark, load.record, load.files, RECORD_KEYS, "feed", ("feed", "path"))


def land_documents(docs: DataFrame, folder: str, *, name: str = "batch_seq") -> None:
    """Land each row's ``payload`` as a file of its own, in a folder named by ``name``."""
    docs.select(name, "payload").repartition(name).write.mode("append").partitionBy(name).text(folder)


def land_envelopes(rows: DataFrame, folder: str) -> None:
    """Land rows as envelopes, one a line; columns they lack stay out."""
    fields = [c.split()[0] for c in ENVELOPE.split(", ") if c.split()[0] in rows.columns]
    rows.select(F.to_json(F.struct(*fields)).alias("value")).write.mode("append").text(folder)
