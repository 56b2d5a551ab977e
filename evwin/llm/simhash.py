"""SimHash near-duplicates, linked by covering locality-sensitive hashing.

A fingerprint has a bit for each of the 64 bits of a shingle's XXH64: 1 if more than
half of the document's shingles (repeats included) have it.  Fingerprints at most
``radius`` bits apart are linked.  Bit i gets a non-zero vector of radius + 1 binary
digits; each non-zero vector v keeps the bits whose product with v is odd.  Any
``radius`` bits span less than the whole space, so some v is orthogonal to all of them:
the pair is alike under that mask, and no link is lost.  A bucket with many fingerprints
is dealt again by the same construction over the bits that its mask leaves out, which
bounds it by the number of values the last bits can take.

Null text: like an empty one.  No word: fingerprint zero, linked like any other.  Rows
that share a doc_id count as documents of their own; null ids never win as the smallest
while there is another.  Repeated rows: each has its own result; ``keep_one`` keeps one of
them.  Ties: a shingle bit set in just half of the hashes is 0; a group keeps its smallest
id, of rows that share it the smaller fingerprint, then the smaller hash of the text.  Very
long texts: read whole, shingles counted a step at a time.  Empty table: empty result.
Extra columns, of any name, are kept by ``keep_one`` and not read by ``near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.llm.common import packed, unpacked
from evwin.session import materialize

#: Fixed by the contract.
SHINGLE_WORDS, RADIUS, SEED = 3, 2, 42
#: A bucket with more fingerprints than this is dealt again by the second masks.
HOT_BUCKET = 256


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only: bytes
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest, n = xxhash.xxh64_intdigest, len(words) - size + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 15):
        ones += np.unpackbits(hashes[lo : lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """The other columns of ``df`` and ``fp``, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column(text)), np.uint64, batch.num_rows)
            cols = [batch.column(c) for c in kept] + [pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, "fp"])

    kept = [c for c in df.columns if c != text]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("fp", T.LongType())])
    return df.mapInArrow(run, schema)


def masks(bits: list[int], radius: int) -> list[int]:
    """Masks over ``bits`` of which one at least leaves out any ``radius`` of them."""
    top = 1 << (radius + 1)
    return [sum(1 << b for i, b in enumerate(bits) if ((i % (top - 1) + 1) & v).bit_count() % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints at most ``radius`` bits apart.
    ``fps``: one row a fingerprint, column ``fp``."""
    first = masks(list(range(64)), radius)
    keys = fps.select("fp", F.posexplode(F.array(*[F.expr(f"fp & {_signed(m)}L") if _signed(m) != -(1 << 63) else F.expr("fp & (-9223372036854775807L - 1L)") for m in first])).alias("t", "key"))
    sizes = materialize(keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")  # written, so that the join's skewed partitions can be split
    shared = keys.join(sizes, ["t", "key"])
    light = shared.filter(F.col("n") <= hot).select("fp", "t", "key", F.lit(-1).alias("t2"), F.lit(0).cast("long").alias("key2"))
    again = [masks([b for b in range(64) if not m >> b & 1], radius) for m in first]
    second = F.array(*[F.array(*[F.lit(_signed(m)) for m in ms]) for ms in again])
    heavy = shared.filter(F.col("n") > hot).select("fp", "t", "key", F.posexplode(F.element_at(second, F.col("t") + 1)).alias("t2", "m2"))
    heavy = heavy.select("fp", "t", "key", "t2", F.col("fp").bitwiseAND(F.col("m2")).alias("key2"))
    both = light.unionByName(heavy)
    on = ["t", "key", "t2", "key2"]
    a, b = both.select(*on, F.col("fp").alias("a")), both.select(*on, F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    joined = a.join(b, [a[c] == b[c] for c in on] + [F.col("a") < F.col("b"), near])
    return joined.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large and small stars; the
    root is the smallest node.  Only minima and edges travel, never a node's whole
    neighbourhood; each round is written out, so a lost executor costs one round."""
    now, state = materialize(edges.select("a", "b"), "edges"), None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        now = materialize(_star(_star(now, large=True), large=False), "edges")
    members = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return members.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a < b).  Large: each node's larger neighbours are tied to the smallest of
    its neighbourhood; small: the same for itself and its smaller neighbours."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        tied = around.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        around = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        tied = around.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return tied.filter("a < b").distinct()


def groups(ids: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, component_id (smallest id that can be reached), keeper (struct of the id and
    fingerprint that stay), for rows of (doc_id, fp)."""
    nodes = materialize(ids.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("low").isNull().alias("none"), F.col("low").alias("doc_id"), F.col("fp").alias("fp"))).alias("keeper"))
    return rooted.join(best, "root").select("fp", F.col("keeper.doc_id").alias("component_id"), "keeper")


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits) and component_id of every document."""
    ids = materialize(with_fingerprints(docs.select("doc_id", "text"), size=size), "simhash")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return ids.join(groups(ids, radius), "fp").select("doc_id", "fp", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, one for each group: that with the smallest id (ties: smaller
    fingerprint, then smaller hash of the row's text).  Texts are fingerprinted once; which
    rows stay is settled by ids and hashes, and the rows shuffle once for it."""
    none, id_ = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    h = F.xxhash64("text")
    ids = materialize(with_fingerprints(docs.select("doc_id", h.alias("h"), "text"), size=size), "simhash")
    keepers = groups(ids.select("doc_id", "fp"), radius).select(F.col("keeper.doc_id").alias("k"), F.col("keeper.fp").alias("kfp")).distinct()
    mine = ids.join(keepers, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("fp") == F.col("kfp")), "left_semi")
    stay = mine.groupBy(id_.alias("id"), none.alias("none"), "fp").agg(F.min("h").alias("h")).select("id", "none", "h").distinct()
    kept = packed(docs, id=id_, none=none, h=h).join(stay, ["id", "none", "h"])
    alike = Window.partitionBy("id", "none", "h").orderBy(F.lit(0))
    return unpacked(kept.withColumn("nth", F.row_number().over(alike)).filter("nth = 1"), docs.columns)
