"""Windows of tokens that stand more than once in a corpus: what both repeat operators share.

A window of ``window`` tokens is assigned to its anchor, the place in it whose
``gram``-token hash is smallest (ties: the first).  Equal windows have equal anchors at
equal offsets, whatever surrounds them, so

1. only anchors whose gram stands elsewhere too can have repeated windows (a count);
2. the tokens that an anchor's windows cover form its context; contexts are counted, so
   copies travel once however many there are;
3. a gram with one context (twice or more) has all windows repeated; the different
   contexts of any other gram are compared by the operator's own method, in shards of a
   bounded number of contexts;
4. a gram with more than ``HOT`` different contexts is not gathered at all: its windows
   are counted one by one by 128-bit hashes, which aggregates before it shuffles.

The covered tokens go back to the documents as ranges.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evwin.llm.common import NOT_SPACE, RangeHash, chunks, spans, word_hashes
from evwin.session import materialize

#: Contexts that a shard has about; and different contexts of one gram that are gathered
#: at most (some 5 MB of text).
SHARD_CONTEXTS, HOT = 2000, 16384
_LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Tokens:
    """Bytes, or words between white space; windows and grams in tokens."""

    words: bool
    window: int
    gram: int

    def read(self, data: np.ndarray, off: np.ndarray):
        """Tokens, n + 1 offsets of the texts' tokens, and words' first and last bytes."""
        if not self.words:
            return data, off, None, None
        start, end, of = spans(data, off, NOT_SPACE)
        return word_hashes(data, start, end), of, start, end

    def payload(self, data: np.ndarray, start, end, a: int, b: int) -> bytes:
        """Tokens a to b, words joined by a space."""
        if not self.words:
            return data[a:b].tobytes()
        raw = data[start[a] : end[b - 1]].tobytes()
        return b" ".join(raw.split())


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every w neighbouring values."""
    n = len(x) - w + 1
    rows = np.concatenate([x, np.full(-len(x) % w, np.uint64(2**64 - 1))]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def anchors(kind: Tokens, tokens: np.ndarray, of: np.ndarray):
    """key (hash of the gram), first window, windows, text and context hash of every anchor."""
    n, none = len(tokens), np.zeros(0, np.int64)
    if n < kind.window:
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    ranges = RangeHash(tokens, 0)
    key = ranges.every(kind.gram)
    least = _least(key & ~_LOW | np.arange(len(key), dtype=np.uint64), kind.window - kind.gram + 1)
    inside = np.ones(len(least), bool)
    for end in of[1:-1].tolist():  # windows that reach into the next text
        inside[max(end - kind.window + 1, 0) : end] = False
    window = np.flatnonzero(inside)
    anchor = (least[window] & _LOW).astype(np.int64)
    if not len(window):
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
    first, count = window[new], np.diff(np.r_[new, len(window)])
    text = np.searchsorted(of, first, "right") - 1
    return key[anchor[new]], first, count, text, ranges(first, first + count - 1 + kind.window)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, rk (tells rows that share an id apart) and text."""
    return docs.select("doc_id", F.hash("text").alias("rk"), "text")


def _anchor_keys(rows: DataFrame, kind: Tokens) -> DataFrame:
    """Keys that two anchors have at least."""

    def run(batches):
        for batch in batches:
            for _, data, off in chunks(batch):
                tokens, of, _, _ = kind.read(data, off)
                keys, n = np.unique(anchors(kind, tokens, of)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    counted = rows.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return counted.filter("n > 1").select("key")


def _anchor_rows(rows: DataFrame, kind: Tokens) -> DataFrame:
    """key, ctx, doc_id, rk, first (window, within the text), size (tokens of the context)."""

    def run(batches):
        for batch in batches:
            for part, data, off in chunks(batch):
                tokens, of, _, _ = kind.read(data, off)
                key, first, count, text, ctx = anchors(kind, tokens, of)
                at = pa.array(text)
                cols = [pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)), part.column("doc_id").take(at), part.column("rk").take(at), pa.array((first - of[text]).astype(np.int32)), pa.array((count - 1 + kind.window).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "ctx", "doc_id", "rk", "first", "size"])

    return rows.mapInArrow(run, f"key long, ctx long, doc_id {dict(rows.dtypes)['doc_id']}, rk int, first int, size int")


def _zipped(rows: DataFrame) -> DataFrame:
    """Texts compressed before they shuffle (null: empty)."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = pa.array([press.compress((t.as_py() or "").encode()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rk"), z], names=["doc_id", "rk", "z"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, rk int, z binary")


def with_lists(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Compressed texts joined to one row of lists for each of some documents."""
    other = lists.withColumnRenamed("doc_id", "d2").withColumnRenamed("rk", "rk2")
    joined = _zipped(rows).join(other, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("rk") == F.col("rk2")), how)
    return joined.drop("d2", "rk2")


def _contexts(rows: DataFrame, wanted: DataFrame, kind: Tokens) -> DataFrame:
    """key, ctx, n, kinds and payload of the wanted contexts, read from one document each.
    Rows alike in id and text stand together after the join; a task reads the first."""
    lists = wanted.groupBy("rep.doc_id", "rep.rk").agg(F.collect_list(F.struct(F.col("rep.first").alias("first"), "size", "key", "ctx", "n", "kinds")).alias("l"))
    names = ["key", "ctx", "n", "kinds"]

    def run(batches):
        unpress, before = zstandard.ZstdDecompressor(), None
        for batch in batches:
            for doc_id, rk, z, found in zip(*(batch.column(c) for c in ("doc_id", "rk", "z", "l"))):
                row = doc_id.as_py(), rk.as_py()
                if row == before:
                    continue
                before, data = row, np.frombuffer(unpress.decompress(z.as_py()), np.uint8)
                _, _, start, end = kind.read(data, np.array([0, len(data)]))
                t = found.values
                first, size = (t.field(c).to_numpy() for c in ("first", "size"))
                payload = [kind.payload(data, start, end, a, a + s) for a, s in zip(first.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays([*[t.field(c) for c in names], pa.array(payload, pa.binary())], names=[*names, "payload"])

    return with_lists(rows, lists, "inner").mapInArrow(run, "key long, ctx long, n long, kinds long, payload binary")


Solver = Callable[[list[bytes], np.ndarray], list[np.ndarray]]


def ranges_of(windows: np.ndarray, window: int) -> np.ndarray:
    """[start, end, start, end, ..] of the tokens that windows (sorted starts) cover."""
    if not len(windows):
        return np.zeros(0, np.int32)
    new = np.flatnonzero(np.r_[True, windows[1:] > windows[:-1] + window])
    last = np.r_[new[1:], len(windows)] - 1
    return np.column_stack([windows[new], windows[last] + window]).ravel().astype(np.int32)


def _solved(contexts: DataFrame, solve: Solver, at_once: int) -> DataFrame:
    """key, ctx and cover of contexts with repeated windows, compared shard by shard, and
    in a shard some ``at_once`` contexts at a time, all of a gram together."""
    shards = max(1, -(-contexts.count() // SHARD_CONTEXTS))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("ctx", "ascending")])
        names = np.column_stack([table.column(c).to_numpy() for c in ("key", "ctx")])
        table = table.filter(pa.array(np.r_[True, (names[1:] != names[:-1]).any(axis=1)]))
        key = table.column("key").to_numpy()
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        begin = begin[np.flatnonzero(np.diff(begin // at_once, prepend=-1))]
        covers = []
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(key)]):
            part = table.slice(a, b - a)
            covers += solve(part.column("payload").to_pylist(), part.column("n").to_numpy())
        out = pa.table([table.column("key"), table.column("ctx"), pa.array([c.tolist() for c in covers], pa.list_(pa.int32()))], names=["key", "ctx", "cover"])
        return out.filter(pa.array([len(c) > 0 for c in covers], pa.bool_()))

    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, "key long, ctx long, cover array<int>")


def _counted(contexts: DataFrame, kind: Tokens) -> DataFrame:
    """The same for grams with very many contexts, window by window."""

    def run(batches):
        for batch in batches:
            for key, ctx, n, payload in zip(*(batch.column(c).to_pylist() for c in ("key", "ctx", "n", "payload"))):
                data = np.frombuffer(payload, np.uint8)
                tokens, _, _, _ = kind.read(data, np.array([0, len(data)]))
                at = np.arange(len(tokens) - kind.window + 1)
                cols = [pa.array(RangeHash(tokens, s)(at, at + kind.window).view(np.int64)) for s in (0, 1)]
                m = len(at)
                yield pa.RecordBatch.from_arrays([pa.array([key] * m), pa.array([ctx] * m), pa.array([n] * m), pa.array(at.astype(np.int32)), *cols], names=["key", "ctx", "n", "at", "h1", "h2"])

    windows = contexts.dropDuplicates(["key", "ctx"]).mapInArrow(run, "key long, ctx long, n long, at int, h1 long, h2 long")
    twice = windows.groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1").select("h1", "h2")
    hit = windows.join(twice, ["h1", "h2"], "left_semi").groupBy("key", "ctx").agg(F.sort_array(F.collect_list("at")).alias("at"))
    each = F.transform("at", lambda a: F.array(a, a + kind.window))
    return hit.select("key", "ctx", F.flatten(each).alias("cover"))


def covered(docs: DataFrame, kind: Tokens, solve: Solver, at_once: int = SHARD_CONTEXTS, compare_all: bool = False) -> DataFrame:
    """doc_id, rk and l: list of (first, cover) of every document with repeated windows.
    ``compare_all``: contexts that are the only one of their gram go to ``solve`` too."""
    rows = _rows(docs)
    keys = materialize(_anchor_keys(rows, kind), "keys")  # written, so that the join's skewed partitions can be split
    alive = materialize(_anchor_rows(rows, kind).join(keys, "key", "left_semi"), "anchors")
    place = F.struct("doc_id", "rk", "first")
    reps = alive.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.min(place).alias("rep"))
    reps = materialize(reps, "contexts")
    # counts are written, so that the join's skewed partitions can be split
    reps = reps.join(materialize(reps.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")), "kinds"), "key")
    alone = reps.filter("kinds = 1")
    contexts = materialize(_contexts(rows, reps if compare_all else reps.filter("kinds > 1"), kind), "payloads")
    covers = _solved(contexts.filter(F.col("kinds") <= HOT), solve, at_once).unionByName(_counted(contexts.filter(F.col("kinds") > HOT), kind))
    if not compare_all:
        covers = covers.unionByName(alone.select("key", "ctx", F.array(F.lit(0), "size").alias("cover")))
    hits = alive.join(covers, ["key", "ctx"]).select("doc_id", "rk", F.struct("first", "cover").alias("c"))
    return hits.groupBy("doc_id", "rk").agg(F.collect_set("c").alias("l"))  # a set: rows alike have the same


def removed(docs: DataFrame, lists: DataFrame, kind: Tokens, schema: str, finish: Callable) -> DataFrame:
    """One row a document: doc_id and what ``finish(kind, data, gone)`` returns, where gone
    marks the tokens that the covers of ``lists`` hold."""
    rows = _rows(docs)
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string()}[f.split()[1]] for f in schema.split(", ")]

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for z, found in zip(batch.column("z"), batch.column("l")):
                data = np.frombuffer(unpress.decompress(z.as_py()), np.uint8)
                edges = []
                if found.is_valid:
                    t = found.values
                    cover = t.field("cover")
                    bounds = cover.flatten().to_numpy().reshape(-1, 2).astype(np.int64)
                    edges = bounds + np.repeat(t.field("first").to_numpy(), cover.value_lengths().to_numpy() // 2)[:, None]
                out.append(finish(kind, data, edges))
            cols = zip(*out) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(list(c), k) for c, k in zip(cols, kinds)]], names=["doc_id", *names])

    return with_lists(rows, lists, "left").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {schema}")


def marks(n: int, edges) -> np.ndarray:
    """Which of n tokens lie in ranges (rows of start, end)."""
    change = np.zeros(n + 1, np.int64)
    if len(edges):
        np.add.at(change, edges[:, 0], 1)
        np.add.at(change, edges[:, 1], -1)
    return np.cumsum(change[:n]) > 0
