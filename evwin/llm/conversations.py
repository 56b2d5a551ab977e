"""Prefix trie of conversations: union-find over the edges between sorted neighbours.

A conversation is the sequence of its turns' digests.  Sequences are range-sorted, so that
those with a common prefix stand together; neighbours are tied by an edge as deep as their
longest common prefix.  Each task takes its partition's edges in descending depth and
unites what they tie: every merge makes a branching node, or adds to the one of that depth.
What a node says about its members is a sum over a run of the order, so a node that lies
inside a partition is finished there.  The nodes on the paths of a partition's first and
last sequence may go on beyond it: the forest is contracted to their sums, keyed by a
digest of the prefix, and these are merged across the boundaries by aggregation, with the
edges between the last sequence of one partition and the first of the next.

Sums: with B(d) the bytes of the first d turns and l the depth of the edge to the sequence
before, the tokens saved in a node's subtree are the sum of B(l) over its members but the
first, less (members - 1) times B(depth - 1).  A childless node is a sequence that the next
one does not extend.

A conversation's digests (16 bytes a turn) and turn sizes make one row; its texts never do.
A member list is hashed from chunks of at most ``CHUNK_IDS`` ids in order, never gathered.

Null conv_id: such rows belong to no conversation.  Null role or text: empty.  Ties
between turns: ordered by the digest of role and text.  Repeated rows are turns of their
own.  Very long texts are read once, for their digest.  Empty table: empty result, without
a root.  Columns beside the four are not read, so no name can clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evwin.session import materialize

#: Fixed by the contract: conversations of five borrow up to eight turns of their first.
GROUP, BORROWED = 5, 9
#: Bytes of a digest in a sequence's key.
WIDTH = 16
#: Ids in one row of a list that goes on in other partitions; rows of one output batch.
CHUNK_IDS, STEP_ROWS = 4096, 1 << 15


def digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, seq: digest (hex) and bytes of the text of every turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    seq = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes")))
    return rows.groupBy("conv_id").agg(seq.alias("seq"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Each conversation with the first turns of the first of its five."""
    first = seqs.select(F.col("conv_id").alias("of"), F.slice("seq", 1, BORROWED - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).cast("int")
    own = seqs.select("conv_id", "seq", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("of"), h.alias("h")).join(first, "of", "left")
    head = F.slice(F.coalesce("head", F.array().cast(seqs.schema["seq"].dataType)), F.lit(1), F.col("h"))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1)))
    return own.select("conv_id", F.concat(head, rest).alias("seq"))


def _common(a: bytes, b: bytes) -> int:
    """Turns in which two keys agree from the start."""
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return m // WIDTH
    return int(np.argmax(np.frombuffer(a, np.uint8, m) != np.frombuffer(b, np.uint8, m))) // WIDTH


def _path(key: bytes) -> list[bytes]:
    """Digests of a key's prefixes, from the root."""
    state, out = hashlib.md5(), [hashlib.md5().digest()]
    for at in range(0, len(key), WIDTH):
        state.update(key[at : at + WIDTH])
        out.append(state.digest())
    return out


class _Forest:
    """Union-find over a partition's sorted sequences.  ``length``: turns; ``shared``:
    depth of the edge to the sequence before.  A node has depth, first and last row,
    children and the node above it; nodes of one depth that meet become one."""

    def __init__(self, length: list[int], shared: list[int]):
        n = len(length)
        self.depth, self.lo, self.hi = list(length), list(range(n)), list(range(n))
        self.kids, self.up, self.same = [0] * n, [-1] * n, list(range(n))
        tied, top = list(range(n)), list(range(n))

        def find(i):
            while tied[i] != i:
                tied[i] = tied[tied[i]]
                i = tied[i]
            return i

        for i in sorted(range(1, n), key=lambda i: -shared[i]):
            left, right = find(i - 1), find(i)
            a, b, p = top[left], top[right], shared[i]
            if self.depth[a] == p and self.depth[b] == p:
                self.same[b] = a
                self.kids[a] += self.kids[b]
            elif self.depth[a] == p:
                self.up[b] = a
                self.kids[a] += 1
            elif self.depth[b] == p:
                self.up[a] = b
                self.kids[b] += 1
                a = b
            else:
                self.up[a] = self.up[b] = k = self._node(p, 2)
                a = k
            self.lo[a], self.hi[a] = self.lo[top[left]], self.hi[top[right]]
            small, large = (left, right) if self.hi[top[left]] - self.lo[top[left]] < self.hi[top[right]] - self.lo[top[right]] else (right, left)
            tied[small] = large
            top[large] = a
        root = top[find(0)]
        if self.depth[root]:
            self.up[root] = k = self._node(0, 1)
            self.lo[k], self.hi[k] = 0, n - 1

    def _node(self, depth: int, kids: int) -> int:
        for values, v in ((self.depth, depth), (self.lo, 0), (self.hi, 0), (self.kids, kids), (self.up, -1), (self.same, len(self.same))):
            values.append(v)
        return len(self.same) - 1

    def resolve(self, k: int) -> int:
        while self.same[k] != k:
            k = self.same[k]
        return k


_ROW = {"kind": pa.string(), "part": pa.int32(), "nid": pa.binary(), "parent_nid": pa.binary(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(),
        "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved": pa.int64(), "before": pa.int64(), "ends": pa.string(), "chunk": pa.int64(),
        "key": pa.binary(), "bytes": pa.list_(pa.int64())}
_SCHEMA = ("kind string, part int, nid binary, parent_nid binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
           "saved long, before long, ends string, chunk long, key binary, bytes array<long>")


def _batches(rows):
    """Rows given as dicts, as Arrow batches; columns not named are null."""
    step = []
    for row in rows:
        step.append(row)
        if len(step) == STEP_ROWS:
            yield _batch(step)
            step = []
    if step:
        yield _batch(step)


def _batch(step: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: pa.array([r.get(c) for r in step], t) for c, t in _ROW.items()})


def _sha(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _partition_nodes(batches):
    """A sorted partition's rows: finished nodes (``node``), sums of nodes that may go on
    beyond it (``open``), member lists of those in chunks (``ends``), and its first and
    last key (``first``, ``last``)."""
    part = TaskContext.get().partitionId()
    ids, length, shared, gain, sizes = [], [], [], [], []
    key = first = None
    for batch in batches:
        for conv_id, this, turn_bytes in zip(batch.column("conv_id").to_pylist(), batch.column("key"), batch.column("bytes")):
            this = this.as_py()
            common = _common(key, this) if ids else 0
            total = np.r_[0, np.cumsum(np.array(turn_bytes.as_py(), np.int64))]
            ids.append(conv_id)
            length.append(len(this) // WIDTH)
            shared.append(common)
            gain.append(int(total[common]) if len(ids) > 1 else 0)
            sizes.append(total[common:])  # B from the depth where the sequence leaves the one before
            key = this
            first = this if first is None else first
    if not ids:
        return
    yield from _batches([{"kind": "first", "part": part, "key": first}, {"kind": "last", "part": part, "key": key, "bytes": total.tolist()}])
    yield from _batches(_node_rows(part, np.array(ids, np.int64), length, shared, gain, sizes, _path(first), _path(key)))


def _node_rows(part, ids, length, shared, gain, sizes, left, right):
    n, forest = len(ids), _Forest(length, shared)
    gains = np.cumsum(gain)
    # the last sequence's own leaf is counted with the edge to the next partition
    leaf = np.r_[0, np.cumsum([i + 1 < n and shared[i + 1] < length[i] for i in range(n)])]
    lowest = {}  # smallest id of a node
    nodes = [k for k in range(len(forest.same)) if forest.same[k] == k]
    for k in sorted(nodes, key=lambda k: -forest.depth[k]):
        lo, hi = forest.lo[k], forest.hi[k]
        if lo == hi or length[lo] == forest.depth[k]:
            stop = lo + 1
            while stop <= hi and length[stop] == forest.depth[k]:
                stop += 1
            lowest[k] = min(lowest.get(k, ids[lo]), ids[lo:stop].min())
        up = forest.up[k]
        if up >= 0:
            up = forest.resolve(up)
            lowest[up] = min(lowest.get(up, lowest[k]), lowest[k])
    for k in nodes:
        lo, hi, depth = forest.lo[k], forest.hi[k], forest.depth[k]
        up = forest.resolve(forest.up[k]) if forest.up[k] >= 0 else -1
        above = forest.depth[up] if up >= 0 else -1
        is_open, low = lo == 0 or hi == n - 1, int(lowest[k])
        path, members, won = left if lo == 0 else right, hi - lo + 1, int(gains[hi] - gains[lo])
        ends = _same_length(length, lo, hi, depth)
        for d in range(above + 1, depth + 1):
            before = int(sizes[lo][d - 1 - shared[lo]]) if d else 0
            row = {"part": part, "conv_id": low, "depth": d, "n_convs": members, "n_children": forest.kids[k] if d == depth else 1, "n_leaves": int(leaf[hi + 1] - leaf[lo])}
            if is_open:
                yield row | {"kind": "open", "nid": path[d], "parent_nid": path[d - 1] if d else None, "saved": won, "before": before}
                continue
            row |= {"kind": "node", "saved": won - (members - 1) * before, "ends": _sha(ids[lo : lo + ends] if d == depth else ids[:0])}
            if d > above + 1:
                yield row | {"parent_conv_id": low}
            elif forest.lo[up] and forest.hi[up] < n - 1:
                yield row | {"parent_conv_id": int(lowest[up])}
            else:
                yield row | {"parent_nid": (left if forest.lo[up] == 0 else right)[above]}
        if is_open:
            for at in range(0, ends, CHUNK_IDS):
                yield {"kind": "ends", "part": part, "nid": path[depth], "chunk": at, "ends": ",".join(map(str, ids[lo + at : lo + min(ends, at + CHUNK_IDS)].tolist()))}


def _same_length(length: list[int], lo: int, hi: int, depth: int) -> int:
    """How many of a node's rows end at it; a prefix sorts before what extends it."""
    at = lo
    while at <= hi and length[at] == depth:
        at += 1
    return at - lo


def _boundary_rows(batches):
    """For the last sequence of a partition and the first of the next: what their edge adds
    to the nodes on its path."""
    def rows():
        for batch in batches:
            for key, total, following in zip(batch.column("key").to_pylist(), batch.column("bytes").to_pylist(), batch.column("following").to_pylist()):
                common, path = -1 if following is None else _common(key, following), _path(key)
                is_leaf = common < len(path) - 1
                for d, nid in enumerate(path):
                    yield {"kind": "open", "nid": nid, "parent_nid": path[d - 1] if d else None, "depth": d, "n_convs": 0, "before": total[d - 1] if d else 0,
                           "n_children": -1 if d < common else 0, "n_leaves": int(is_leaf), "saved": total[common] if d <= common else 0}

    yield from _batches(rows())


def _hash_ends(batches):
    """SHA-256 of every node's member list, from its chunks in order."""
    nid, state = None, None

    def out():
        return pa.RecordBatch.from_pydict({"nid": pa.array([nid], pa.binary()), "ends_sha256": [state.hexdigest()]})

    for batch in batches:
        for now, text in zip(batch.column("nid").to_pylist(), batch.column("ends").to_pylist()):
            if now == nid:
                state.update(b",")
            else:
                if nid is not None:
                    yield out()
                nid, state = now, hashlib.sha256()
            state.update(text.encode())
    if nid is not None:
        yield out()


def trie(seqs: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  ``seqs``: conv_id and seq as from ``sequences``."""
    spark = seqs.sparkSession
    keyed = seqs.select("conv_id", F.unhex(F.array_join(F.transform("seq", lambda t: t["digest"]), "")).alias("key"), F.transform("seq", lambda t: t["bytes"]).alias("bytes"))
    spread = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = materialize(spread.mapInArrow(_partition_nodes, _SCHEMA), "trie")
    last = rows.filter("kind = 'last'").select("part", "key", "bytes")
    parts = sorted(r.part for r in last.select("part").collect())  # one number a partition
    after = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, next_part int")
    following = after.join(rows.filter("kind = 'first'").select(F.col("part").alias("next_part"), F.col("key").alias("following")), "next_part")
    edges = last.join(following, "part", "left").select("key", "bytes", "following").mapInArrow(_boundary_rows, _SCHEMA)
    merged = rows.filter("kind = 'open'").unionByName(edges).groupBy("nid", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_nid").alias("parent_nid"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max("before").alias("before"))
    opened = materialize(merged, "open-nodes")
    chunks = rows.filter("kind = 'ends'").select("nid", "part", "chunk", "ends")
    hashed = chunks.repartition("nid").sortWithinPartitions("nid", "part", "chunk").select("nid", "ends").mapInArrow(_hash_ends, "nid binary, ends_sha256 string")
    above = opened.select(F.col("nid").alias("parent_nid"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    wide = opened.join(hashed, "nid", "left").join(above, "parent_nid", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("saved") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    closed = rows.filter("kind = 'node'").withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})
    inner = closed.filter("parent_nid is null").select(*columns)
    under = closed.filter("parent_nid is not null").drop("parent_conv_id").join(above, "parent_nid").select(*columns)
    return wide.select(*columns).unionByName(inner).unionByName(under)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    return trie(rebuilt(sequences(turns)))
