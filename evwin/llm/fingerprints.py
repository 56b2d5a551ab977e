"""Document fingerprints: one-permutation MinHash, packed to its low-order bits.

A text's five-word shingles (words between white space, unchanged; fewer words: one
shingle of them all) are hashed once.  The top bits of a hash name its bin, the next 40
are its value; a bin keeps its smallest.  An empty bin takes the value of the first
filled bin on its own probe sequence, which is the same for every text (optimal
densification).  ``BITS`` low bits of each value, mixed with the number of its bin, are
packed into the fingerprint.  Unlike values agree in those bits once in ``2**BITS``
times; ``likeness`` takes that out of the share of agreeing bins.

Neighbours in the order of ids meet by one range shuffle of the texts: tasks pair the rows
of a sorted partition as they pass, and write their first and last row for the pairs
across a boundary.  No task holds more than a step of texts.

Null text: like an empty one.  No word: the empty fingerprint, like itself only.  Very
long texts are hashed in steps that overlap by four words; an unbroken run of 64 KB or
more is stood for by its digest.  Null ids come last.  Ties: rows of the same id are
ordered by a hash of their text; rows alike in both follow one another in any order, and
may be spread over partitions.  Repeated rows each get a result.  Empty table: empty
result; a single row is its own next.  Columns beside the id and the text are not read,
so no name can clash.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.llm.common import CHUNK_BYTES, NOT_SPACE, RangeHash, mix, row_key, runs, spans, word_hashes
from evwin.session import materialize

BINS, BITS, SHINGLE_WORDS = 256, 4, 5
_VALUE_BITS = 40
_EMPTY = np.uint64(2**64 - 1)
_SALT = mix(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Texts of one numpy step; their number shares a 64-bit key with bin and value.
_STEP_TEXTS = 1 << 14
_UNBROKEN = re.compile(rb"[^\x20\x09-\x0D]{65536,}")


def _pieces(text: bytes, limit: int) -> list[bytes]:
    """``text`` cut between words so that every shingle stands in one piece at least."""
    if len(text) >= 65536:
        text = _UNBROKEN.sub(lambda m: b"\0" + xxhash.xxh3_128_hexdigest(m[0]).encode(), text)
    if len(text) <= limit:
        return [text]
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = spans(data, np.array([0, len(data)]), NOT_SPACE)
    out, lo, n = [], 0, len(starts)
    while lo == 0 or lo + SHINGLE_WORDS <= n:
        hi = min(n, max(lo + 1, int(np.searchsorted(ends, starts[lo] + limit, "right")) if n else 0))
        last = min(n, hi + SHINGLE_WORDS - 1)
        out.append(text[starts[lo] : ends[last - 1]] if n else b"")
        lo = max(hi, 1)
    return out


def _step_minima(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bin, smallest value) of every filled bin of a step's texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    starts, ends, first = spans(data, off, NOT_SPACE)
    hashed = RangeHash(word_hashes(data, starts, ends), 1)
    count = np.diff(first)
    of_word = np.repeat(np.arange(len(texts)), count)
    few = np.flatnonzero((count > 0) & (count < SHINGLE_WORDS))
    h, owner = hashed(first[few], first[few + 1]), few
    if len(starts) >= SHINGLE_WORDS:
        whole = of_word[: len(starts) - SHINGLE_WORDS + 1] == of_word[SHINGLE_WORDS - 1 :]
        h = np.r_[h, hashed.every(SHINGLE_WORDS)[whole]]
        owner = np.r_[owner, of_word[: len(whole)][whole]]
    # bits of a key: number of the text, 8 of the bin, 40 of the value
    keys = np.sort(owner.astype(np.uint64) << np.uint64(48) | h >> np.uint64(16))
    keys = keys[runs(keys >> np.uint64(_VALUE_BITS))]
    value = keys & np.uint64(2**_VALUE_BITS - 1)
    return (keys >> np.uint64(48)).astype(np.int64), (keys >> np.uint64(_VALUE_BITS)).astype(np.int64) % BINS, value


def minima(texts: list[bytes], limit: int = CHUNK_BYTES) -> np.ndarray:
    """The smallest value of every text's bins, ``_EMPTY`` where a bin has none."""
    out = np.full((len(texts), BINS), _EMPTY, np.uint64)
    step, owner, size = [], [], 0

    def flush():
        if step:
            of, bin_, value = _step_minima(step)
            np.minimum.at(out, (np.array(owner)[of], bin_), value)

    for i, text in enumerate(texts):
        for piece in _pieces(text, limit):
            if step and (size + len(piece) > limit or len(step) == _STEP_TEXTS):
                flush()
                step, owner, size = [], [], 0
            step.append(piece)
            owner.append(i)
            size += len(piece)
    flush()
    return out


def densify(bins: np.ndarray) -> np.ndarray:
    """Empty bins take the value of the first filled bin on their probe sequence."""
    out, filled = bins.copy(), bins != _EMPTY
    rows = np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1))
    done, attempt = filled.copy(), 0
    while len(rows):
        probe = (mix(np.arange(BINS, dtype=np.uint64) + np.uint64(BINS * (attempt + 1))) % np.uint64(BINS)).astype(np.int64)
        hit = ~done[rows] & filled[rows][:, probe]
        out[rows] = np.where(hit, bins[rows][:, probe], out[rows])
        done[rows] |= hit
        rows, attempt = rows[~done[rows].all(axis=1)], attempt + 1
    return out


def fingerprints(texts: list[str], limit: int = CHUNK_BYTES) -> list[bytes]:
    """``BINS * BITS / 8`` bytes a text; none for a text without words."""
    bins = densify(minima([t.encode("utf-8", "surrogatepass") for t in texts], limit))
    low = (mix(bins ^ _SALT) & np.uint64(2**BITS - 1)).astype(np.uint8)
    packed = low[:, ::2] << 4 | low[:, 1::2]
    none = bins[:, 0] == _EMPTY
    return [b"" if none[i] else packed[i].tobytes() for i in range(len(texts))]


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of shingles that two texts have in common, 0 to 1."""
    if not a or not b:
        return float(a == b)
    other = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    same = (np.count_nonzero(other >> 4 == 0) + np.count_nonzero(other & 15 == 0)) / BINS
    chance = 0.5**BITS
    return max(0.0, (same - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the start of the next one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


#: What tasks write; digests and fingerprints are bytes until the result is read.
_RESULT = T.StructType([
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.BinaryType()), T.StructField("fingerprint", T.BinaryType()),
    T.StructField("edited_fingerprint", T.BinaryType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def _results(texts: list[str], prints: list[bytes], nexts: list[str], next_prints: list[bytes]) -> list[pa.Array]:
    """The columns of ``_RESULT`` for rows and the rows that follow them."""
    changed = [edited(a, b) for a, b in zip(texts, nexts)]
    own = fingerprints(changed)
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed], pa.binary()),
        pa.array(prints, pa.binary()),
        pa.array(own, pa.binary()),
        pa.array([likeness(a, b) for a, b in zip(prints, own)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(prints, next_prints)], pa.float64()),
    ]


def _steps(texts: list[str], limit: int = CHUNK_BYTES):
    """Ranges of rows with some ``limit`` characters of text (one row at least)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if texts:
        yield lo, len(texts)


def _neighbours(batches):
    """Results of all rows of a sorted partition but its last (kind ``pair``), its first
    row (``head``) and its last (``tail``), with the number of the partition."""
    part, before = TaskContext.get().partitionId(), None

    def edge(kind, id_, text):
        rest = [pa.nulls(1, f.type) for f in _arrow_result()]
        return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([part], pa.int32()), id_, pa.array([text]), *rest], names=_names())

    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for lo, hi in _steps(texts):
            step, step_ids = texts[lo:hi], ids.slice(lo, hi - lo)
            prints = fingerprints(step)
            if before is None:
                yield edge("head", step_ids.slice(0, 1), step[0])
            else:
                step, prints, step_ids = [before[1], *step], [before[2], *prints], pa.concat_arrays([before[0], step_ids])
            n = len(step) - 1
            if n:
                cols = _results(step[:-1], prints[:-1], step[1:], prints[1:])
                yield pa.RecordBatch.from_arrays([pa.array(["pair"] * n), pa.array([part] * n, pa.int32()), step_ids.slice(0, n), pa.nulls(n, pa.string()), *cols], names=_names())
            before = step_ids.slice(n, 1), step[-1], prints[-1]
    if before is not None:
        yield edge("tail", *before[:2])


def _names() -> list[str]:
    return ["kind", "part", "doc_id", "text", *_RESULT.names]


def _arrow_result() -> list[pa.Field]:
    return [pa.field(f.name, {"long": pa.int64(), "double": pa.float64()}.get(f.dataType.typeName(), pa.binary())) for f in _RESULT]


def _across(batches):
    """Results of rows that came with the text of the next one."""
    for batch in batches:
        texts, nexts = batch.column("text").to_pylist(), batch.column("following").to_pylist()
        for lo, hi in _steps(texts):
            cols = _results(texts[lo:hi], fingerprints(texts[lo:hi]), nexts[lo:hi], fingerprints(nexts[lo:hi]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *cols], names=["doc_id", *_RESULT.names])


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next of every document (see the module's text for the order of rows)."""
    id_field = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    order = [F.col("doc_id").desc_nulls_last(), "rk", "salt"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), row_key().alias("rk"), F.rand(11).alias("salt"))
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("part", T.IntegerType()), id_field, T.StructField("text", T.StringType()), *_RESULT])
    found = materialize(spread.mapInArrow(_neighbours, schema), "fingerprints")
    tails, heads = found.filter("kind = 'tail'"), found.filter("kind = 'head'")
    parts = sorted(r.part for r in tails.select("part").collect())  # one number a partition
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    pairs = (tails.select("part", "doc_id", "text").join(after, "part")
             .join(heads.select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part").select("doc_id", "text", "following"))
    edges = pairs.mapInArrow(_across, T.StructType([id_field, *_RESULT]))
    both = found.filter("kind = 'pair'").select("doc_id", *_RESULT.names).unionByName(edges)
    return both.select("doc_id", *[F.lower(F.hex(f.name)).alias(f.name) if isinstance(f.dataType, T.BinaryType) else f.name for f in _RESULT])
