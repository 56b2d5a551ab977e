"""Helpers shared by the operators: tables, row keys and numpy views of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a longer single text is a step of its own.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(text: Column | str = "text") -> Column:
    """Tells rows that share a doc_id apart; rows alike in both get the same result."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` as one struct column ``_row`` beside the named key columns, so that
    extra columns of any name can't clash with an operator's own."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(*[c.alias(n) for n, c in keys.items()], row)


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind one another, and n + 1 offsets; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most ``limit`` bytes of text (one text at least)."""
    data, off = text_buffers(batch.column(text))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo), data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of word bytes, and n + 1 offsets of each text's runs."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = is_word[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def byte_class(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


#: Words between white space (0x20 and 0x09 to 0x0D).
NOT_SPACE = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ASCII letters and digits, and every byte of other characters.
ALNUM = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
#: Letters A to Z to lower case, byte by byte.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    x = x.astype(np.uint64)  # a copy
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class RangeHash:
    """64-bit polynomial hashes of any range of a sequence of tokens (bytes, or word
    hashes), from prefix sums modulo 2**64.  Two seeds make 128 bits."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, tokens: np.ndarray, seed: int):
        base = (0x9E3779B97F4A7C15 * (2 * seed + 1) | 5) % 2**64
        n, have = len(tokens) + 1, self._powers.get(seed)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            power, inverse = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
            power[0] = inverse[0] = 1
            have = self._powers[seed] = np.cumprod(power), np.cumprod(inverse)
        self.inverse, self.seed = have[1], np.uint64((seed + 1) * 0x632BE59BD9B4E019 % 2**64)
        if tokens.dtype == np.uint8:
            values = mix(np.arange(1, 257, dtype=np.uint64) * self.seed)[tokens]
        else:
            values = mix(tokens + self.seed)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * have[0][: n - 1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64) * self.seed)

    def every(self, length: int) -> np.ndarray:
        """Of all ranges of one length, at least one token."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n] + np.uint64(length) * self.seed)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return RangeHash(data, seed)(starts, ends)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.zeros(0, np.int64)
