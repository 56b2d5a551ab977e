"""Suffix-array deduplication of bytes by merging Burrows-Wheeler transforms.

What has to be compared are contexts of some 280 bytes (see ``repeats``).  A context is
read as strings over blocks of ``BLOCK`` bytes, one string for each place modulo
``BLOCK``, so a 200-byte match is four symbols.  The contexts of a shard are split into
parts; each part gets its suffix order and its transform (the symbol before each suffix)
by itself.  The parts are merged by refining their interleave: starting with the parts
behind one another, each round sorts the merged transform stably by symbol, which orders
all suffixes by one symbol more; a border appears between two neighbours in the round in
which their common prefix ends.  After as many rounds as the window has symbols, the
suffixes between two borders share at least the window: the repeated intervals.  No
suffix of one part is ever compared with a suffix of another.

Null text: like an empty one.  Texts shorter than the window keep everything.  Rows alike
in id and text repeat each other.  A run of one letter has an anchor at each place and is
handled like any other text.  Very long texts: read whole, cut at no place.  Ties: all
occurrences go, also the first, so there is no order to break.  Empty table: empty result.
Extra columns, of any name, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from evwin.llm.common import RangeHash
from evwin.llm.repeats import Tokens, covered, marks, ranges_of, removed

WINDOW, GRAM, BLOCK, PARTS = 200, 40, 50, 4
#: Contexts merged at a time: their symbols mostly have 16-bit numbers, which sort fast.
AT_ONCE = 250


def transform(symbols: np.ndarray, size: np.ndarray, step: int, rounds: int):
    """Suffix order and transform of strings.  ``symbols``: of all contexts behind one
    another, ``size`` of each; the suffix at x goes on at x + step.  Returns, for each
    suffix in order, its place in ``symbols`` (-1: the end of a string) and the symbol
    before it (0: none); ends come first."""
    begin = np.cumsum(size) - size
    inner = np.arange(len(symbols)) - np.repeat(begin, size)
    left = np.repeat(size, size) - inner
    padded = np.concatenate([symbols, np.zeros(step * rounds, symbols.dtype)])
    at = np.arange(len(symbols))
    keys = [np.where(left > step * k, padded[at + step * k], 0) for k in range(rounds)]
    order = np.lexsort(keys[::-1])
    before = np.where(inner >= step, symbols[at - step], 0)
    last = (left <= step)  # the last symbol of its string stands before the end
    return np.concatenate([np.full(int(last.sum()), -1), order]), np.concatenate([symbols[last], before[order]])


def merge(transforms: list[np.ndarray], ends: list[int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each suffix in merged order, and the interval (suffixes that share
    ``rounds`` symbols) of each.  ``ends``: how many ends of strings each part has."""
    part = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms])
    interval = np.zeros(len(part), np.int64)
    fixed = np.repeat(np.arange(len(ends)), ends)
    for _ in range(rounds):
        before = np.empty(len(part), transforms[0].dtype if transforms else np.int64)
        for k, t in enumerate(transforms):
            before[part == k] = t
        inner = np.flatnonzero(before)
        order = inner[np.argsort(before[inner], kind="stable")]
        symbol, came = before[order], interval[order]
        border = np.r_[True, (symbol[1:] != symbol[:-1]) | (came[1:] != came[:-1])] if len(order) else np.zeros(0, bool)
        part = np.concatenate([fixed, part[order]])
        interval = np.concatenate([np.zeros(len(fixed), np.int64), np.cumsum(border)])
    return part, interval


def repeated_windows(contexts: list[bytes], n: np.ndarray, window: int = WINDOW, block: int = BLOCK, parts: int = PARTS) -> list[np.ndarray]:
    """For each context the ranges of bytes that lie in a window standing more than once,
    where context i stands n[i] times."""
    rounds, size = window // block, np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    if not len(data):
        return [np.zeros(0, np.int32) for _ in contexts]
    begin = np.cumsum(size) - size
    count = np.maximum(size - block + 1, 0)  # blocks of each context
    owner = np.repeat(np.arange(len(size)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[owner] + inner
    _, symbol = np.unique(RangeHash(data, 0)(at, at + block), return_inverse=True)
    symbol = (symbol + 1).astype(np.uint16 if symbol.max(initial=0) < 2**16 - 2 else np.int32)
    cut = np.linspace(0, len(size), parts + 1).astype(int)
    edge = np.r_[0, np.cumsum(count)][cut]
    built = [transform(symbol[a:b], count[i:j], block, rounds) for a, b, i, j in zip(edge[:-1], edge[1:], cut[:-1], cut[1:])]
    part, interval = merge([b[1] for b in built], [int((b[0] < 0).sum()) for b in built], rounds)
    place = np.empty(len(part), np.int64)
    for k, (order, _) in enumerate(built):
        place[part == k] = np.where(order < 0, -1, order + edge[k])
    window_here = place >= 0
    place, interval = place[window_here], interval[window_here]
    is_window = inner[place] <= size[owner[place]] - window
    place, interval = place[is_window], interval[is_window]
    times = np.bincount(interval, weights=n[owner[place]])
    hit = np.sort(place[times[interval] > 1])
    of = np.searchsorted(owner[hit], np.arange(len(size) + 1))
    return [ranges_of(inner[hit[a:b]], window) for a, b in zip(of[:-1], of[1:])]


def _finish(kind: Tokens, data: np.ndarray, edges) -> tuple:
    gone = marks(len(data), edges)
    runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
    return len(data), int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()


def removed_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, rk and l: where each document has repeated bytes (first, cover)."""
    return covered(docs, Tokens(False, window, gram), repeated_windows, AT_ONCE)


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    kind = Tokens(False, WINDOW, GRAM)
    return removed(docs, removed_spans(docs), kind, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", _finish)
