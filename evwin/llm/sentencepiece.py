"""SentencePiece (BPE) encoding by suffix-array matching, and decoding.

A step takes the texts of one slice of a batch.  They are cut into units (a run of the
space sign and what follows it, or one character that no piece has); no piece reaches
across.  The different units not met before by the task are concatenated and their suffixes sorted to the length of
the longest piece; every piece is looked up by binary search, which gives the range of
its occurrences; these edges are sorted by position and relaxed from left to right.  A
BPE result is the one path on which every two neighbouring pieces stay apart when they
are merged alone, so an edge is taken if the piece that ends where it begins goes
together with it; exactly one edge is taken for each end.  Two pieces stay apart if, as
the merges inside both run by rank, no merge across their border ever comes first.

Equal to the SentencePiece library for BPE models with identity normalisation, a dummy
prefix and byte fallback; others are refused.  Null text: null ids.  Empty text: no ids.
The sign U+2581 in a text is a space after decoding, as in the library.  Very long texts:
encoded whole, one text a step.  Ties: pieces rank by their place in the model, so there
are none.  Repeated rows: each gets its own result, the same one.  Empty table: empty
result.  ``tokenize`` reads no extra columns; ``encode`` and ``decode`` return those of the
input beside their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evwin.llm.common import RangeHash, chunks, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
STEP_BYTES = 2 << 20
#: Answers about pairs of pieces that a worker keeps (a table of fixed size).
PAIR_SLOTS = 1 << 21
#: Units whose ids a worker keeps; beyond that it starts anew.
KEPT_UNITS = 1 << 20
_NEVER = np.int32(2**31 - 1)


@dataclass
class Pieces:
    """What encoding and decoding need of a model; small, sent to the executors once."""

    strings: list[str]  # by id; empty where a piece isn't ordinary
    rank: np.ndarray  # by id: 0 merges first; equal scores share a rank
    byte_ids: np.ndarray  # by byte
    raw: list[bytes]  # what each id decodes to
    codes: np.ndarray = field(init=False)

    def __post_init__(self):
        v = len(self.strings)
        ids = {s: i for i, s in enumerate(self.strings) if s}
        if any(c not in ids for s in ids for c in s):
            raise ValueError("every character of a piece has to be a piece")
        if any(chr(SPACE) in s.lstrip(chr(SPACE)) for s in ids):
            raise ValueError("a piece with a space inside a word")
        pairs = [(ids[s[:k]] * v + ids[s[k:]], self.rank[i]) for s, i in ids.items() for k in range(1, len(s)) if s[:k] in ids and s[k:] in ids]
        order = sorted(pairs)
        self.pair_keys, self.pair_ranks = np.array([p[0] for p in order], np.int64), np.array([p[1] for p in order], np.int32)
        known = dict(pairs)
        self.longest = max(map(len, ids))
        # each piece's own merges: rank of step k, and its last and first symbol before it
        self.steps = np.full((v + 1, self.longest), _NEVER, np.int32)
        self.tail, self.head = np.full((v + 1, self.longest), v, np.int32), np.full((v + 1, self.longest), v, np.int32)
        usable = []
        for s, i in ids.items():
            parts = [ids[c] for c in s]
            for k in range(len(s)):
                self.tail[i, k:], self.head[i, k:] = parts[-1], parts[0]
                found = [(known.get(a * v + b, _NEVER), n) for n, (a, b) in enumerate(zip(parts, parts[1:]))]
                best = min(found, default=(_NEVER, 0))
                if best[0] == _NEVER:
                    break
                self.steps[i, k], n = best
                parts[n : n + 2] = [ids[self.strings[parts[n]] + self.strings[parts[n + 1]]]]
            if len(parts) == 1:  # else no text is ever encoded with it
                usable.append(i)
        self.usable = np.array(usable, np.int32)
        self.length = np.array([len(s) for s in self.strings] + [1], np.int32)
        self.alphabet = np.zeros(0x110000, bool)
        self.alphabet[[ord(c) for s in ids for c in s]] = True
        self.points = np.zeros((v, self.longest), np.uint32)
        for s, i in ids.items():
            self.points[i, : len(s)] = [ord(c) for c in s]
        self.raw_start = np.r_[0, np.cumsum([len(r) for r in self.raw])]
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Do the pieces a and b stay two when the text of both is merged?"""
        v = len(self.strings)
        left, i, j, out = np.arange(len(a)), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), np.ones(len(a), bool)
        while len(left):
            x, y = a[left], b[left]
            p, q = i[left], j[left]
            ra, rb = self.steps[x, np.minimum(p, self.longest - 1)], self.steps[y, np.minimum(q, self.longest - 1)]
            key = self.tail[x, np.minimum(p, self.longest - 1)].astype(np.int64) * v + self.head[y, np.minimum(q, self.longest - 1)]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            cross = np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)
            merged = (cross < ra) & (cross <= rb) & (cross < _NEVER)
            out[left[merged]] = False
            first = ra <= rb
            i[left] += first
            j[left] += ~first
            left = left[~merged & ((ra < _NEVER) | (rb < _NEVER))]
        return out


def load(path: str = MODEL) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, spec = model.normalizer_spec, model.trainer_spec
    if spec.model_type != spec.BPE or not spec.byte_fallback or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or spec.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback, a dummy prefix and identity normalisation")
    kinds = model.SentencePiece
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError("user-defined or unused pieces")
    ordinary = [p.type == kinds.NORMAL for p in model.pieces]
    _, rank = np.unique([-p.score for p in model.pieces], return_inverse=True)
    byte_ids, raw = np.zeros(256, np.int32), []
    for i, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            byte_ids[int(p.piece[3:5], 16)] = i
            raw.append(bytes([int(p.piece[3:5], 16)]))
        else:
            raw.append(p.piece.replace(chr(SPACE), " ").encode() if ordinary[i] else " ⁇ ".encode() if p.type == kinds.UNKNOWN else b"")
    return Pieces([p.piece if o else "" for p, o in zip(model.pieces, ordinary)], rank.astype(np.int32), byte_ids, raw)


class Encoder:
    """Encodes texts of one worker; keeps answers about pairs in a table of fixed size."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.pair, self.answer = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, bool)
        self._forget()

    def _forget(self) -> None:
        """Units met so far: sorted hashes, second hashes, where their ids begin, how many."""
        self.hash, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind one another, and n + 1 offsets of each text's."""
        points, text_of = self._points(data, off)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        known = self.p.alphabet[points]
        space = points == SPACE
        new = np.r_[True, (text_of[1:] != text_of[:-1]) | (space[1:] & ~space[:-1]) | ~known[1:] | ~known[:-1]]
        start = np.flatnonzero(new)
        end = np.r_[start[1:], len(points)]
        begun, count, ids = self._looked_up(points, start, end)
        out = ids[np.repeat(begun - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        per_text = np.bincount(text_of[start], weights=count, minlength=len(off) - 1).astype(np.int64)
        return out, np.r_[0, np.cumsum(per_text)]

    @staticmethod
    def _points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points with a space sign before every text that isn't empty, and their text."""
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        begun = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][off]
        size = np.diff(begun)
        full = np.flatnonzero(size)
        text_of = np.repeat(full, size[full] + 1)
        out = np.full(len(text_of), SPACE, np.uint32)
        inner = np.ones(len(text_of), bool)
        inner[np.cumsum(size[full] + 1) - (size[full] + 1)] = False
        out[inner] = np.where(points == 0x20, SPACE, points)
        return out, text_of

    def _looked_up(self, points, start, end):
        """For each unit where its ids begin, how many they are; and the array of ids.
        Only units not met before are encoded."""
        h, check = RangeHash(points, 0)(start, end), RangeHash(points, 1)(start, end)
        some, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hash) + len(some) > KEPT_UNITS:
            self._forget()
        at = np.minimum(np.searchsorted(self.hash, some), max(len(self.hash) - 1, 0))
        met = self.hash[at] == some if len(self.hash) else np.zeros(len(some), bool)
        if (check != check[first][inverse]).any() or (self.check[at[met]] != check[first[met]]).any():
            ids, n = self._units(points, start, end)  # two units share a hash: each by itself
            return np.cumsum(n) - n, n, ids
        new = first[~met]
        if len(new):
            ids, n = self._units(points, start[new], end[new])
            order = np.argsort(np.concatenate([self.hash, some[~met]]), kind="stable")
            self.begin = np.concatenate([self.begin, np.cumsum(n) - n + len(self.flat)])[order]
            self.flat, self.count = np.concatenate([self.flat, ids]), np.concatenate([self.count, n])[order]
            self.check, self.hash = np.concatenate([self.check, check[new]])[order], np.concatenate([self.hash, some[~met]])[order]
        at = np.searchsorted(self.hash, some)[inverse]
        return self.begin[at], self.count[at], self.flat

    def _units(self, points, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units behind one another, and how many each has."""
        size = end - start
        unit = np.repeat(np.arange(len(size)), size)
        base = np.cumsum(size) - size
        inner = np.arange(len(unit)) - base[unit]
        text = points[start[unit] + inner]
        at, piece = self._edges(text)
        stop = inner[at] + self.p.length[piece]
        fits = stop <= size[unit[at]]
        at, piece, stop = at[fits], piece[fits], stop[fits]
        order = np.argsort(stop.astype(np.int16) if len(stop) and stop.max() < 2**15 else stop, kind="stable")
        at, piece, stop = at[order], piece[order], stop[order]
        v = len(self.p.strings)
        slot = base + np.arange(len(size))  # each unit has a slot for every place and its end
        last = np.full(len(text) + len(size), -1, np.int32)
        last[slot] = v
        begin, ending = slot[unit[at]] + inner[at], slot[unit[at]] + stop
        cuts = np.flatnonzero(np.r_[True, stop[1:] != stop[:-1], True]) if len(stop) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            before = last[begin[a:b]]
            ok = before >= 0
            pairs = np.flatnonzero(ok & (before < v))
            ok[pairs] = self._apart(before[pairs], piece[a:b][pairs])
            last[ending[a:b][ok]] = piece[a:b][ok]
        return self._read(last, slot, size, text, base)

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.p.strings) + b
        slot = (mix(key) % np.uint64(PAIR_SLOTS)).astype(np.int64)
        new = np.flatnonzero(self.pair[slot] != key)
        if len(new):
            some, one = np.unique(key[new], return_index=True)
            one = new[one]
            told = self.p.apart(a[one], b[one])
            out = self.answer[slot]
            out[new] = told[np.searchsorted(some, key[new])]
            self.pair[slot[one]], self.answer[slot[one]] = key[one], told
            # two keys of one slot: the last one written stays, with its own answer
            self.answer[slot[one]] = np.where(self.pair[slot[one]] == key[one], told, self.answer[slot[one]])
            return out
        return self.answer[slot]

    def _edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and id of every occurrence of every piece in ``text``."""
        signs, code = np.unique(text, return_inverse=True)
        bits = int(len(signs) + 1).bit_length()
        per, n, deep = 63 // bits, len(text), self.p.longest
        codes = np.zeros(n + deep + per, np.int64)
        codes[:n] = code + 1
        words = []
        for lo in range(0, deep, per):
            word = np.zeros(n, np.int64)
            for k in range(per):
                word = word << bits | codes[lo + k : lo + k + n]
            words.append(word)
        suffixes = np.lexsort(words[::-1])
        keys = [w[suffixes] for w in words]
        place = np.minimum(np.searchsorted(signs, self.p.points), len(signs) - 1)
        is_sign = self.p.points > 0
        here = self.p.usable[((signs[place] == self.p.points) | ~is_sign).all(axis=1)[self.p.usable]]
        low = [np.zeros(len(here), np.int64) for _ in words]
        high = [np.zeros(len(here), np.int64) for _ in words]
        for k in range(per * len(words)):
            c = np.where(is_sign[here, k], place[here, k] + 1, 0) if k < deep else np.zeros(len(here), np.int64)
            past = self.p.length[here] <= k
            w = k // per
            low[w] = low[w] << bits | np.where(past, 0, c)
            high[w] = high[w] << bits | np.where(past, (1 << bits) - 1, c)
        a, b = _bisect(keys, low, False), _bisect(keys, high, True)
        n_each = b - a
        return suffixes[np.repeat(a - (np.cumsum(n_each) - n_each), n_each) + np.arange(n_each.sum())], np.repeat(here, n_each)

    def _read(self, last, slot, size, text, base) -> tuple[np.ndarray, np.ndarray]:
        v, out_unit, out_id, unit = len(self.p.strings), [], [], np.arange(len(size))
        place = size.copy()
        lone = (size == 1) & ~self.p.alphabet[text[base]]  # a character that no piece has
        raw = [self.p.byte_ids[list(chr(c).encode("utf-8", "replace"))] for c in text[base[lone]].tolist()]
        unit = unit[~lone]
        while len(unit):  # from each unit's end to its start
            got = last[slot[unit] + place[unit]]
            out_unit.append(unit)
            out_id.append(got)
            place[unit] -= self.p.length[got]
            unit = unit[place[unit] > 0]
        units = np.concatenate([*out_unit[::-1], np.repeat(np.flatnonzero(lone), [len(r) for r in raw])]).astype(np.int64)
        ids = np.concatenate([*out_id[::-1], *raw]).astype(np.int32)
        order = np.argsort(units, kind="stable")
        return ids[order], np.bincount(units, minlength=len(size))


def _bisect(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Where each wanted key (in several words) would go among the sorted keys."""
    lo, hi = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]), np.int64)
    for _ in range(int(len(keys[0])).bit_length() + 1):
        open_ = lo < hi
        mid = np.minimum((lo + hi) >> 1, len(keys[0]) - 1)
        less, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for k, w in zip(keys, wanted):
            x = k[mid]
            less |= same & (x < w)
            same &= x == w
        go = (less | same if after else less) & open_
        lo, hi = np.where(go, mid + 1, lo), np.where(open_ & ~go, mid, hi)
    return lo


def decoded_bytes(pieces: Pieces, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
    """What each run of ids decodes to, without the dummy prefix."""
    size = np.diff(pieces.raw_start)[ids]
    flat = pieces.raw_bytes[np.repeat(pieces.raw_start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes()
    cut = np.r_[0, np.cumsum(size)][off].tolist()
    return [flat[a + (flat[a : a + 1] == b" " and a < b) : b] for a, b in zip(cut[:-1], cut[1:])]


def decode_ids(pieces: Pieces, ids: np.ndarray, off: np.ndarray) -> list[str]:
    return [x.decode("utf-8", "replace") for x in decoded_bytes(pieces, ids, off)]


def _lists(off: np.ndarray, ids: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32), mask=np.r_[null, False]), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, pieces: Pieces, text: str = "text") -> DataFrame:
    """The other columns of ``docs``, n_tokens, ids, and round_trip: decoding gives the
    text back (but for U+2581, which stands for a space)."""
    kept, shared = [c for c in docs.columns if c != text], docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        encoder, mark = Encoder(shared.value), chr(SPACE).encode()
        for batch in batches:
            for part, data, off in chunks(batch, text, STEP_BYTES):
                ids, at = encoder(data, off)
                null = part.column(text).is_null().to_numpy(zero_copy_only=False)
                raw, edge = data.tobytes(), off.tolist()
                same = [raw[a:b].replace(mark, b" ") == x for a, b, x in zip(edge[:-1], edge[1:], decoded_bytes(shared.value, ids, at))]
                cols = [pa.array(np.diff(at)), _lists(at, ids, null), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *cols], names=[*kept, "n_tokens", "ids", "round_trip"])

    extra = T._parse_datatype_string("n_tokens long, ids array<int>, round_trip boolean").fields
    return docs.mapInArrow(run, T.StructType([*[docs.schema[c] for c in kept], *extra]))


def decode(docs: DataFrame, pieces: Pieces, ids: str = "ids") -> DataFrame:
    """``docs`` with its ids and ``decoded``; null ids: null."""
    kept, shared = docs.columns, docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        for batch in batches:
            lists = batch.column(ids)
            flat, size = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            texts = decode_ids(shared.value, flat.astype(np.int64), np.r_[0, np.cumsum(size)])
            out = pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False)) if len(texts) else pa.array([], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], out], names=[*kept, "decoded"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("decoded", T.StringType())]))


def tokenize(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of every document."""
    return encode(docs.select("doc_id", "text"), load(path))
