"""Language identification by interpolated Kneser-Ney character models.

Training counts the character 5-grams of every word (padded at its start, with an end
sign) of every training text, per language, with partial sums in the tasks.  Lower orders
use continuation counts.  Every 5-gram is kept: continuation counts, discounts, totals and
probabilities are aggregations and joins over the whole table of counts.  The model holds,
for each order, gram hashes with a row of log probabilities (a column a language), and
context hashes with back-off weights, both sorted and cut by hash into pieces of
``PIECE_BYTES``.  The driver collects and broadcasts one piece at a time; a task loads one
piece of a table at a time and looks up all its words' grams there by binary search, so
that the pieces bound memory whatever the corpus, and their number changes no result.
A text goes to the language with the lowest cross-entropy per sign; ``rejected`` says that
even that one lies above ``limit``, which nearly all training texts keep to.  The score
is a softmax of the entropies with a fitted temperature, where rejection stands as one more
class whose entropy is the limit: far above it the score goes to 0.  ``learn``, which
``identify`` uses, counts all training texts and sets both on all of them, each as a model
of the other half sees it; ``train`` sets them on a sample of texts left out of its counts.

Null text or text without letters: ``und``, score 0.  Null language: not learned from.
Ties: the first language by name.  Very long texts: read whole, a step of work is
``STEP_BYTES`` of texts or one longer text.  Repeated rows: each counts, each gets the same
result; limit and temperature take a text once.  A language all of whose texts would fall
into the sample keeps them for its counts; without a sample nothing is rejected.  No training rows:
``und`` throughout.  Empty table: empty result.  Extra columns, of any name, are not read
by ``identify``; ``predict`` returns them beside its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.llm.common import RangeHash, chunks, runs, spans
from evwin.session import materialize

ORDER = 5
#: Bytes of the hashes and rows that one piece of a table of the model holds.
PIECE_BYTES = 32 << 20
#: Different texts, at most this many and of one in ``SAMPLE_OF`` only (those with the
#: smallest hashes), on which temperature and rejection are set and which are not counted.
CALIBRATION_TEXTS, SAMPLE_OF = 2000, 10
#: Share of the calibration texts that are not rejected.
ACCEPTED = 0.995
#: Entropies are told apart to this for the limit that ``learn`` sets.
STEP = 1e-4
#: Bytes of text that one step works on: equal words of a step are looked up once.
STEP_BYTES = 4 << 20
START, END = 0x02, 0x03  # no letters
_TEMPERATURES = [2.0**k for k in range(0, 9)]


class _Letters:
    """By code point: is it a letter, and its lower case if that is one code point."""

    table: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def get(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls.table is None:
            points = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x110000)]
            low = np.arange(0x110000, dtype=np.uint32)
            for i in [i for i, c in enumerate(points) if c.isupper() and len(c.lower()) == 1]:
                low[i] = ord(points[i].lower())
            cls.table = np.array([c.isalpha() for c in points]), low
        return cls.table


def _words(data: np.ndarray, off: np.ndarray):
    """Lower-case code points, and start, end of each word, and n + 1 offsets of texts' words."""
    is_letter, low = _Letters.get()
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begun = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][off]
    start, end, of = spans(points, begun, is_letter)
    return low[points], start, end, of


def _padded(points: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The words behind one another, each with ORDER - 1 start signs and an end sign; the
    places of all signs to be predicted, and the word of each."""
    length = end - start
    offset = np.cumsum(length + ORDER) - (length + ORDER)
    flat = np.full(int((length + ORDER).sum()), START, np.uint32)
    word = np.repeat(np.arange(len(start)), length)
    inner = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
    flat[offset[word] + ORDER - 1 + inner] = points[start[word] + inner]
    flat[offset + length + ORDER - 1] = END
    of = np.repeat(np.arange(len(start)), length + 1)
    at = np.arange(len(of)) - np.repeat(np.cumsum(length + 1) - (length + 1), length + 1) + offset[of] + ORDER - 1
    return flat, at, of


def _distinct(points, start, end):
    hashes = RangeHash(points, 0)(start, end)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return first, inverse


def gram_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, gram (ORDER characters), n over all rows with a language."""

    def run(batches):
        for batch in batches:
            codes = batch.column("lang").dictionary_encode()
            names, codes = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            row = 0
            for part, data, off in chunks(batch, limit=STEP_BYTES):
                points, start, end, of = _words(data, off)
                lang_of = np.repeat(codes[row : row + part.num_rows], np.diff(of))
                row += part.num_rows
                for code in np.unique(lang_of):
                    s, e = start[lang_of == code], end[lang_of == code]
                    first, inverse = _distinct(points, s, e)
                    flat, at, word = _padded(points, s[first], e[first])
                    gram = RangeHash(flat, 0)(at - ORDER + 1, at + 1)
                    _, one, group = np.unique(gram, return_index=True, return_inverse=True)
                    n = np.bincount(group, weights=np.bincount(inverse)[word]).astype(np.int64)
                    signs = flat[(at[one] - ORDER + 1)[:, None] + np.arange(ORDER)]
                    texts = np.ascontiguousarray(signs).view(f"<U{ORDER}").ravel().tolist()
                    yield pa.RecordBatch.from_arrays([pa.array([names[code]] * len(one), pa.string()), pa.array(texts, pa.string()), pa.array(n)], names=["lang", "gram", "n"])

    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


_TOP = np.uint64(1 << 63)  # turns the order of unsigned numbers into that of signed ones


class Pieces:
    """Rows of numbers by hash: sorted, cut into pieces of equal ranges of hashes, each
    broadcast on its own.  Several are held one at a time."""

    def __init__(self, parts: list[Broadcast]):
        self.parts = parts
        self.width = np.uint64(-(-(2**64) // len(parts)) - (len(parts) == 1))

    def add(self, wanted: np.ndarray, out: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Adds the rows of the hashes that are here to ``out`` at ``at``; which are."""
        found = np.zeros(len(wanted), bool)
        of = np.zeros(len(wanted), np.uint64) if len(self.parts) == 1 else wanted // self.width
        for s, shared in enumerate(self.parts):
            mine = np.flatnonzero(of == s)
            if len(mine):
                keys, rows = shared.value
                row, hit = _find(keys, wanted[mine])
                out[at[mine[hit]]] += rows[row[hit]]
                found[mine[hit]] = True
                if len(self.parts) > 1:
                    shared.__dict__.pop("_value", None)  # read again from the executor's disk
        return found

    def __getitem__(self, i: int) -> np.ndarray:
        """All sorted hashes (0) or their rows (1)."""
        return np.concatenate([shared.value[i] for shared in self.parts])


@dataclass
class Model:
    langs: list[str]
    grams: list[Pieces]  # by order from 1: log probabilities
    contexts: list[Pieces]  # by order from 1: log back-off weights
    floor: float  # log probability of a sign that no language has
    temperature: float = 16.0
    limit: float = np.inf

    def entropy(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per sign of each text by language, and each text's signs."""
        points, start, end, of = _words(data, off)
        sums, signs = np.zeros((len(off) - 1, len(self.langs))), np.zeros(len(off) - 1, np.int64)
        if len(start):
            first, inverse = _distinct(points, start, end)
            flat, at, word = _padded(points, start[first], end[first])
            each = self._signs(flat, at)
            by_word = np.add.reduceat(each, runs(word), axis=0)
            full = np.flatnonzero(np.diff(of))
            sums[full] = np.add.reduceat(by_word[inverse], of[full], axis=0)
            signs[full] = np.add.reduceat(end - start + 1, of[full])
        return -sums / np.maximum(signs, 1)[:, None], signs

    def _signs(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        out, left, ranges = np.zeros((len(at), len(self.langs)), np.float32), np.arange(len(at)), RangeHash(flat, 0)
        for k in range(ORDER, 0, -1):
            here = at[left]
            left = left[~self.grams[k - 1].add(ranges(here - k + 1, here + 1), out, left)]
            self.contexts[k - 1].add(ranges(at[left] - k + 1, at[left]), out, left)
        out[left] += self.floor
        return out

    def scores(self, entropy: np.ndarray) -> np.ndarray:
        """Softmax by language, with rejection as a class of its own."""
        low = np.minimum(entropy.min(axis=1, keepdims=True), self.limit)
        z = np.exp(-self.temperature * (entropy - low))
        return z / (z.sum(axis=1, keepdims=True) + np.exp(-self.temperature * (self.limit - low)))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.searchsorted(keys, wanted)
    row[row == len(keys)] = 0
    return row, keys[row] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _levels(counts: DataFrame, langs: list[str]) -> list[DataFrame]:
    """By order from 1: gram, c0, c1, ... (a column a language): how often it stands, and
    below ORDER how many different signs stand before it."""
    table = counts.groupBy("gram").agg(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"c{i}") for i, x in enumerate(langs)])
    out = [materialize(table, "grams")]
    for k in range(ORDER - 1, 0, -1):
        table = out[0].groupBy(F.substring("gram", 2, k).alias("gram")).agg(*[F.sum((F.col(f"c{i}") > 0).cast("long")).alias(f"c{i}") for i in range(len(langs))])
        out.insert(0, materialize(table, "grams"))
    return out


def _hashed(parts: list[DataFrame]) -> DataFrame:
    """part (place in ``parts``), h, row of tables (string, row), in this order."""

    def run(batches):
        for batch in batches:
            strings = batch.column("string").to_pylist()
            end = np.cumsum([len(x) for x in strings], dtype=np.int64)
            start = np.r_[0, end[:-1]]
            h = RangeHash(np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32), 0)(start, end)
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array((h ^ _TOP).view(np.int64)), batch.column("row")], names=["part", "h", "row"])

    every = reduce(DataFrame.unionByName, [t.select(F.lit(i).alias("part"), "string", "row") for i, t in enumerate(parts)])
    return every.mapInArrow(run, "part int, h long, row array<float>").orderBy("part", "h")


def _pieces(table: DataFrame, rows: int, langs: int) -> Pieces:
    """The table (h, row), a piece at a time."""
    n = max(1, -(-rows * (8 + 4 * langs) // PIECE_BYTES))
    width, parts = -(-(2**64) // n), []
    for s in range(n):
        mine = table if n == 1 else table.filter((F.col("h") >= s * width - 2**63) & (F.col("h") <= min((s + 1) * width, 2**64) - 1 - 2**63))
        got = mine.select("h", "row").toArrow().combine_chunks()
        h = got.column("h").to_numpy().view(np.uint64) ^ _TOP
        values = got.column("row").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(h), langs)
        order = np.argsort(h)
        parts.append(table.sparkSession.sparkContext.broadcast((h[order], values[order])))
    return Pieces(parts)


def build(counts: DataFrame) -> Model | None:
    """The model of a table (lang, gram, n); None if it is empty."""
    counts = materialize(counts, "counts")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    each, levels = range(len(langs)), _levels(counts, langs)
    kinds = reduce(DataFrame.unionAll, [t.agg(F.lit(k).alias("k"), F.count("*"), *[F.count(F.when(F.col(f"c{i}") == n, 1)) for n in (1, 2) for i in each]) for k, t in enumerate(levels)])
    by_order = {r[0]: r[1:] for r in kinds.collect()}
    vocabulary = by_order[0][0] + 1
    tables, below = [], None
    for k, table in enumerate(levels, 1):
        ones, twos = by_order[k - 1][1 : len(langs) + 1], by_order[k - 1][len(langs) + 1 :]
        discount = [min(max(a / max(a + 2 * b, 1), 0.1), 0.95) for a, b in zip(ones, twos)]
        head = F.substring("gram", 1, k - 1).alias("head")
        sums = table.groupBy(head).agg(*[F.sum(f"c{i}").alias(f"t{i}") for i in each], *[F.sum((F.col(f"c{i}") > 0).cast("long")).alias(f"s{i}") for i in each])
        back = [F.when(F.col(f"t{i}") > 0, discount[i] * F.col(f"s{i}") / F.col(f"t{i}")).otherwise(1.0).alias(f"b{i}") for i in each]
        contexts = sums.select("head", *[f"t{i}" for i in each], *back)
        rows = table.withColumn("head", head)
        rows = rows.join(F.broadcast(contexts) if k == 1 else contexts, "head")
        if k == 1:
            lower = [F.lit(1 / vocabulary) for i in each]
        else:
            lower = [F.col(f"q{i}") for i in each]
            rows = rows.withColumn("tail", F.substring("gram", 2, k - 1)).join(below.select(F.col("gram").alias("tail"), *[F.col(f"p{i}").alias(f"q{i}") for i in each]), "tail")
        p = [(F.greatest(F.col(f"c{i}") - discount[i], F.lit(0.0)) / F.greatest(F.col(f"t{i}"), F.lit(1)) + F.col(f"b{i}") * lower[i]).alias(f"p{i}") for i in each]
        below = materialize(rows.select("gram", *p), "probabilities")
        tables.append(below.select(F.col("gram").alias("string"), F.array(*[F.log(f"p{i}").cast("float") for i in each]).alias("row")))
        tables.append(contexts.select(F.col("head").alias("string"), F.array(*[F.log(f"b{i}").cast("float") for i in each]).alias("row")))
    every = materialize(_hashed(tables), "model")
    size = {r["part"]: r["count"] for r in every.groupBy("part").count().collect()}
    pieces = [_pieces(every.filter(F.col("part") == i), size[i], len(langs)) for i in range(2 * ORDER)]
    return Model(langs, pieces[::2], pieces[1::2], -float(np.log(vocabulary)))


def calibration(docs: DataFrame, lang: str = "lang") -> dict[int, str]:
    """xxhash64 of each text to calibrate on, and its language (of several the first)."""
    named = docs.filter(F.col(lang).isNotNull() & F.col("text").rlike(r"\p{L}")).select(F.xxhash64("text").alias("h"), F.col(lang).cast("string").alias("lang"))
    mine = named.filter(F.pmod("h", F.lit(SAMPLE_OF)) == 0).groupBy("h").agg(F.array_sort(F.collect_set("lang")).alias("langs"))
    chosen = {r.h: r.langs for r in mine.orderBy("h").limit(CALIBRATION_TEXTS).collect()}
    rest = {r.lang for r in named.filter(~F.col("h").isin([*chosen])).select("lang").distinct().collect()}
    return {h: langs[0] for h, langs in chosen.items() if rest.issuperset(langs)}


def _entropies(texts: DataFrame, model: Model) -> DataFrame:
    """h, entropy (by language) of ``texts``: long texts stay in the tasks."""

    def run(batches):
        for batch in batches:
            h = batch.column("h").to_numpy()
            batch = batch.take(pa.array(np.sort(np.unique(h, return_index=True)[1])))
            for part, data, off in chunks(batch, limit=STEP_BYTES):
                entropy, _ = model.entropy(data, off)
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(entropy) + 1) * len(model.langs), pa.int32()), pa.array(entropy.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("h"), rows], names=["h", "entropy"])

    return texts.mapInArrow(run, "h long, entropy array<double>")


def _cross_entropies(texts: DataFrame, model: Model, langs: list[str]) -> DataFrame:
    """h, lang, entropy (by ``langs``) of texts in the model's languages."""
    place = [langs.index(x) for x in model.langs]

    def run(batches):
        for batch in batches:
            for part, data, off in chunks(batch, limit=STEP_BYTES):
                entropy, _ = model.entropy(data, off)
                every = np.full((len(entropy), len(langs)), np.inf)
                every[:, place] = entropy
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(every) + 1) * len(langs), pa.int32()), pa.array(every.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("lang"), rows], names=["h", "lang", "entropy"])

    return texts.filter(F.col("lang").isin(model.langs)).mapInArrow(run, "h long, lang string, entropy array<double>")


def learn(docs: DataFrame, lang: str = "lang") -> Model | None:
    """Model of all rows of ``docs`` with a language; temperature and limit are set on all
    their different texts, each half of the texts (by hash) as a model of the other half
    sees it.  Languages whose texts are all in one half don't count for the temperature;
    with one half only nothing is rejected."""
    named = docs.filter(F.col(lang).isNotNull() & F.col("text").isNotNull()).select(F.xxhash64("text").alias("h"), F.col(lang).cast("string").alias("lang"), "text")
    halves = [named.filter(F.pmod("h", F.lit(2)) == k) for k in (0, 1)]
    counts = [materialize(gram_counts(half), "half") for half in halves]
    model = build(counts[0].unionByName(counts[1]).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    if model is None:
        return None
    seen = []
    for half, others in zip(halves, reversed(counts)):
        other = build(others)
        if other is not None:
            seen.append(_cross_entropies(half.filter(F.col("text").rlike(r"\p{L}")), other, model.langs))
    if not seen:
        return model
    every = reduce(DataFrame.unionByName, seen).groupBy("h").agg(F.min("lang").alias("lang"), F.first("entropy").alias("entropy"))
    every = materialize(every, "entropies")
    # in steps of STEP, so that there are few different values however many texts
    low = every.groupBy(F.ceil(F.array_min("entropy") / STEP).alias("low")).count().orderBy("low").collect()
    if not low:
        return model
    upto = np.cumsum([r["count"] for r in low])
    model.limit = low[int(np.searchsorted(upto, ACCEPTED * upto[-1]))].low * STEP
    langs, limit = model.langs, model.limit

    def losses(batches):
        rated, place = Model(langs, [], [], 0.0, limit=limit), {x: i for i, x in enumerate(langs)}
        for batch in batches:
            entropy = batch.column("entropy").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(langs))
            truth, at = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64), np.arange(len(entropy))
            sums = []
            for rated.temperature in _TEMPERATURES:
                sums.append(-np.log(np.maximum(rated.scores(entropy)[at, truth], 1e-9)).sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], names=["i", "loss"])

    rows = every.mapInArrow(losses, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
    model.temperature = _TEMPERATURES[min(rows, key=lambda r: (r.loss, r.i)).i]
    return model


def train(docs: DataFrame, lang: str = "lang") -> Model | None:
    """Model of the rows of ``docs`` with a language, calibrated on a sample that is left
    out of the counts; None without any.  ``learn`` leaves nothing out."""
    chosen = calibration(docs, lang)
    sampled = F.coalesce(F.xxhash64("text").isin([*chosen]), F.lit(False))
    model = build(gram_counts(docs.filter(~sampled), lang))
    if model is None:
        return None
    texts = docs.filter(sampled).select(F.xxhash64("text").alias("h"), "text")
    sample = _entropies(texts, model).groupBy("h").agg(F.first("entropy").alias("entropy")).orderBy("h").toArrow().to_pandas()
    if len(sample):
        entropy = np.stack(sample["entropy"])
        truth = sample["h"].map({h: model.langs.index(x) for h, x in chosen.items()}).to_numpy()
        model.limit = float(np.quantile(entropy.min(axis=1), ACCEPTED))

        def loss(t: float) -> float:
            model.temperature = t
            return -np.log(np.maximum(model.scores(entropy)[np.arange(len(truth)), truth], 1e-9)).mean()

        model.temperature = min(_TEMPERATURES, key=loss)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """The other columns of ``docs`` and lang_pred, score, cross_entropy, rejected."""
    kept = [c for c in docs.columns if c != "text"]
    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())]

    def run(batches):
        for batch in batches:
            for part, data, off in chunks(batch, limit=STEP_BYTES):
                n = part.num_rows
                if model is None:
                    found = [["und"] * n, [0.0] * n, [None] * n, [True] * n]
                else:
                    entropy, signs = model.entropy(data, off)
                    best, has = entropy.argmin(axis=1), signs > 0
                    low, at = entropy.min(axis=1), np.arange(n)
                    names = np.where(has, np.array(model.langs, object)[best], "und")
                    found = [names.tolist(), np.where(has, model.scores(entropy)[at, best], 0.0), pa.array(low, mask=~has), ~has | (low > model.limit)]
                cols = [pa.array(x, f) for x, f in zip(found, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *cols], names=[*kept, *[e.name for e in extra]])

    return docs.mapInArrow(run, T.StructType([*[docs.schema[c] for c in kept], *extra]))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict all."""
    model = learn(docs.filter(~held_out()).select("text", "lang"))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")
