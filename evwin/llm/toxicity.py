"""Toxicity by a classifier chain.

The categories stand in a fixed order; each has a sparse logistic model on the words that
a text has, their prefixes and how often they stand, and on the probabilities of the
categories before it.  In training those
come from models that did not see the row (out-of-fold); in use from the models fitted
on all rows.  The last category is the label itself; the earlier ones are weak: a toxic
row that has one of the category's words.  A category without both kinds of rows has a
constant model.

Training takes ``MOST_ROWS`` labelled documents of the table at most (those whose ids have
the smallest hashes) with ``MOST_BYTES`` of text, which bounds what the driver fits on.  A
document that does not fit is passed over, the ones after it are not; one that is longer
than its class's share of the bytes is never fitted on, unless the class has only such:
then its shortest is.  If a class has labels, but none of a document in the table, nothing
is learned: probability 0.  Scoring reads every whole text.  Null or
empty text: no words, so the intercepts alone.  Null labels are not learned from; a doc_id
with several labels is toxic if one says so.  No labels at all: probability 0.  Empty
table: empty result.  Ties: at the threshold a document is toxic; ids whose hashes are
equal go by id.  Repeated rows: each gets the same result; rows that share a labelled id
are all fitted on, and their bytes count together.  Very long texts: scored whole, one text
a step.  Extra columns, of any name, are kept by ``keep_clean`` and not read by ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.llm.common import ALNUM, LOWER, RangeHash, chunks, mix, packed, spans, unpacked

#: Labelled rows of each class (0 and 1) that the models are fitted on at most, and bytes of
#: their texts: this bounds what reaches the driver.
MOST_ROWS, MOST_BYTES = {0: 2000, 1: 1000}, 12 << 20
#: Lengths in bytes of the prefixes of longer words that are features too: stems.
PREFIXES = (4, 5, 6, 7, 8)
#: Features that one model may use at most: those that tell its rows apart best.
MAX_WORDS = 512
#: A feature has to stand in so many labelled rows.
LEAST_ROWS = 3
FOLDS = 3
#: Weight of the L1 penalty against the mean loss of a row.
PENALTY = 2e-4
STEPS = 250
#: From this probability on a document is toxic.
THRESHOLD = 0.5
# Words that make a toxic row one of the category.
CATEGORIES = {
    "insult": ["idiot", "moron", "stupid", "dumb", "fool", "loser", "clown", "imbecile"],
    "contempt": ["pathetic", "worthless", "disgusting", "scum", "trash", "garbage", "vermin", "filth"],
}


def _features(data: np.ndarray, off: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value), each pair of row and feature once: the lower-case words and
    their prefixes of 4 to 8 bytes, as 32-bit hashes, and log2(1 + how often).  With
    ``known`` (sorted) only those features."""
    low = LOWER[data]
    start, end, of = spans(low, off, ALNUM)
    doc, ranges = np.repeat(np.arange(len(off) - 1), np.diff(of)), RangeHash(low, 0)
    rows, hashes = [], []
    for k in (0, *PREFIXES):
        longer = end - start > k
        s = start[longer]
        h = (ranges(s, s + k) if k else mix(ranges(s, end[longer]))) >> np.uint64(32)
        r = doc[longer]
        if known is not None:
            hit = _place(known, h)[1]
            r, h = r[hit], h[hit]
        rows.append(r)
        hashes.append(h)
    pair, n = np.unique(np.concatenate(rows).astype(np.uint64) << np.uint64(32) | np.concatenate(hashes), return_counts=True)
    return (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.log2(1 + n)


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted.astype(np.uint32)), len(keys) - 1)
    return at, keys[at] == wanted


def _hash(word: str) -> np.uint32:
    data = np.frombuffer(word.encode(), np.uint8)
    whole = mix(RangeHash(data, 0)(np.array([0]), np.array([len(data)]))) >> np.uint64(32)
    return np.uint32(whole[0])


@dataclass
class Linear:
    words: np.ndarray  # sorted features
    weights: np.ndarray
    chained: np.ndarray  # of the earlier categories' probabilities
    bias: float

    def __call__(self, rows: np.ndarray, features: np.ndarray, values: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Probabilities of texts, given their features and the earlier probabilities."""
        at, hit = _place(self.words, features)
        votes = np.bincount(rows[hit], weights=self.weights[at[hit]] * values[hit], minlength=len(before)) if hit.any() else 0
        return 1 / (1 + np.exp(-np.clip(self.bias + before @ self.chained + votes, -40, 40)))


@dataclass
class Chain:
    names: list[str] = field(default_factory=list)
    models: list[Linear] = field(default_factory=list)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Probabilities, a column a category."""
        known = np.unique(np.concatenate([np.zeros(0, np.uint32), *[m.words for m in self.models]]))
        rows, features, values = _features(data, off, known)
        out = np.zeros((len(off) - 1, 0))
        for model in self.models:
            out = np.column_stack([out, model(rows, features, values, out)])
        return out


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression with balanced classes by accelerated proximal
    gradient steps; the bias goes free."""
    n, d = x.shape
    if not 0 < y.sum() < n:
        rate = np.clip(y.mean() if n else 0.0, 1e-6, 1 - 1e-6)
        return np.zeros(d), float(np.log(rate / (1 - rate)))
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    scale = 4 / (np.linalg.norm(np.sqrt(weight)[:, None] * x, 2) ** 2 + 1)  # 1 over the bound of the curvature
    w, b, pw, pb, t = np.zeros(d), 0.0, np.zeros(d), 0.0, 1.0
    for _ in range(STEPS):
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = w + (t - 1) / t2 * (w - pw), b + (t - 1) / t2 * (b - pb)
        error = weight * (1 / (1 + np.exp(-np.clip(x @ vw + vb, -40, 40))) - y)
        nw = vw - scale * (error @ x)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - scale * PENALTY, 0)
        pw, pb, w, b, t = w, b, nw, vb - scale * error.sum(), t2
    return w, float(b)


def _telling(word: np.ndarray, row: np.ndarray, y: np.ndarray, m: int) -> np.ndarray:
    """The features (codes 0 to m - 1) whose rows differ most from the rest in their share
    of ``y``, by the z-score of two shares."""
    n, positive = np.bincount(word, minlength=m), np.bincount(word, weights=y[row], minlength=m)
    rate = y.mean()
    z = np.abs(positive - n * rate) / np.sqrt(np.maximum(n * rate * (1 - rate) * (1 - n / (len(y) + 1)), 1e-9))
    return np.sort(np.argsort(-z, kind="stable")[:MAX_WORDS])


def fit(features: list[np.ndarray], values: list[np.ndarray], toxic: np.ndarray, categories: dict[str, list[str]] = CATEGORIES) -> Chain:
    """The chain of rows given by their features, the features' values, and labels."""
    size = len(features)
    row = np.repeat(np.arange(size, dtype=np.int32), [len(f) for f in features])
    hashes = np.concatenate([*features, np.zeros(0, np.uint32)]).astype(np.uint32)
    value = np.concatenate([*values, np.zeros(0, np.float32)])
    targets = {}
    for name, seeds in categories.items():
        has = np.zeros(size, bool)
        has[row[np.isin(hashes, np.array([_hash(s) for s in seeds], np.uint32))]] = True
        targets[name] = (has & (toxic > 0)).astype(float)
    targets["toxic"] = (toxic > 0).astype(float)
    vocabulary, code, n = np.unique(hashes, return_inverse=True, return_counts=True)
    common = n >= LEAST_ROWS
    vocabulary, renamed, often = vocabulary[common], np.cumsum(common) - 1, common[code]
    row, code, value = row[often], renamed[code[often]], value[often]
    fold = np.arange(size) % FOLDS
    chain, before = Chain(), np.zeros((size, 0))
    for name, y in targets.items():
        chosen = _telling(code, row, y, len(vocabulary)) if len(vocabulary) and 0 < y.mean() < 1 else np.zeros(0, np.int64)
        place = np.full(len(vocabulary) + 1, -1)
        place[chosen] = np.arange(len(chosen))
        x = np.zeros((size, len(chosen) + before.shape[1]))
        in_use = place[code] >= 0
        x[row[in_use], place[code[in_use]]] = value[in_use]
        x[:, len(chosen) :] = before
        w, b = _fit(x, y)
        used = w[: len(chosen)] != 0
        chain.names.append(name)
        chain.models.append(Linear(vocabulary[chosen][used], w[: len(chosen)][used], w[len(chosen) :], b))
        unseen = np.zeros(size)
        for k in range(FOLDS):  # what a model says of rows that it has not seen
            fw, fb = _fit(x[fold != k], y[fold != k])
            unseen[fold == k] = 1 / (1 + np.exp(-np.clip(x[fold == k] @ fw + fb, -40, 40)))
        before = np.column_stack([before, unseen])
    return chain


def sample(docs: DataFrame, labels: DataFrame, most: dict[int, int], most_bytes: int) -> list[tuple]:
    """(doc_id, toxic) of the documents to fit on: of each class those whose ids have the
    smallest hashes, ``most`` of it at most, and of them those that fit in its share of
    ``most_bytes`` of text.  Empty if a class that has labels has no document."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = docs.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
    there = known.join(sizes, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    out, share = [], most_bytes // len(most)
    for toxic, n in most.items():
        mine, total = there.filter(F.col("toxic") == toxic), 0
        fitting = mine.filter(F.col("size") <= share).orderBy("h", "doc_id").limit(n).collect()  # n rows of four numbers
        for r in fitting or mine.orderBy("size", "h", "doc_id").limit(1).collect():
            if not fitting or total + r["size"] <= share:
                total += r["size"]
                out.append((r["doc_id"], toxic))
    if {r["toxic"] for r in known.select("toxic").distinct().collect()} & set(most) - {t for _, t in out}:
        return []
    return out


def train(docs: DataFrame, labels: DataFrame, most: dict[int, int] = MOST_ROWS, most_bytes: int = MOST_BYTES) -> Chain | None:
    """The chain fitted on a bounded sample of the labelled documents; None without any."""
    chosen = sample(docs, labels, most, most_bytes)
    if not chosen:
        return None
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", "text").join(F.broadcast(docs.sparkSession.createDataFrame(chosen, f"doc_id {kind}, toxic int")), "doc_id")

    def run(batches):
        for batch in batches:
            for part, data, off in chunks(batch):
                row, feature, value = _features(data, off)
                at = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (feature.view(np.int32), value.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), *lists], names=["doc_id", "toxic", "features", "vals"])

    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("toxic int, features array<int>, vals array<float>").fields])
    rows = texts.mapInArrow(run, schema).toArrow()
    order = rows.column("doc_id").to_pylist(), rows.column("features").combine_chunks(), rows.column("vals").combine_chunks()
    rows = sorted(((str(d), f.values.to_numpy().tobytes(), v.values.to_numpy(), t) for d, f, v, t in zip(*order, rows.column("toxic").to_pylist())), key=lambda r: r[:2])
    return fit([np.frombuffer(f, np.uint32) for _, f, _, _ in rows], [v for _, _, v, _ in rows], np.array([t for *_, t in rows]))


def with_probabilities(df: DataFrame, chain: Chain | None, names: list[str] | None = None) -> DataFrame:
    """The columns of ``df`` but for text, and p_<category> of each category."""
    kept = [c for c in df.columns if c != "text"]
    names = names or [*CATEGORIES, "toxic"]
    shared = df.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        chain = shared.value
        for batch in batches:
            for part, data, off in chunks(batch):
                p = chain(data, off) if chain else np.zeros((part.num_rows, len(names)))
                cols = [part.column(c) for c in kept] + [pa.array(p[:, i]) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(cols, names=[*kept, *[f"p_{n}" for n in names]])

    return df.mapInArrow(run, T.StructType([*[df.schema[c] for c in kept], *[T.StructField(f"p_{n}", T.DoubleType()) for n in names]]))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_<category> of each category, toxic (boolean)."""
    p = with_probabilities(docs.select("doc_id", "text"), train(docs, labels))
    return p.withColumn("toxic", F.col("p_toxic") >= threshold)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not toxic."""
    rows = packed(docs, text=F.col("text"))
    p = with_probabilities(rows, train(docs, labels))
    return unpacked(p.filter(F.col("p_toxic") < threshold), docs.columns)
