"""Benchmark decontamination: BM25 with block-max WAND, then overlap of question and answer.

Test items are cut into entries of ``ENTRY_WORDS`` words and indexed; a posting's weight is
its BM25 weight as a share of the score that the entry reaches against itself, so one
threshold holds for all.  The words of a document are cut into passages of two entry
lengths, each beginning where the one before is half over: an entry that stands in a
document stands wholly in a passage.  For each passage the terms are sorted by their
largest weight; those that can't reach the threshold together are not essential and
bring up no candidates (WAND); the blocks of entries that the others bring up are kept
if the sum of the block's largest weights reaches the threshold (block-max), and only
their postings are scored.  Every entry above the threshold is retrieved.

A retrieved item is verified around the passage by its 5-word shingles: 0.8 or more of
those of the whole item have to stand there, or 0.8 or more of those of its question and
0.8 or more of those of its answer.  The answer is the item's last sentence, the question
what stands before; an item of one sentence is all question.  A part with fewer than five
words is one shingle; the whole item decides where such a part has changed.

The index is built in slices of some ``SLICE_ENTRIES`` entries, one a task, and written;
the driver passes on one slice at a time, and each is held against all documents.  With
several slices each pass writes what it found before the next begins, so that a slice
bounds the memory of driver and tasks whatever the number of items.

Null or empty text of a document or an item: no words; an item without words is in no
document.  Null ids stay null.  Very long texts: passages are cut from whole texts, a step
of work is ``CHUNK_BYTES`` of texts or one longer text; a long item is many entries of one
slice.  Ties: every entry at or above the threshold is retrieved, there is no order to
break.  Rows of documents alike in id and text each get the same result; items alike in id
and text are one item, those alike in text only are items of their own.  No items: no
document is contaminated; no documents: no rows.  Extra columns, of any name, are kept by
``keep_clean`` and not read by ``contamination``.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evwin.llm.common import ALNUM, LOWER, RangeHash, chunks, packed, row_key, runs, spans, unpacked, word_hashes
from evwin.session import materialize, new_folder

ENTRY_WORDS = 64
SLICE_ENTRIES = 20_000
BLOCK_ENTRIES = 16
K1, B = 1.2, 0.75
#: Share of an entry's own score at which it is retrieved.
THRESHOLD = 0.6
SHINGLE, SIMILARITY = 5, 0.8
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def _hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = LOWER[data]
    start, end, of = spans(low, off, ALNUM)
    return word_hashes(low, start, end), of


def text_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return _hashes(data, np.array([0, len(data)]))[0]


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole if there are fewer."""
    n = max(len(words) - size, 0) + 1 if len(words) else 0
    at = np.arange(n)
    return RangeHash(words, 0)(at, np.minimum(at + size, len(words)))


def parts(text: str) -> tuple[np.ndarray, np.ndarray | None]:
    """Words of the question and of the answer (None: one sentence only)."""
    sentences = [w for w in (text_hashes(s) for s in _SENTENCE.split(text)) if len(w)]
    if len(sentences) < 2:
        return (sentences[0] if sentences else np.zeros(0, np.uint64)), None
    return np.concatenate(sentences[:-1]), sentences[-1]


def _overlap(part: np.ndarray | None, region: np.ndarray) -> float:
    """Share of a part's different shingles that stand in a run of words."""
    if part is None:
        return 1.0
    wanted = np.unique(shingles(part))
    return float(np.isin(wanted, shingles(region, min(SHINGLE, len(part)))).mean()) if len(region) else 0.0


@dataclass
class Index:
    """A slice of the inverted index; arrays sorted by term, then entry."""

    terms: np.ndarray  # sorted hashes of words
    begin: np.ndarray  # of each term's postings
    entry: np.ndarray
    weight: np.ndarray
    most: np.ndarray  # largest weight of each term
    block_begin: np.ndarray  # of each term's blocks
    block: np.ndarray
    block_most: np.ndarray
    block_postings: np.ndarray  # where each block's postings begin
    item_of: np.ndarray  # by entry: place among items
    items: list[tuple[int | None, np.ndarray, np.ndarray, np.ndarray | None]]  # id, all words, question, answer

    @classmethod
    def build(cls, items: list[tuple[int | None, str]], idf: dict[int, float], mean: float) -> Index:
        rows, item_of, kept = [], [], []
        for item_id, text in items:
            question, answer = parts(text)
            words = text_hashes(text)
            for lo in range(0, len(words), ENTRY_WORDS):
                term, tf = np.unique(words[lo : lo + ENTRY_WORDS], return_counts=True)
                w = np.array([idf[t] for t in term.tolist()]) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * tf.sum() / mean))
                rows.append((term, np.full(len(term), len(item_of)), w / w.sum()))
                item_of.append(len(kept))
            kept.append((item_id, words, question, answer))
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))
        term, entry, weight = (np.concatenate(x) for x in zip(empty, *rows))
        order = np.lexsort((entry, term))
        term, entry, weight = term[order], entry[order], weight[order]
        terms, code = np.unique(term, return_inverse=True)
        most = np.zeros(len(terms))
        np.maximum.at(most, code, weight)
        key, at = np.unique(code * (len(item_of) // BLOCK_ENTRIES + 1) + entry // BLOCK_ENTRIES, return_inverse=True)
        block_most = np.zeros(len(key))
        np.maximum.at(block_most, at, weight)
        owner, block = np.divmod(key, len(item_of) // BLOCK_ENTRIES + 1)
        every, postings = np.arange(len(terms) + 1), np.searchsorted(at, np.arange(len(key) + 1))
        return cls(terms, np.searchsorted(code, every), entry, weight, most, np.searchsorted(owner, every), block, block_most, postings, np.array(item_of, np.int64), kept)

    def retrieve(self, words: np.ndarray, of: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """text, first word of the passage (within the text), entry, score: all entries that
        reach the threshold with a passage.  ``of``: n + 1 offsets of the texts' words."""
        none = np.zeros(0, np.int64)
        if not len(self.terms) or not len(words):
            return none, none, none, np.zeros(0)
        halves = -(-np.diff(of) // ENTRY_WORDS)  # half passages of each text
        first = np.cumsum(halves) - halves
        text = np.repeat(np.arange(len(of) - 1), np.diff(of))
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == words)
        half = first[text[hit]] + (hit - of[text[hit]]) // ENTRY_WORDS
        m = np.uint64(len(self.terms))
        once = _different(half.astype(np.uint64) * m + at[hit].astype(np.uint64))
        half, term = (once // m).astype(np.int64), (once % m).astype(np.int64)
        text_of = np.repeat(np.arange(len(halves)), halves)
        back = half > first[text_of[half]]  # the passage that begins half a passage before
        pair = _different(np.concatenate([once, once[back] - m]))
        passage, term = (pair // m).astype(np.int64), (pair % m).astype(np.int64)
        # WAND: by rising weight, the terms before the sum reaches the threshold bring up nothing
        order = np.lexsort((self.most[term], passage))
        total = np.cumsum(self.most[term][order])
        begun = runs(passage)  # order keeps passages together
        total -= np.repeat(np.r_[0.0, total[begun[1:] - 1]], np.diff(np.r_[begun, len(passage)])) if len(begun) else 0.0
        essential = order[total >= threshold - 1e-9]
        blocks = int(self.block.max()) + 1
        brought = _flags(_expand(passage[essential], self.block_begin, term[essential], blocks, self.block)[0], len(text_of) * blocks)
        live = brought.reshape(-1, blocks).any(axis=1)[passage]
        # block-max: only blocks whose largest weights can reach the threshold
        key, from_ = _expand(passage[live], self.block_begin, term[live], blocks, self.block)
        brought &= np.bincount(key, weights=self.block_most[from_], minlength=len(brought)) >= threshold - 1e-9
        open_ = brought[key]
        entries = len(self.item_of)
        key, from_ = _expand(key[open_] // blocks, self.block_postings, from_[open_], entries, self.entry)
        pair, code = np.unique(key, return_inverse=True)
        score = np.bincount(code, weights=self.weight[from_], minlength=len(pair))
        good = score >= threshold - 1e-9
        passage, entry = pair[good] // entries, pair[good] % entries
        text = text_of[passage]
        return text, (passage - first[text]) * ENTRY_WORDS, entry, score[good]


def _flags(at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[at] = True
    return out


def _different(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[runs(x)]


def _expand(owner: np.ndarray, begin: np.ndarray, term: np.ndarray, width: int, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner * width + column[j], j) for each j of each term's run."""
    n = begin[term + 1] - begin[term]
    j = np.repeat(begin[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.repeat(owner, n) * width + column[j], j


def _entry_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different term of each entry of the texts; an entry and its words are
    counted on its first row."""
    for batch in batches:
        for part, data, off in chunks(batch):
            words, of = _hashes(data, off)
            for row, (a, b) in enumerate(zip(of[:-1].tolist(), of[1:].tolist())):
                for lo in range(a, b, ENTRY_WORDS):
                    entry = words[lo : min(lo + ENTRY_WORDS, b)]
                    terms = np.unique(entry).view(np.int64)
                    first = (np.arange(len(terms)) == 0).astype(np.int64)
                    slice_ = pa.array(np.full(len(terms), part.column("slice")[row].as_py()))
                    yield pa.RecordBatch.from_arrays([slice_, pa.array(terms), pa.array(first), pa.array(first * len(entry))], names=["slice", "term", "entries", "words"])


def indexes(items: DataFrame) -> DataFrame:
    """slice, index: the written slices of the index, each a pickled ``Index``; weights come
    from all items."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = F.ceil(F.length("text") / 64) + 1  # no fewer than its entries have: a word and a gap have two bytes
    slices = max(1, -(-(rows.agg(F.sum(size)).first()[0] or 0) // SLICE_ENTRIES))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)))
    listed = rows.select("slice", "text").mapInArrow(_entry_terms, "slice long, term long, entries long, words long")
    counted = materialize(listed.groupBy("slice", "term").agg(F.count("*").alias("n"), F.sum("entries").alias("entries"), F.sum("words").alias("words")), "terms")
    n, words = counted.agg(F.coalesce(F.sum("entries"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    everywhere = counted.groupBy("term").agg(F.sum("n").alias("df"))

    def build(mine: pa.Table, terms: pa.Table) -> pa.Table:
        table = sorted(zip(mine["item_id"].to_pylist(), mine["text"].to_pylist()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        idf = {t % 2**64: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in zip(terms["term"].to_pylist(), terms["df"].to_pylist())}
        return pa.table({"slice": mine["slice"][:1], "index": pa.array([pickle.dumps(Index.build(table, idf, words / max(n, 1)))], pa.binary())})

    terms = counted.select("slice", "term").join(everywhere, "term").select("slice", "term", "df")
    return materialize(rows.groupBy("slice").cogroup(terms.groupBy("slice")).applyInArrow(build, "slice long, index binary"), "index")


def _shared(stored: DataFrame) -> Iterator[Broadcast]:
    """The slices, one at a time."""
    for r in stored.select("slice").sort("slice").collect():
        yield stored.sparkSession.sparkContext.broadcast(stored.filter(F.col("slice") == r["slice"]).first()["index"])


def _passes(df: DataFrame, stored: DataFrame, kept: list[str], threshold: float, found_only: bool) -> DataFrame:
    """What each slice finds in ``df``, written slice by slice, with a column ``pass`` from 0;
    ``found_only``: no rows without findings, else the first pass has all rows."""
    folder = new_folder(df.sparkSession, "found")
    for i, shared in enumerate(_shared(stored)):
        out = _matched(df, shared, kept, threshold)
        (out.filter(F.size("found") > 0) if found_only or i else out).write.parquet(f"{folder}/pass={i}")
        shared.destroy()
    return df.sparkSession.read.parquet(folder)


def _matched(df: DataFrame, shared: Broadcast, kept: list[str], threshold: float) -> DataFrame:
    """The columns ``kept`` of ``df`` (which has text too), n_passages and found: item, score
    and overlaps of each verified item of this slice."""
    found = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))

    def run(batches):
        index = pickle.loads(shared.value)
        for batch in batches:
            for part, data, off in chunks(batch):
                words, of = _hashes(data, off)
                hits: list[dict[int, tuple]] = [{} for _ in range(part.num_rows)]
                for text, first, entry, score in zip(*(x.tolist() for x in index.retrieve(words, of, threshold))):
                    item = int(index.item_of[entry])
                    item_id, whole, question, answer = index.items[item]
                    size = len(whole)
                    region = words[max(of[text], of[text] + first - size) : min(of[text + 1], of[text] + first + 2 * ENTRY_WORDS + size)]
                    q, a = _overlap(question, region), _overlap(answer, region)
                    if q >= SIMILARITY and a >= SIMILARITY or _overlap(whole, region) >= SIMILARITY:
                        hits[text][item] = max(hits[text].get(item, (0,)), (score, q, a))
                rows = [[{"item_id": index.items[i][0], "score": min(v[0], 1.0), "question": v[1], "answer": v[2]} for i, v in sorted(h.items())] for h in hits]
                n = np.maximum(-(-np.diff(of) // ENTRY_WORDS), 0)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(n, pa.int64()), pa.array(rows, found)], names=[*kept, "n_passages", "found"])

    extra = T._parse_datatype_string("n_passages long, found array<struct<item_id:long,score:double,question:double,answer:double>>").fields
    return df.mapInArrow(run, T.StructType([*[df.schema[c] for c in kept], *extra]))


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, n_passages, contaminated, item_ids (sorted), score (the
    largest), found (item, score, overlap of question and answer)."""
    return _contamination(docs.select("doc_id", row_key().alias("rk"), "text"), items, threshold).drop("rk")


def _contamination(rows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    stored, kept = indexes(items), [c for c in rows.columns if c != "text"]
    if stored.count() <= 1:
        nothing = rows.sparkSession.sparkContext.broadcast(pickle.dumps(Index.build([], {}, 1.0)))
        out = _matched(rows, next(_shared(stored), nothing), kept, threshold)
    else:  # rows alike in id and text have the same findings in a slice: any one of them stands for all
        each = _passes(rows, stored, kept, threshold, False)
        merged = each.groupBy("doc_id", "rk").agg(F.max("n_passages").alias("n_passages"), F.sum((F.col("pass") == 0).cast("int")).cast("int").alias("copies"), F.flatten(F.collect_set("found")).alias("found"))
        out = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")
    return out.select("doc_id", "rk", "n_passages", (F.size("found") > 0).alias("contaminated"), F.array_sort(F.col("found.item_id")).alias("item_ids"), F.coalesce(F.array_max("found.score"), F.lit(0.0)).alias("score"), "found")


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without a benchmark item."""
    stored = indexes(items)
    n = stored.count()
    if n == 0:
        return docs
    if n == 1:
        left = _matched(packed(docs, text=F.col("text")), next(_shared(stored)), ["_row"], threshold)
        return unpacked(left.filter(F.size("found") == 0), docs.columns)
    digest = F.sha2("text", 256)  # equal texts have equal findings
    gone = _passes(docs.select(digest.alias("digest"), "text"), stored, ["digest"], threshold, True).select("digest").distinct()
    return unpacked(packed(docs, digest=digest).join(gone, "digest", "left_anti"), docs.columns)
