"""Spelling variants: words one edit apart, found by a frontier that walks a trie.

The trie is an edge table (depth, node, letter, child), a node being the code points
read so far.  A frontier state is (word, position, node, edits): the word's first
``position`` code points are read and lead to ``node`` after that many edits.  States
without an edit are the trie's own nodes and need no rows; words that begin alike share
one state (``own`` is what they have read).  Level by level a state goes on by joins with
the edge table: both sides read the same letter.  New one-edit states come from sibling
edges (a replaced letter) and single edges (an inserted one; a letter put into a run of
its like counts at the run's end, so each pair of nodes comes once).  A state whose two
nodes both end words is a pair of neighbours.  Each level is written, so a lost executor
costs one level.

Words of ``DEEP`` code points and more don't walk level by level: each gives one row a
place, with hashes of what stands before and after it; equal rows are joined and the words
compared.  That is exact too, and grows with the letters of these words.

Null text: none.  Empty texts and very long ones: read whole, one at a time; counts leave a
task when they reach a bound, so memory does not grow with a text's number of words.  Null
id: the empty string before the colon.  Repeated rows each count.  Ties between forms:
larger count, then smaller word in code-point order.  Empty table, or no word often enough:
empty result.  Columns beside the id and the text are not read, so no name can clash.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evwin.llm.common import RangeHash
from evwin.session import ensure_checkpoint_dir, materialize

#: Fixed by the contract.
MIN_LENGTH, MIN_COUNT, DELETED = 5, 3, 97
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words with as many code points go by hashed places instead of trie levels.
DEEP = 40
#: A task hands its counts on when it holds so many words, or letters of words.
HELD_WORDS, HELD_LETTERS = 1 << 17, 1 << 22


def variants(doc_id, text: str) -> Counter:
    """Counts of a text's words, after the deletion that the contract asks for."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for word, n in Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():  # bytes: ASCII only
        h = zlib.crc32(word.encode(), start)
        if h % DELETED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def _count(batches):
    held, letters = Counter(), 0

    def out():
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            for word, n in variants(doc_id.as_py(), text.as_py() or "").items():
                if len(word) >= MIN_LENGTH:
                    letters += 0 if word in held else len(word)
                    held[word] += n
                    if len(held) >= HELD_WORDS or letters >= HELD_LETTERS:
                        yield out()
                        held, letters = Counter(), 0
    if held:
        yield out()


def words(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """word, n: words of the whole corpus with ``least`` occurrences or more."""
    parts = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/evwin/{name}-{uuid.uuid4().hex[:12]}"


def _edges(vocabulary: DataFrame) -> DataFrame:
    """The trie of the words: depth of node, node, letter, child, and whether node and
    child are words.  Written by depth; a node has an edge a letter, so at most 90."""
    spark = vocabulary.sparkSession
    places = vocabulary.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    steps = places.select((F.col("i") - 1).alias("depth"), F.expr("left(word, i - 1)").alias("node"), F.expr("substring(word, i, 1)").alias("letter"),
                          F.expr("left(word, i)").alias("child"), (F.col("i") == F.length("word")).alias("ends"))
    edges = steps.groupBy("depth", "node", "letter", "child").agg(F.max("ends").alias("child_ends"))
    starts = vocabulary.select(F.col("word").alias("node"), F.lit(True).alias("node_ends"))
    path = _folder(spark, "trie")
    (edges.join(starts, "node", "left").withColumn("node_ends", F.coalesce("node_ends", F.lit(False)))
     .repartition("depth", "node").write.partitionBy("depth").parquet(path))
    return spark.read.schema("node string, letter string, child string, child_ends boolean, node_ends boolean, depth int").parquet(path)


#: A state: what its word has read, its node, by how many letters the node is deeper, the
#: letter that the word must not read next, and whether both are words.
_STATE = "own string, node string, gap int, skip string, both_end boolean"


def _walk(edges: DataFrame, levels: int) -> DataFrame:
    """Pairs of words one edit apart, found level by level."""
    spark, path = edges.sparkSession, _folder(edges.sparkSession, "frontier")
    states = spark.createDataFrame([], _STATE)
    inserted = edges.select("depth", F.col("node").alias("own"), F.col("child").alias("node"), F.lit(1).alias("gap"), F.col("letter").alias("skip"), (F.col("node_ends") & F.col("child_ends")).alias("both_end"))
    none = F.lit(None).cast("string").alias("skip")
    for depth in range(levels):
        here, below = edges.filter(F.col("depth") == depth), edges.filter(F.col("depth") == depth + 1)
        own = here.select(F.col("node").alias("own"), "letter", F.col("child").alias("own_next"), F.col("child_ends").alias("own_ends"))
        read = states.unionByName(inserted.filter(F.col("depth") == depth).drop("depth")).join(own, "own").filter("skip is null or skip <> letter")
        reach = here.withColumn("gap", F.lit(0)).unionByName(below.withColumn("gap", F.lit(1))).select("gap", "node", "letter", "child", "child_ends")
        moved = read.select("own_next", "own_ends", "node", "gap", "letter").join(reach, ["gap", "node", "letter"])
        moved = moved.select(F.col("own_next").alias("own"), F.col("child").alias("node"), "gap", none, (F.col("own_ends") & F.col("child_ends")).alias("both_end"))
        a, b = here.alias("a"), here.alias("b")
        replaced = a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.letter") < F.col("b.letter")))
        replaced = replaced.select(F.col("a.child").alias("own"), F.col("b.child").alias("node"), F.lit(0).alias("gap"), none, (F.col("a.child_ends") & F.col("b.child_ends")).alias("both_end"))
        moved.unionByName(replaced).write.parquet(f"{path}/level={depth}")
        states = spark.read.schema(_STATE).parquet(f"{path}/level={depth}")
    pair = [F.col("own").alias("a"), F.col("node").alias("b")]
    walked = spark.read.schema(_STATE).parquet(path)
    return walked.filter("both_end").select(*pair).unionByName(inserted.filter("both_end").select(*pair))


def _places(batches):
    """For each long word and place: (what the row stands for, place, hashes before and
    after it).  ``swap``: one letter left out, the length kept in ``size``; ``cut``: one
    letter left out, at the end of a run of its like; ``gap``: nothing left out."""
    for batch in batches:
        for word in batch.column("word"):
            text = word.as_py()
            letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
            n = len(letters)
            hashes = RangeHash(letters, 2)
            at = np.arange(n + 1)
            before, after = hashes(np.zeros(n + 1, np.int64), at), hashes(at, np.full(n + 1, n))
            last = np.flatnonzero(np.r_[letters[1:] != letters[:-1], True])
            for kind, i, left, right, size in (("swap", at[:n], before[:n], after[1:], n), ("cut", last, before[last], after[last + 1], n - 1), ("gap", at, before, after, n)):
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array([text] * len(i), pa.string()), "kind": pa.array([kind] * len(i)), "place": pa.array(i, pa.int64()),
                    "before": pa.array(left.view(np.int64)), "after": pa.array(right.view(np.int64)), "size": pa.array([size] * len(i), pa.int64())})


def _long_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs of long words one edit apart.  Equal ``swap`` rows differ in one letter, so a
    key has at most one word a letter, and a ``cut`` row meets one ``gap`` row."""
    rows = materialize(vocabulary.select("word").mapInArrow(_places, "word string, kind string, place long, before long, after long, size long"), "places")
    on = ["place", "before", "after", "size"]
    left, right = rows.withColumnRenamed("word", "a"), rows.withColumnRenamed("word", "b")
    rest = lambda c, skip: F.concat(F.expr(f"left({c}, int(place))"), F.expr(f"substring({c}, int(place) + {1 + skip})"))
    swaps = left.filter("kind = 'swap'").join(right.filter("kind = 'swap'").drop("kind"), on).filter((F.col("a") < F.col("b")) & (rest("a", 1) == rest("b", 1)))
    cuts = left.filter("kind = 'gap'").join(right.filter("kind = 'cut'").drop("kind"), on).filter(F.col("a") == rest("b", 1))
    return swaps.select("a", "b").unionByName(cuts.select("a", "b"))


def near_words(vocabulary: DataFrame, deep: int = DEEP) -> DataFrame:
    """(a, b): each pair of different words one inserted, deleted or replaced code point
    apart, once."""
    short = vocabulary.filter(F.length("word") <= deep)
    levels = short.agg(F.max(F.length("word"))).first()[0] or 0
    pairs = _long_pairs(vocabulary.filter(F.length("word") >= deep))
    if levels:
        pairs = pairs.unionByName(_walk(_edges(short), levels))
    # two words of just ``deep`` code points come both ways
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms lead.  Counts at least double along a chain, so there
    are no rings; each round doubles how far a word has looked."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = materialize(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not now.filter("moved").take(1):
            return now.select("word", "root")
        now = now.select("word", "root")


def best_form(n: Column, near_n: Column, near: Column) -> Column:
    """Aggregate: the near word of largest count, if it has twice the word's."""
    best = F.min(F.struct((-near_n).alias("order"), near.alias("word")))
    return F.when(-best["order"] >= 2 * n, F.struct(best["word"].alias("word"), (-best["order"]).alias("n")))


def group_variants(docs: DataFrame, least: int = MIN_COUNT, deep: int = DEEP) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that is frequent enough."""
    vocabulary = materialize(words(docs, least), "words")
    pairs = near_words(vocabulary, deep)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    known = both.join(vocabulary, "word").join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    per_word = known.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best_form(F.col("n"), F.col("near_n"), F.col("near")).alias("best"))
    formed = materialize(per_word.select("word", "n_near", F.col("best.word").alias("form"), F.col("best.n").alias("form_n")), "forms")
    roots = _roots(formed.filter("form is not null"))
    return vocabulary.join(formed, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
