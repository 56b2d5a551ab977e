import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from evwin.llm import phrases, repeats, suffixes

SF0001 = "/root/testdata/sf0.001"


def brute(texts, tokens, window, join):
    seqs = [tokens(t) for t in texts]
    count = Counter(join(s[i : i + window]) for s in seqs for i in range(len(s) - window + 1))
    out = []
    for s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if count[join(s[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(s), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(join([x for x, g in zip(s, gone) if not g])).hexdigest()))
    return out


def brute_bytes(texts):
    return brute(texts, lambda t: [bytes([b]) for b in (t or "").encode()], 200, b"".join)


def brute_words(texts):
    return [(n, g, h) for n, g, _, h in brute(texts, lambda t: [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")], 35, b" ".join)]


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 9)))
    text = lambda n: "".join(word() + rng.choice([" ", " ", "\n", "  ", " "]) for _ in range(n))
    shared = [text(n) for n in (20, 36, 45, 60, 150, 400)]
    out = [None, "", " ", "x" * 150, "x" * 450, "ab" * 300, "w " * 80, text(1), shared[5], shared[5], shared[5]]
    for _ in range(25):
        parts = [rng.choice(shared) if rng.random() < 0.5 else text(rng.randrange(1, 90)) for _ in range(rng.randrange(1, 6))]
        out.append("".join(parts))
    near = list(shared[5])
    for _ in range(4):
        near[rng.randrange(len(near))] = "q"
    return [*out, "".join(near), shared[4][7:], "é" + shared[3]]


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_equal_brute_force(spark, monkeypatch, hot, seed):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SHARD_CONTEXTS", 30)
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, ctx string, n int").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.dedup_bytes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_bytes(texts)
    got = {r.doc_id: tuple(r)[1:] for r in phrases.dedup_words(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_words(texts)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: tuple(r)[1:] for r in phrases.dedup_words(docs).collect()}
    assert [got[i] for i, _ in rows] == brute_words([t for _, t in rows])
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.dedup_bytes(docs).collect()}
    assert [got[i] for i, _ in rows] == brute_bytes([t for _, t in rows])


def test_shared_ids_repeated_rows_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(90))
    rows = [(1, long), (1, long), (1, "short"), (None, long), (None, None), (2, "alone " + long[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in phrases.dedup_words(docs).collect())
    assert got == [(0, 0, 0), (0, 90, 90), (1, 1, 0), (1, 90, 90), (1, 90, 90), (2, 91, 0)]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.dedup_bytes(docs).collect())
    n = len(long)
    assert got == [(0, 0, 0, 0), (0, n, n, 1), (1, 5, 0, 0), (1, n, n, 1), (1, n, n, 1), (2, n + 6, 0, 0)]
    assert suffixes.dedup_bytes(docs.limit(0)).count() == phrases.dedup_words(docs.limit(0)).count() == 0


def test_a_thousand_rows_alike_are_read_once(spark, monkeypatch):
    """Rows alike in id and text: their contexts are read from one of them, and every row's
    list of ranges is as long as that of a single copy."""
    text = " ".join(f"w{i % 97}x{i}" for i in range(300))
    docs = spark.range(1000).selectExpr("7L doc_id", f"'{text}' text").unionByName(spark.createDataFrame([(8, "other " + text)], "doc_id long, text string")).repartition(5)
    written = {}
    keep = repeats.materialize

    def kept(df, name):
        written[name] = keep(df, name)
        return written[name]
    monkeypatch.setattr(repeats, "materialize", kept)
    lists = {r.doc_id: len(r.l) for r in phrases.repeated_passages(docs).collect()}
    assert lists[7] <= lists[8] + 1
    assert written["payloads"].count() <= 5 * written["contexts"].count()
    got = phrases.dedup_words(docs).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, got)) == [(7, 300, 300, 1000), (8, 301, 300, 1)]
    got = suffixes.dedup_bytes(docs).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    n = len(text)
    assert sorted(map(tuple, got)) == [(7, n, n, 1, 1000), (8, n + 6, n, 1, 1)]


def test_merge_orders_like_one_transform():
    rng = np.random.default_rng(0)
    size = rng.integers(0, 30, 40)
    symbols = rng.integers(1, 3, size.sum()).astype(np.int32)
    half = int(size[:20].sum())
    parts = [suffixes.transform(symbols[:half], size[:20], 2, 40), suffixes.transform(symbols[half:], size[20:], 2, 40)]
    part, interval = suffixes.merge([p[1] for p in parts], [int((p[0] < 0).sum()) for p in parts], 6)
    place = np.empty(len(part), np.int64)
    for k, (order, _) in enumerate(parts):
        place[part == k] = np.where(order < 0, -1, order + k * half)
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(40), size)
    string = lambda x: tuple(symbols[x : begin[owner[x]] + size[owner[x]] : 2][:6])
    strings = [string(x) for x in place[place >= 0]]
    assert strings == sorted(strings)
    whole = [(s, i) for s, i in zip(strings, interval[place >= 0]) if len(s) == 6]
    assert len({s for s, _ in whole}) == len({i for _, i in whole}) == len(set(whole))
