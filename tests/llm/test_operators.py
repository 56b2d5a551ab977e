"""Operators against brute force on small inputs, with nulls, ties, repeats, odd columns."""

import math
import pickle
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from evwin.llm import benchmarks, catalog, langid, licenses, lines, neighbours, simhash, toxicity

SF0001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, h int, _row int, tid int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, None, None), (1, "", "en", "a"), (None, "x y", None, "b"), (None, "x y", None, "b"), (2, "same words here again", "en", None), (2, "same words here again", "en", "c"), (3, "w " * 9000, "fr", "a")]
    return spark.createDataFrame([(*r, None, "z", 1, 2, 3) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


# SimHash

def _fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def _components(ids_fps):
    root = {f: f for _, f in ids_fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(root)
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    low = {}
    for d, f in ids_fps:
        low[find(f)] = min([x for x in (low.get(find(f)), d) if x is not None], default=None)
    return Counter((d, f"{f:016x}", low[find(f)]) for d, f in ids_fps)


def test_simhash_documents_and_odd_rows(docs, odd):
    for df in (docs, odd):
        want = _components([(r.doc_id, _fingerprint(r.text)) for r in df.collect()])
        got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
        assert Counter(map(tuple, got)) == want
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [256, 1])
def test_links_equal_all_pairs(spark, hot):
    rng = np.random.default_rng(3)
    fps = {int(x) for x in rng.integers(0, 2**63, 40)} | {0, 2**64 - 1, 1 << 63}
    for f in list(fps):
        for _ in range(4):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    signed = sorted(x - (x >> 63 << 64) for x in fps)
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), hot=hot).collect()
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= 2}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_masks_cover_every_pair_of_bits():
    ms = simhash.masks(list(range(64)), 2)
    assert all(any(not (m >> a & 1 or m >> b & 1) for m in ms) for a in range(64) for b in range(64))


def test_one_of_each_group_stays(docs, odd):
    group = {}
    for r in simhash.near_duplicates(docs).collect():
        group[r.doc_id] = r.component_id
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))
    assert simhash.keep_one(odd).columns == odd.columns
    assert simhash.keep_one(odd).count() == len({v[2] or -1 for v in _components([(r.doc_id, _fingerprint(r.text)) for r in odd.collect()])})


def test_text_ids_and_rows_alike(spark):
    rows = [("b", "some words of one text"), ("a", "some words of one text"), ("a", "some words of one text"), (None, "some words of one text"), ("0", None), (None, None), ("c", "quite another text here")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert sorted(tuple(r) for r in simhash.keep_one(df).collect()) == [("0", None), ("a", rows[0][1]), ("c", rows[-1][1])]
    only = df.filter("doc_id is null")
    assert Counter(map(tuple, simhash.keep_one(only).collect())) == Counter([(None, None), (None, rows[0][1])])


# Line dedup

def test_lines_by_distinct_sites(spark, odd):
    rows = [(i, f"own {i}\n  menu \nend {i % 2}\n", f"s{i % 12}") for i in range(40)] + [(99, None, "s1"), (100, "menu", None), (101, "\n\n", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert got[0].n_removed == 0 and got[0].kept == rows[0][1]
    assert all(got[i].kept == f"own {i}\nend {i % 2}\n" for i in range(1, 40))  # six sites each have "end"
    assert got[99].kept is None and got[99].n_lines == 0 and got[101].n_removed == 0
    left = {r.doc_id: r.text for r in lines.clean(df).collect()}
    assert 100 not in left and 101 in left and 99 in left
    for n in (11, 12, 13):
        assert (got[1].n_removed == 1) and (lines.boilerplate(df, min_sites=n).count() == (1 if n <= 12 else 0))
    assert lines.clean(odd).count() == 7 and lines.clean(odd.limit(0)).count() == 0


# License scan

def _brute_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(i, label) for p, label in licenses.BASE for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(ws), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_lines_of_very_long_texts_in_proportional_time(spark):
    """Some 5 MB a text; twice the lines may take twice the time, not four times."""
    import time
    took = []
    for n in (60_000, 240_000):
        every = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("a line of some words "), (i % 5000).cast("string")))
        df = spark.range(12).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source"), F.array_join(every, "\n").alias("text"))
        begun = time.perf_counter()
        got = lines.dedup_lines(df).select("doc_id", "n_lines", "n_removed").collect()
        took.append(time.perf_counter() - begun)
        assert sorted((r.n_lines, r.n_removed) for r in got) == [(n, n - 5000)] + [(n, n)] * 11
    assert took[1] < 8 * took[0] + 5


def test_license_base_and_spans(spark, odd):
    texts = [None, "", "Under the MIT license. cc BY-nc cc by nc", "CC by  nc", "cc by ncx", "Kelvin under the mit licensE", "apache license, version 2.0 Apache License version 2", "élan under the mit license", "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and associated documentation files.", "all rights reserved", "under the mit"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, label int")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:6] == _brute_base(t), t
        assert 0 <= got[i].score <= 1 and set(filter(None, got[i].base_labels.split(","))) <= set(got[i].labels.split(","))
    assert got[8].labels == "mit" and got[8].n_base == 0 and got[9].labels == "all-rights-reserved"
    assert Counter(r.doc_id for r in licenses.scan(odd).collect()) == Counter(r.doc_id for r in odd.collect())
    assert licenses.scan(odd.limit(0)).count() == 0


# Nearest neighbours

def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 150)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6)) * rng.uniform(0.1, 3, (600, 1))
    x[100:180] = x[100]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(600, None), (620, []), (640, [0.0] * 6), (660, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (680, [float("nan")] * 6), (700, [float("inf")] * 6), (None, [1.0] * 6), (720, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search_table(df, factor=1.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 20))
    for q, found in got.items():
        score = np.einsum("ij,ij->i", np.broadcast_to(x[q], x.shape), x)
        want = sorted((i for i in range(600) if i != q), key=lambda i: (-score[i], i))[:20]
        assert [(n, i) for n, i, _ in sorted(found)] == list(enumerate(want, 1))
        assert all(math.isclose(s, score[i], rel_tol=1e-12) for _, i, s in found)
    assert neighbours.search_table(df.limit(0)).count() == 0


def test_a_thousand_vectors_alike(spark):
    """As candidates they are found as often as they stand, as a query they ask once."""
    x = [[float(i % 7 + 1), float(i % 5)] for i in range(60)]
    rows = [(i, v) for i, v in enumerate(x)] + [(40, x[40])] * 1000 + [(61, [9.0, 9.0])] * 3
    found = {}
    for r in neighbours.search_table(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert sorted(found) == [0, 20, 40]
    for q, got in found.items():
        every = [(-(x[q][0] * v[0] + x[q][1] * v[1]), i) for i, v in rows if i != q]
        assert sorted(got) == [(n, i) for n, (_, i) in enumerate(sorted(every)[:20], 1)]


def test_recall_of_the_production_factor(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    exact, found = ({(r.query_id, r.vec_id) for r in neighbours.search_table(df, factor=f).collect()} for f in (1.0, neighbours.FACTOR))
    assert len(exact & found) / len(exact) >= 0.9


@pytest.mark.parametrize("norms", ["outlier", "huge", "log-normal"])
def test_recall_whatever_the_norms(spark, norms):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"outlier": np.where(np.arange(3000) == 17, 3.0, 1.0), "huge": np.where(np.arange(3000) == 17, 1e9, 1.0), "log-normal": rng.lognormal(0, 0.35, 3000)}[norms][:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {(r.query_id, r.vec_id) for r in neighbours.search_table(df).collect()}
    score = x[::20] @ x.T
    score[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    want = {(20 * q, int(i)) for q, row in enumerate(score) for i in np.argsort(-row)[:20]}
    assert len(found) == len(want) and len(want & found) / len(want) >= 0.9


# Benchmark decontamination

def test_retrieval_equals_scoring_everything(docs, spark):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    index = pickle.loads(benchmarks.indexes(items).first()["index"])
    weight = {}
    for t, term in enumerate(index.terms.tolist()):
        for j in range(index.begin[t], index.begin[t + 1]):
            weight.setdefault(int(index.entry[j]), {})[term] = index.weight[j]
    n = 0
    for r in docs.collect():
        words = benchmarks.text_hashes(r.text)
        want = {}
        for a in range(0, max(len(words), 1), 64):
            have = set(words[a : a + 128].tolist())
            for e, ws in weight.items():
                score = sum(w for t, w in ws.items() if t in have)
                if score >= 0.6 - 1e-9:
                    want[(a, e)] = score
        _, first, entry, score = index.retrieve(words, np.array([0, len(words)]))
        got = dict(zip(zip(first.tolist(), entry.tolist()), score))
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in got)
        n += len(got)
    assert n


def test_contaminated_documents(spark, odd, monkeypatch):
    item = "The quick brown fox jumps over the lazy dog near the old river bank. What did the fox jump over that day? It jumped over one very lazy old dog."
    rows = [(1, "intro words " * 40 + item.upper() + " tail" * 90), (2, item.rsplit("?", 1)[0]), (3, item.split(".")[0] * 3), (4, None), (5, "nothing to see"), (6, item), (6, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, "zebra giraffe lion tiger elephant hippo rhino crocodile"), (7, item)], "item_id long, text string")
    for most, n in ((benchmarks.SLICE_ENTRIES, 1), (3, 2), (1, 3)):
        monkeypatch.setattr(benchmarks, "SLICE_ENTRIES", most)
        assert benchmarks.indexes(items).count() >= n
        got = Counter((r.doc_id, r.contaminated, tuple(sorted(set(r.item_ids)))) for r in benchmarks.contamination(docs, items).collect())
        assert got == Counter([(1, True, (7,)), (2, False, ()), (3, False, ()), (4, False, ()), (5, False, ()), (6, True, (7,)), (6, True, (7,))])
        assert sorted(r.doc_id for r in benchmarks.keep_clean(docs, items).collect()) == [2, 3, 4, 5]
    assert benchmarks.contamination(odd, items.limit(0)).filter("contaminated").count() == 0
    assert benchmarks.keep_clean(odd, items).columns == odd.columns and benchmarks.contamination(odd.limit(0), items).count() == 0


def test_many_slices_find_what_one_finds(spark, docs, monkeypatch):
    """Null, negative and repeated item ids, a document of 5 MB, a thousand rows alike."""
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet").select("item_id", "text")
    text = items.first()["text"]
    items = items.unionByName(spark.createDataFrame([(-1, "minus one " + text), (None, "null id " + text), (None, "null id " + text), (-1, None)], items.schema))
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-5, "filler words here " * 300_000 + "null id " + text)] + [(-6, "minus one " + text)] * 1000, "doc_id long, text string"))
    whole = Counter((r.doc_id, r.n_passages, tuple(r.item_ids), round(r.score, 9)) for r in benchmarks.contamination(rows, items).collect())
    left = Counter(r.doc_id for r in benchmarks.keep_clean(rows, items).collect())
    assert {-5, -6} & set(left) == set() and sum(whole.values()) == rows.count()
    of = {k[0]: k[2] for k in whole}
    assert None in of[-5] and of[-5].count(None) == 1 and -1 in of[-6] and sum(n for k, n in whole.items() if k[0] == -6) == 1000
    monkeypatch.setattr(benchmarks, "SLICE_ENTRIES", 60)
    assert benchmarks.indexes(items).count() > 3
    assert Counter((r.doc_id, r.n_passages, tuple(r.item_ids), round(r.score, 9)) for r in benchmarks.contamination(rows, items).collect()) == whole
    assert Counter(r.doc_id for r in benchmarks.keep_clean(rows, items).collect()) == left


def test_near_copies_of_items_with_short_answers(spark):
    question = "In which of the old harbour towns along the northern coast did the three merchants finally meet again after their long and weary voyage across the cold grey sea in winter?"
    docs, items, wanted = [], [], {}
    for n, answer in enumerate(["Bergen.", "It was Bergen.", "They met in the town of Bergen."]):
        item = f"{question} {answer}"
        words = item.split()
        items.append((n, item))
        for text in (item, item.replace("Bergen", "Narvik"), " ".join(words[:-1]), item.replace("northern", "southern"), " ".join(words[: len(words) // 2])):
            docs.append((len(docs), "some words before " * 10 + text + " and some after" * 10))
            whole, there = (set(zip(*[x[i:] for i in range(5)])) for x in (re.findall(r"\w+", item.lower()), re.findall(r"\w+", text.lower())))
            if len(whole & there) / len(whole) >= 0.8:
                wanted.setdefault(docs[-1][0], set()).add(n)
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: set(r.item_ids) for r in benchmarks.contamination(docs, items).collect()}
    assert len(wanted) >= 9 and all(found <= got[d] for d, found in wanted.items())
    assert not any(got[d] for d in (4, 9, 14))


# Language

def test_kneser_ney_is_a_distribution(docs):
    model = langid.train(docs)
    grams = sorted({g for r in docs.limit(3).collect() for g in r.text.lower().split()})[:3]
    p1 = np.exp(model.grams[0][1].astype(float)).sum(axis=0)
    unseen = np.exp(model.contexts[0][1].astype(float) + model.floor).ravel()
    assert np.allclose(p1 + unseen, 1, atol=1e-3) and grams  # all signs, and the one that none has


def _kneser_ney(words):
    """p(sign after context) and the 5-grams of one language's words."""
    levels = [Counter(g for w, n in words.items() for t in ["\x02" * 4 + w + "\x03"] for i in range(len(t) - 4) for g in [t[i : i + 5]] * n)]
    for _ in range(4):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    ones, twos = ([sum(n == k for n in c.values()) for c in levels] for k in (1, 2))
    discount = [min(max(a / max(a + 2 * b, 1), 0.1), 0.95) for a, b in zip(ones, twos)]
    total, kinds = ([Counter() for _ in levels] for _ in range(2))
    for k, c in enumerate(levels):
        for g, n in c.items():
            total[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1

    def p(gram):
        if not gram:
            return 1 / (len(levels[0]) + 1)
        k = len(gram) - 1
        t = total[k][gram[:-1]]
        return (max(levels[k][gram] - discount[k], 0) + discount[k] * kinds[k][gram[:-1]] * p(gram[1:])) / t if t else p(gram[1:])

    return p, levels


def test_rare_grams_of_a_large_corpus_count(spark):
    rng = np.random.default_rng(3)
    rare = ["".join(rng.choice(list("abcdefghijk"), 7)) for _ in range(60)]
    text = "abcdefgh " * 200_000 + " ".join(rare) + " " + " ".join(rare[:9])
    assert len(text) > 2**20
    model = langid.train(spark.createDataFrame([(text, "en")], "text string, lang string"))
    p, levels = _kneser_ney(Counter(text.split()))
    assert [len(t[0]) for t in model.grams] == [len(c) for c in levels]
    for word in [*rare[:12], "abcdefgh", "kkkkz", "hgfedcba"]:
        padded = "\x02" * 4 + word + "\x03"
        want = -sum(math.log(p(padded[i : i + 5])) for i in range(len(word) + 1)) / (len(word) + 1)
        got, _ = model.entropy(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)]))
        assert math.isclose(got[0, 0], want, rel_tol=1e-5), word


def test_calibration_takes_different_unseen_texts(spark, docs, monkeypatch):
    monkeypatch.setattr(langid, "CALIBRATION_TEXTS", 8)
    named = docs.select("text", "lang")
    hashed = named.select(F.xxhash64("text").alias("h"), "lang", "text").filter(F.pmod("h", F.lit(langid.SAMPLE_OF)) == 0)
    first = hashed.orderBy("h").first()
    copied = named.union(spark.createDataFrame([(first.text, first.lang)] * 1000 + [(first.text, "zz"), (None, "en"), ("", "en"), ("x", None)], named.schema))
    langs = {}
    for r in hashed.collect():
        langs[r.h] = min(r.lang, langs.get(r.h, r.lang))
    want = dict(sorted(langs.items())[:8])
    assert langid.calibration(named) == want and len(want) == 8
    got = langid.calibration(copied)  # "zz" would lose its only text, which is counted then
    assert got == {h: x for h, x in want.items() if h != first.h}
    model = langid.train(copied)
    assert model.limit < np.inf and "zz" in model.langs
    counted = []
    monkeypatch.setattr(langid, "build", lambda counts: counted.append(counts))
    langid.train(named)
    grams = lambda df: {(r.lang, r.gram): r.n for r in df.collect()}
    assert grams(counted[0]) == grams(langid.gram_counts(named.filter(~F.xxhash64("text").isin([*want]))))


def test_rejection_of_unseen_and_foreign_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out()).select("text", "lang"))
    rows = langid.predict(docs.filter(langid.held_out()).select("doc_id", "lang", "text"), model).filter("lang_pred <> 'und'").collect()
    share = sum(r.rejected for r in rows) / len(rows)
    assert (1 - langid.ACCEPTED) / 2.5 <= share <= (1 - langid.ACCEPTED) * 2.5, share
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    kept = [r for r in rows if not r.rejected]
    assert np.mean([r.score for r in kept]) > 0.95
    foreign = ["Съешь же ещё этих мягких французских булок, да выпей чаю", "Zażółć gęślą jaźń, wszyscy ludzie rodzą się wolni i równi", "Minden emberi lény szabadon születik és egyenlő méltósága van"]
    for r in langid.predict(spark.createDataFrame([(x,) for x in foreign], "text string").select("text", F.lit(1).alias("h")), model).collect():
        assert r.rejected and r.score < 0.5


def test_all_training_texts_are_counted_and_calibrated_on(spark, docs, monkeypatch):
    monkeypatch.setattr(langid, "calibration", lambda *a: pytest.fail("a sample"))
    named = docs.select("text", "lang").union(spark.createDataFrame([("", "en"), (None, "en"), ("x", None)], "text string, lang string"))
    models, grams = [], lambda df: {(r.lang, r.gram): r.n for r in df.collect()}
    built = langid.build
    monkeypatch.setattr(langid, "build", lambda counts: models.append((counts, built(counts))) or models[-1][1])
    model = langid.learn(named)
    assert grams(models[0][0]) == grams(langid.gram_counts(named)) and models[0][1] is model
    # by hand: each different text as the model without its half of the texts sees it
    texts = {r.h: r.text for r in named.filter("lang is not null and text rlike '[a-z]'").select(F.xxhash64("text").alias("h"), "text").collect()}
    lows = []
    for h, text in texts.items():
        data = np.frombuffer(text.encode(), np.uint8)
        lows.append(models[1 + h % 2][1].entropy(data, np.array([0, len(data)]))[0].min())
    cut = sorted(lows)[math.ceil(langid.ACCEPTED * len(lows)) - 1]
    assert len(lows) > 100 and cut <= model.limit + 1e-9 <= cut + 2 * langid.STEP
    one = langid.learn(spark.createDataFrame([("hello there", "en")], "text string, lang string"))
    assert one.langs == ["en"] and one.limit == np.inf


def test_pieces_of_the_model_change_nothing(docs, monkeypatch):
    whole = sorted(langid.identify(docs).collect())
    monkeypatch.setattr(langid, "PIECE_BYTES", 1 << 14)
    assert len(langid.train(docs).grams[-1].parts) > 3
    assert sorted(langid.identify(docs).collect()) == whole


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd):
    got = langid.identify(odd).collect()
    assert len(got) == 7 and {r.lang_pred for r in got if r.score == 0} == {"und"}
    none = langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"} and langid.identify(odd.limit(0)).count() == 0


# Toxicity

def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.xxhash64("doc_id") % 2 == 0
    p = toxicity.with_probabilities(docs.select("doc_id", "text"), toxicity.train(docs, labels.filter(half)))
    rows = p.join(labels.filter(~half), "doc_id").collect()
    toxic, rest = ([r for r in rows if r.toxic == x] for x in (1, 0))
    assert sum(r.p_toxic >= 0.5 for r in toxic) / len(toxic) > 0.85
    assert sum(r.p_toxic < 0.5 for r in rest) / len(rest) > 0.98


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(0)
    words = [toxicity._hash(w) for w in ("idiot", "scum", "a", "b", "c", "d")]
    y = rng.integers(0, 2, 300)
    feats = [np.unique(np.array([words[rng.integers(0, 2)]] * t + [words[2 + rng.integers(0, 4)]], np.uint32)) for t in y.tolist()]
    chain = toxicity.fit(feats, [np.ones(len(f)) for f in feats], y)
    assert chain.names == ["insult", "contempt", "toxic"] and [len(m.chained) for m in chain.models] == [0, 1, 2]
    data = b"you idiot" + b"c d" + b"SCUM"
    p = chain(np.frombuffer(data, np.uint8), np.array([0, 9, 12, 16]))
    assert p[0, 0] > 0.5 > p[1, 0] and p[2, 1] > 0.5 and p[0, 2] > 0.5 > p[1, 2]


def test_toxicity_sample_skips_only_what_does_not_fit(spark):
    ids = [r.id for r in spark.range(40).orderBy(F.xxhash64("id")).collect()]
    toxic = {i: n % 2 for n, i in enumerate(ids)}
    docs = spark.createDataFrame([(i, ("bad " if toxic[i] else "good ") * (5000 if i in ids[:2] else 4)) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()] + [(i, 1, i % 2) for i in range(100, 400)], "doc_id long, quality int, toxic int")
    chosen = toxicity.sample(docs, labels, {0: 19, 1: 19}, 2000)
    assert sorted(chosen) == sorted((i, toxic[i]) for i in ids[2:])
    got = {r.doc_id: r.toxic for r in toxicity.score(docs, labels).collect()}
    assert got == {i: bool(t) for i, t in toxic.items()}
    long = toxicity.sample(docs, labels.filter(F.col("doc_id").isin(ids[:2])), {0: 19, 1: 19}, 2000)
    assert sorted(long) == sorted((i, toxic[i]) for i in ids[:2])
    absent = labels.filter(F.col("doc_id").isin([i for i in ids if toxic[i]]) | (F.col("doc_id") >= 100))
    assert toxicity.score(docs, absent).filter("toxic").count() == 0


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(2, 1, 1), (1, None, 0), (None, 1, 1), (2, 0, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.score(odd, labels).count() == 7 and toxicity.score(odd.limit(0), labels).count() == 0
    assert toxicity.score(odd, labels.limit(0)).filter("toxic").count() == 0
    assert toxicity.keep_clean(odd, labels.limit(0)).columns == odd.columns


# Pipeline

def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF0001).collect()}
    labels, items = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("labels", "benchmark"))
    left = {r.doc_id for r in toxicity.score(docs, labels).collect() if not r.toxic}
    cut = {r.doc_id: r.kept for r in lines.dedup_lines(docs.filter(F.col("doc_id").isin(left))).collect() if not r.n_removed or r.kept.strip()}
    groups = _components([(d, _fingerprint(t)) for d, t in cut.items()])
    kept = {g[2] for g in groups}
    dirty = {r.doc_id for r in benchmarks.contamination(spark.createDataFrame([(d, cut[d]) for d in kept], "doc_id long, text string"), items).collect() if r.contaminated}
    assert set(out) == kept - dirty and all(r.round_trip for r in out.values())


def test_stages_take_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF0001).columns == odd.columns, name
        assert stage(spark, odd.limit(0), SF0001).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF0001).count() == 7


@pytest.mark.parametrize("key", sorted(catalog.ORACLE))
def test_queries_equal_their_sql(spark, key):
    from tools.oracle_check import compare

    (_, ok, detail, _), = list(compare(spark, SF0001, [key]))
    assert ok, detail
