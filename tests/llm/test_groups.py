"""Fingerprints, spelling variants and the prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from evwin.llm import conversations, fingerprints, spelling

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# Fingerprints

def _shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _jaccard(a, b):
    x, y = _shingles(a), _shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_likeness_estimates_the_share_of_common_shingles():
    rng, wrong = np.random.default_rng(1), defaultdict(list)
    for n in (6, 40, 400, 3000):
        for share in (0.0, 0.1, 0.3, 0.6, 1.0):
            for _ in range(8):
                a = [f"w{i}" for i in rng.integers(0, 5000, n)]
                k = int(n * share)
                b = a[: n - k] + [f"w{i}" for i in rng.integers(0, 5000, k)]
                p, q = fingerprints.fingerprints([" ".join(a), " ".join(b)])
                wrong[n].append(fingerprints.likeness(p, q) - _jaccard(" ".join(a), " ".join(b)))
    for n, errors in wrong.items():
        assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.06, n


def test_without_bias_correction_unlike_texts_would_be_alike():
    texts = [f"{i} " * 3 + " ".join(f"v{i}x{j}" for j in range(50)) for i in range(40)]
    prints = [np.frombuffer(p, np.uint8) for p in fingerprints.fingerprints(texts)]
    raw = [((a ^ b) >> 4 == 0).mean() for a, b in zip(prints, prints[1:])]
    assert 0.04 < np.mean(raw) < 0.085  # one in 16
    assert np.mean([fingerprints.likeness(a.tobytes(), b.tobytes()) for a, b in zip(prints, prints[1:])]) < 0.03


def test_densified_bins_keep_only_values_of_filled_ones():
    bins = fingerprints.minima([b"a b c d e f g", b"", b"one"])
    full = fingerprints.densify(bins)
    assert set(full[0]) == set(bins[0]) - {fingerprints._EMPTY} and (full[1] == fingerprints._EMPTY).all()
    assert len(set(full[2])) == 1


def test_very_long_texts_in_steps_of_any_size():
    rng = random.Random(2)
    text = " ".join(rng.choice(["ab", "c", "dé", "x" * 70_000]) for _ in range(60)) + " tail of it" + " v w" * 100_000
    assert len({tuple(fingerprints.fingerprints([text], limit=n)) for n in (100, 5000, 1 << 30)}) == 1
    assert fingerprints.fingerprints(["word " * 1_200_000, "word word word word word"])[0] == fingerprints.fingerprints(["word " * 5])[0]


def _fingerprint_rows(rows):
    """Expected exact columns of ``fingerprint_table`` for (doc_id, text) rows with different ids or texts."""
    rows = [(i, t or "") for i, t in rows]
    out = Counter()
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(t) // 3
        new = t[: len(t) - n] + following[:n]
        own, other, after = fingerprints.fingerprints([t, new, following])
        out[i, len(t), hashlib.sha256(new.encode()).hexdigest(), own.hex(), other.hex(), fingerprints.likeness(own, other), fingerprints.likeness(own, after)] += 1
    return out


def test_fingerprints_of_documents_in_order_of_ids(spark, docs, many_partitions):
    rows = sorted([(r.doc_id, r.text) for r in docs.collect()], reverse=True)
    got = fingerprints.fingerprint_table(docs.repartition(7))
    assert Counter(map(tuple, got.collect())) == _fingerprint_rows(rows)


def test_fingerprints_of_odd_rows(spark, many_partitions):
    schema = "doc_id int, text string, kind string, part int, rk long, salt double"
    rows = [(5, "a b c d e f"), (4, None), (3, ""), (2, "é" * 10), (1, "x " * 40_000), (0, "a b c d e f")] + [(None, "last")]
    df = spark.createDataFrame([(*r, "z", 1, 2, 3.0) for r in rows], schema)
    assert Counter(map(tuple, fingerprints.fingerprint_table(df).collect())) == _fingerprint_rows(rows)
    assert fingerprints.fingerprint_table(df.limit(0)).count() == 0
    one, = fingerprints.fingerprint_table(df.filter("doc_id = 5")).collect()
    assert one.near_next == 1.0 and one.n_chars == 11
    # 1,000 rows alike: all but the last are followed by their like
    same = spark.range(1000).select(F.lit(7).alias("doc_id"), F.lit("same text in every row of it").alias("text")).unionByName(df.filter("doc_id = 5").select("doc_id", "text"))
    got = fingerprints.fingerprint_table(same).collect()
    assert len(got) == 1001 and Counter(r.near_next == 1.0 for r in got) == {True: 999, False: 2}


# Spelling variants

def _spelling(rows, least=3):
    n = Counter()
    for doc_id, text in rows:
        for run in spelling.RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= least}
    letters = sorted({c for w in n for c in w})
    near = {w: {x for i in range(len(w) + 1) for x in ([w[:i] + w[i + 1 :]] if i < len(w) else []) + [w[:i] + c + w[i + k :] for c in letters for k in (0, 1)] if x in n and x != w} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("deep", [spelling.DEEP, 7, 5])
def test_spelling_of_documents_by_levels_and_by_places(docs, deep):
    got = [tuple(r) for r in spelling.group_variants(docs, deep=deep).collect()]
    assert len(got) == len(set(got)) and set(got) == _spelling([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", [0, 1])
def test_spelling_of_words_with_runs_of_a_letter(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÉé"[: 2 + seed * 2]) for _ in range(rng.choice([5, 5, 6, 7, 8]))) for _ in range(60)]
    words += ["z" * 50, "z" * 51, "z" * 52, "y" * 39, "y" * 40, "y" * 41, "q" * 60 + "r" + "q" * 3, "q" * 60 + "s" + "q" * 3]
    rows = [(i, " ".join(w for w in words for _ in range(rng.randrange(6)))) for i in range(3)] + [(None, None), (4, ""), (5, "Ab1cD " * 3)]
    rows = rows + rows[:1]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    for deep in (spelling.DEEP, 6):
        got = [tuple(r) for r in spelling.group_variants(df, deep=deep).collect()]
        assert len(got) == len(set(got)) and set(got) == _spelling(rows)
    assert spelling.group_variants(df.limit(0)).count() == 0
    assert spelling.group_variants(df.filter("doc_id = 4")).count() == 0


def test_spelling_counts_leave_a_task_at_a_bound(spark, docs, monkeypatch):
    want = Counter(map(tuple, spelling.words(docs).collect()))
    import pyarrow as pa
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    batch = pa.RecordBatch.from_pylist([{"doc_id": r.doc_id, "text": r.text} for r in docs.collect()])
    got, most = Counter(), 0
    for part in spelling._count([batch]):
        most = max(most, part.num_rows)
        for row in part.to_pylist():
            got[row["word"]] += row["n"]
    assert most <= 10 and Counter({(w, n): 1 for w, n in got.items() if n >= 3}) == want


def test_one_very_long_text_and_word(spark):
    text = "hello hallo hello " * 100_000 + ("w" * 3000 + " " + "w" * 1500 + "v" + "w" * 1499 + " ") * 3
    got = {r.word[:5] + str(len(r.word)) + r.word[1500:1501]: (r.n, r.n_near, r.form) for r in spelling.group_variants(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    assert got["hallo5"] == (100_000, 1, "hello") and got["hello5"] == (200_000, 1, None)
    assert got["wwwww3000w"][:2] == got["wwwww3000v"][:2] == (3, 1)


# Prefix trie

def _trie(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    seqs = {c: [x[2] for x in sorted(v)] for c, v in by.items()}
    full = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple(seqs.get(c - c % 5, [])[:h] + own[h:])
    members, leaves, saved = defaultdict(list), Counter(), Counter()
    for c, s in full.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = Counter(k[:-1] for k in members if k)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(full[c]) == len(k)).encode()).hexdigest()) for k, m in members.items())


def test_trie_of_conversations(spark, many_partitions):
    turns = spark.read.parquet(f"{SF0001}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, conversations.prefix_trie(turns).collect())) == _trie(rows)


@pytest.mark.parametrize("seed", range(4))
def test_trie_of_random_turns_over_many_partitions(spark, many_partitions, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, 0, 1, 2, 3, 4, 5]), rng.choice([None, "u", "a"]), rng.choice([None, "x", "yy", "é"])) for _ in range(400)]
    rows += [(c, t, "u", "same") for c in range(100, 180) for t in range(c % 4)] + rows[:20]
    df = spark.createDataFrame([(*r, "p", 1, b"n") for r in rows], "conv_id long, turn long, role string, text string, kind string, part int, nid binary")
    assert Counter(map(tuple, conversations.prefix_trie(df.repartition(5)).collect())) == _trie(rows)


def test_trie_of_copies_one_long_conversation_and_no_rows(spark, many_partitions):
    rows = [(c, t, "u", f"t{t}") for c in range(0, 3000, 5) for t in range(2)] + [(9000, t, "a", "deep") for t in range(3000)] + [(9005, t, "a", "deep") for t in range(2999)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert Counter(map(tuple, conversations.prefix_trie(df).collect())) == _trie_light(rows)
    assert conversations.prefix_trie(df.limit(0)).count() == 0


def _trie_light(rows):
    """As ``_trie`` for the case above, whose ids are all divisible by five, without its quadratic sums."""
    copies, out = list(range(0, 3000, 5)), Counter()
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    deep = [(2 if d < 2999 else 1) for d in range(3000)]
    gain = [(deep[d] - 1) * 4 for d in range(3000)]
    out[0, 0, None, 602, 2, 2, 599 * 4 + sum(gain), sha([])] += 1
    out[0, 1, 0, 600, 1, 1, 599 * 4, sha([])] += 1
    out[0, 2, 0, 600, 0, 1, 599 * 2, sha(copies)] += 1
    for d in range(1, 3001):
        out[9000, d, 0 if d == 1 else 9000, deep[d - 1], int(d < 3000), 1, sum(gain[d - 1 :]), sha([9005] if d == 2999 else [9000] if d == 3000 else [])] += 1
    return out
