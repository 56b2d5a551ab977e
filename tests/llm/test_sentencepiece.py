import random

import numpy as np
import pytest
import sentencepiece as library

from evwin.llm import sentencepiece as own

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return own.load(), library.SentencePieceProcessor(model_file=own.MODEL)


def _encode(pieces, texts):
    raw = [t.encode() for t in texts]
    off = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
    ids, at = own.Encoder(pieces)(np.frombuffer(b"".join(raw), np.uint8), off)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_equals_the_library(model):
    pieces, sp = model
    rng = random.Random(7)
    words = ["the", "them", "antidisestablishment", "élève", "größer", "niño", "   ", "\n", "\t", "日本語", "😀", "naïve", "aaaaaaa", "12345", "http://x.org/a?b=c", "▁", "", " ", "x" * 40]
    texts = ["", " ", "  a", "a  ", " " * 50, "a" * 300, "▁▁a", "\n\n", "tab\tand\r\n", "\u0000b"]
    texts += ["".join(rng.choice(words) + rng.choice(["", " ", "  ", "\n", " " * 17]) for _ in range(rng.randrange(30))) for _ in range(200)]
    texts += ["".join(rng.choice("etaoin shrdlu") for _ in range(rng.randrange(80))) for _ in range(400)]
    for text, ids in zip(texts, _encode(pieces, texts)):
        assert ids == sp.encode(text), text
        back = own.decode_ids(pieces, np.array(ids, np.int64), np.array([0, len(ids)]))[0]
        assert back == text.replace("▁", " ") == sp.decode(ids)


def test_documents_equal_the_library(spark, model):
    pieces, sp = model
    rows = own.tokenize(spark.read.parquet(f"{SF0001}/documents.parquet")).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    back = {r.doc_id: r.decoded for r in own.decode(own.tokenize(spark.read.parquet(f"{SF0001}/documents.parquet")), pieces).collect()}
    assert back == texts
    for r in rows:
        assert list(r.ids) == sp.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_nulls_empty_repeats_and_empty_table(spark):
    schema = "doc_id long, text string, ids string, decoded int"
    rows = [(1, None, "x", 1), (1, "", "x", 2), (None, "a b", None, 3), (2, "a b", "y", None), (2, "a b", "y", None)]
    out = own.tokenize(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.round_trip) for r in out) == [(0, 2, True), (1, 0, True), (1, 0, True), (2, 2, True), (2, 2, True)]
    assert own.tokenize(spark.createDataFrame([], schema)).count() == 0


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        own.load(str(tmp_path / "none.model"))
