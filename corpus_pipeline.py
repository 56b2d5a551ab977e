"""A training corpus from raw documents: toxic documents go, cross-site lines go, one
document of each group of near copies stays, documents with benchmark items go, and
what is left is encoded.  Each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evwin.llm import benchmarks, lines, sentencepiece, simhash, toxicity
from evwin.llm.common import table
from evwin.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.clean(docs)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmarks.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, round_trip."""
    return sentencepiece.encode(docs.select("doc_id", "lang", "source", "text"), sentencepiece.load())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_lines),
    ("simhash near-dedup", keep_one_of_copies),
    ("benchmark decontamination", drop_benchmark_items),
    ("sentencepiece", encode),
]

#: Trained models and tokenizers can't be put in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
