"""A corpus from raw documents to token ids: drop toxic documents, keep one of each group of near-duplicates, mix the
sources, encode. Every stage takes and returns documents, but the last, which returns what the encoder gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import bpe, minhash, mixing, toxicity
from tillstream.llm.tables import kept, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents whose score is at least 0.3; rows without a doc_id are judged like all others."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates: five words, similarity 0.8 or more."""
    return minhash.deduplicated(docs, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source once, and half as many words again by weight, for a source at most its own size.

    Sources in code point order weigh 3, 1, 2 in turn. A document that the mix
    takes twice stands twice; where a budget ends within a document, its second
    row ends there.
    """
    return mixing.mix(docs, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0, least=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of the mix."""
    return bpe.encode(docs, texts=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs


#: No stage can be said in SQL; tests/llm/test_pipeline.py compares them with brute-force versions.
ORACLE_SQL = None
