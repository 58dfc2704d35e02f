"""Cleans and packs a corpus of documents in stages, each written before the next one reads it.

Every stage but the last takes and returns the columns of documents, further ones included. Rows without
text or id pass: they are neither toxic nor copies of anything, and an empty text packs as its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, neardups, packing, spans, suffixes, toxicity
from tidemark.llm.common import fold, stage, table, unused
from tidemark.llm.queries import tokenizer


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely not toxic than toxic. Learned from the labels that the query on
    toxicity learns from."""
    labels = table(spark, sf_dir, "labels").where(F.pmod(fold(), F.lit(5)) != 0)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return _without(docs, toxicity.score(rows, labels, "text_hash")[0].where("score >= 0.5"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text hash are not in ``gone``. Both sides are shuffled at any size."""
    doc, text_hash = unused(docs, "_doc", "_hash")
    gone = gone.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text_hash)).distinct()
    same = docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(text_hash))
    return docs.join(gone.hint("merge"), same, "left_anti")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document with the smallest id stays."""
    gone = neardups.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def once_each_passage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the first document that has them."""
    return spans.without(docs, suffixes.earlier_passages(docs))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, decontam.leaks(docs, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens in sequences of 2048."""
    return packing.pack(docs, tokenizer(), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("repeated_passages", once_each_passage),
    ("decontamination", no_benchmark),
    ("best_fit_packing", pack),
]

#: No SQL form: segments, sketches and tokens have none. tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
