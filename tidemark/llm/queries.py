"""One query per operator over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import collocations, decontam, langid, licences, neardups, packing, personal, quality, substrings, suffixes, tokenfiles, toxicity, whitening
from tidemark.llm.common import fold, place, table
from tidemark.llm.oracles import ORACLES as ORACLES

#: Vocabulary of the tokenizer file, with its two special tokens.
VOCABULARY = 49_408


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(fold(), F.lit(4)) == 2, F.lit(False)).alias("held_out")
    network = langid.learn(docs.where(~held_out))
    return langid.predict(docs, network, held_out)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.passages(table(spark, sf_dir, "documents"), size=50).drop("text_hash")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark, "tokens")
    tokenfiles.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer(), VOCABULARY, end_id=2)
    return tokenfiles.read_digest(spark, path)


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), end_id=0, capacity=2048)


def op6_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.dedup(table(spark, sf_dir, "documents"), size=13)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardups.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_rare_token_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.notices(table(spark, sf_dir, "documents")).drop("notices")


def op10_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored, _ = toxicity.score(docs, labels.where(F.pmod(fold(), F.lit(5)) != 0))
    held_out = F.coalesce(F.pmod(fold(), F.lit(5)) == 0, F.lit(False)).alias("held_out")
    n_passages = F.size("passages").alias("n_passages")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), n_passages)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = personal.spans(table(spark, sf_dir, "documents"), "doc_id")
    return personal.digest(rows)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_cnn_language,
        op2_suffix_array_dedup,
        op3_token_files,
        op4_simhash_decontamination,
        op5_best_fit_packing,
        op6_risk_controlled_quality,
        op7_super_kmer_dedup,
        op8_setsketch_near_dedup,
        op9_rare_token_licences,
        op10_segment_toxicity,
        op11_embedding_whitening,
        op12_personal_data,
        op13_collocations,
    )
}
