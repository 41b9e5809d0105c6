"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import quality, toxicity
from hourcast.llm.ann_forest import search
from hourcast.llm.bestfit import pack_best_fit
from hourcast.llm.common import crc_fold, table
from hourcast.llm.ctph import fingerprints
from hourcast.llm.langid import identify, train
from hourcast.llm.minhash_forest import near_duplicates
from hourcast.llm.mixing import mix_sources
from hourcast.llm.oracles import MIX_SQL
from hourcast.llm.packing import pack_documents
from hourcast.llm.spelling import spelling_variants
from hourcast.llm.substring import remove_repeats
from hourcast.llm.token_fst import count_tokens
from hourcast.llm.whitening import whiten


def op1_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(*toxicity.training_sample(docs, toxicity.teaching(labels), "toxic"))
    scored = toxicity.score_toxicity(docs, model)
    held_out, predicted = toxicity.held_out(F.col("doc_id")), F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "threshold_language")


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op3_quality_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = toxicity.training_sample(docs, toxicity.teaching(labels), "quality")
    scored = quality.score_quality(docs, quality.fit(*sample, quality.word_vectors(docs)))
    held_out, predicted = toxicity.held_out(F.col("doc_id")), F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op4_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_token_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op9_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_fold(F.col("doc_id"), 4)
    found = identify(docs.select("doc_id", "text"), train(docs.where(fold != 2)))
    return found.select("doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "spans")


def op10_sentence_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity_cnn, op2_prefix_forest, op3_quality_index, op4_piecewise_hash, op5_token_fst,
              op6_vector_packing, op7_source_mix, op8_minhash_forest, op9_language_spans, op10_sentence_runs,
              op11_embedding_whitening, op12_best_fit_packing, op13_spelling_variants)
}
ORACLE: dict[str, str] = {"op7_source_mix": MIX_SQL}
