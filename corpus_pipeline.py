"""Preparation of a training corpus: the stages of one run over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of its input (the last one returns packed pieces). ``run`` writes
each stage's result as Parquet in the shared folder and reads it again as the
next one's input.

Rows with a null in any column pass through the stages as their operators define
it; empty tables give empty results; further columns are carried along whatever
their names (inside a stage the columns go by numbers).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import table, text_hash, written
from hourcast.llm.langid import identify, train
from hourcast.llm.minhash_forest import near_duplicates
from hourcast.llm.mixing import WORD, mix_sources
from hourcast.llm.packing import pack_documents
from hourcast.llm.substring import remove_repeats

LEAST_LANGUAGE_SCORE = 0.2


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` under column names that can't clash with an operator's."""
    names = [f"_column_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names


def _at(docs: DataFrame, name: str) -> str:
    return f"_column_{docs.columns.index(name)}"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told. Goes: null texts, texts without
    a letter, and texts in which no language reaches LEAST_LANGUAGE_SCORE. The
    model is counted from the documents' own ``lang``; if none teaches, all
    texts are undetermined and go."""
    plain, names = _numbered(docs)
    model = train(docs.select("text", "lang"))
    found = identify(plain.withColumn("text", F.col(_at(docs, "text"))), model, keep=tuple(names))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*names).toDF(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near duplicates (five
    words, similarity 0.8). Rows of one id and text are one document and stay
    together; rows without an id stay."""
    plain, names = _numbered(docs)
    kept = near_duplicates(docs.select("doc_id", "text"), percent=80).where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")).distinct()
    same = F.col(_at(docs, "doc_id")).eqNullSafe(F.col("_kept_id")) & (text_hash(F.col(_at(docs, "text"))) == F.col("_kept_hash"))
    return plain.join(kept, same, "left_semi").select(*names).toDF(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences that repeat earlier runs; n_chars follows
    the text. Documents of which nothing but white space is left go."""
    plain, names = _numbered(docs)
    cleaned = remove_repeats(plain.withColumn("doc_id", F.col(_at(docs, "doc_id"))).withColumn("text", F.col(_at(docs, "text"))), keep=tuple(n for n in names if n != _at(docs, "text")))
    cleaned = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    return _retold(cleaned.withColumn(_at(docs, "text"), F.col("text")), docs, names)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document is repeated for every whole epoch that takes
    it, cut to the words that the last epoch takes of it, and goes if none does.
    Each row, also one of several of one id and text, has its own exact part."""
    plain, names = _numbered(docs)
    named = plain.select(*names, *(F.col(_at(docs, n)).alias(n) for n in ("doc_id", "text", "source")))
    rows = mix_sources(named, columns=tuple(names)).where(F.col("taken") > 0).withColumnsRenamed({"taken": "_taken", "size": "_size"})
    text = F.col(_at(docs, "text"))
    epochs, rest = F.floor(F.col("_taken") / F.col("_size")).cast("int"), (F.col("_taken") % F.col("_size")).cast("int")
    rows = rows.withColumn("_rest", rest).withColumn("_epoch", F.explode(F.sequence(F.lit(1), epochs + F.when(rest > 0, 1).otherwise(0))))
    last = (F.col("_rest") > 0) & (F.col("_epoch") == F.floor(F.col("_taken") / F.col("_size")) + 1)
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("_rest")), " ")
    return _retold(rows.withColumn(_at(docs, "text"), F.when(last, part).otherwise(text)), docs, names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2,048 tokens."""
    return pack_documents(docs)


def _retold(rows: DataFrame, docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``docs`` again, n_chars (where there is one) from the text."""
    if "n_chars" in docs.columns:
        at = _at(docs, "n_chars")
        rows = rows.withColumn(at, F.length(_at(docs, "text")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*names).toDF(*docs.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicate", near_duplicate),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed", packed),
]

# SQL can't express the operators; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
