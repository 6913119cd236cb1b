"""The corpus pipeline: documents in, token counts and digests of the clean, distinct documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import bpe, decontam, langid, linedup, neardup
from quillon.llm._ship import ship
from quillon.llm._store import Store, sized
from quillon.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go.

    These are texts that are null or have no letter, score too low or are built of n-grams that no
    learned language has. Rows that repeat are judged alike and stay as often as they stand; a null
    doc_id, lang or source plays no part; with no labelled row to learn from, every text with a letter
    goes as unknown; an empty table stays empty.
    """
    ship(spark)
    return langid.accepted(spark, docs).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of any length go from the texts, all but their first occurrences; no document goes.

    n_chars stays that of the source text. Null texts stay null; a null source is no site; rows that
    repeat a doc_id and a text lose the same lines; an empty table stays empty.
    """
    ship(spark)
    return linedup.drop_boilerplate(spark, docs).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (links from a similarity of 0.8) stays, that of the smallest doc_id.

    Rows that repeat a doc_id stay together. Rows without a doc_id belong to no group and stay, as do
    null, empty and blank texts, which are linked with nothing. An empty table stays empty.
    """
    ship(spark)
    gone = neardup.near_duplicates(spark, docs, num=80, den=100).where("doc_id IS NOT NULL AND NOT kept").select("doc_id").distinct()
    return docs.join(sized(gone), "doc_id", "left_anti").select(*COLUMNS)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.

    Null, empty and blank texts contain nothing and stay; rows that repeat a doc_id go together; an
    empty table stays empty, and an empty benchmark takes nothing.
    """
    ship(spark)
    return decontam.clean_documents(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row that is left; a null text counts as empty, and an empty table gives no rows."""
    ship(spark)
    return bpe.encode_digests(spark, docs, tokenizer_path())


STAGES = [("language", language), ("lines", lines), ("near", near), ("benchmarks", benchmarks), ("tokens", tokens)]

#: Language identification and tokenization aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents, each written and read again; a stage's input goes when its output is written."""
    ship(spark)
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, store.keep(stage(spark, docs, sf_dir), name)
        store.drop(before)
    return docs
