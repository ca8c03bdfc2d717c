"""The corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet to the shared folder and
gives the read table to the next stage. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, packing, simhash, suffixdedup
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.staging import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go: those without a letter, and those that fit no learned language. Without
    any labelled document nothing is learned, and every document with a letter stays."""
    model = langid.train(docs, F.lit(True))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(COLUMNS)
    return langid.identify(docs, model, keep=COLUMNS).where("fits").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component stays. Rows of one id are one document; rows without an id stay."""
    near = simhash.near_duplicates(docs.where("doc_id is not null"))
    lost = near.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(lost, "doc_id", "left_anti").select(COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that a smaller id has are cut out of the text; every document stays."""
    cut = suffixdedup.remove_repeats(docs.select(COLUMNS), keep_text=True)
    return cut.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.mark(docs.select(COLUMNS), benchmark).where(F.size("leaks") == 0).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot express a fitted model or a tokenizer; tests compare each stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
