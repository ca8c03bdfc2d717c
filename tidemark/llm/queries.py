"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    brown, decontaminate, langid, packing, pigeonhole, sharding, simhash, suffixdedup, topk, toxicity, treap,
    urlfilter, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, _table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


def fold(count: int) -> Column:
    """The row's remainder by which folds are told apart."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % count


@query
def op3_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(4) == 2, F.lit(False)))
    model = langid.train(docs, ~F.col("held_out"))
    return langid.identify(docs, model, keep=["doc_id", "held_out"])


@query
def op4_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_brown_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = brown.score(_table(spark, sf_dir, "documents"), F.coalesce(fold(7) != 2, F.lit(True)))
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


@query
def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op7_subsequence_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(3) == 1, F.lit(False)))
    machine = toxicity.train(docs, _table(spark, sf_dir, "labels"), fold(3) != 1)
    return toxicity.score(docs, machine, ["doc_id", "held_out"])


# The rules that pages are judged by
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


@query
def op8_digest_array_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixdedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    rows = whitening.whiten(vectors, model)
    values, n, trace, error = (model.values, model.n, model.trace, model.identity_error) if model else ([], 0, 1.0, 0.0)
    explained = F.array(*[F.lit(float(e / trace)) for e in values]).cast("array<double>")
    return rows.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )


@query
def op12_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op13_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pigeonhole.near_duplicates(_table(spark, sf_dir, "embeddings"))
