"""Each stage against a plain version on its own input; and the registered queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, spark_rows, sql_rows
from tests.llm import cases
from tests.llm.test_packing import check
from tests.llm.test_simhash import components, fingerprint
from tests.llm.test_suffixdedup import brute
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES
from tidemark.llm.staging import staged


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = cases.documents(spark), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, cases.SF))
        out.append((name, docs.collect(), after))
        docs = after
    return {n: (before, after) for n, before, after in out}


def test_all_stages_but_the_last_keep_the_columns(stages, spark):
    for name, (_, after) in stages.items():
        if name != "packing":
            assert after.schema.names == cases.documents(spark).schema.names
            assert [f.dataType for f in after.schema] == [f.dataType for f in cases.documents(spark).schema]


def test_language_keeps_clean_documents(stages):
    before, after = stages["language"]
    assert after.count() >= 0.99 * len(before)


def test_language_without_labels_and_with_few(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    none = corpus_pipeline.keep_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), cases.SF)
    assert none.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    two = docs.withColumn("lang", F.when(F.col("lang").isin("en", "de"), F.col("lang")))
    kept = corpus_pipeline.keep_language(spark, two, cases.SF).join(docs.select("doc_id", F.col("lang").alias("real")), "doc_id")
    own = F.col("real").isin("en", "de")
    assert kept.where(own).count() >= 0.99 * docs.where(F.col("lang").isin("en", "de")).count()
    assert kept.where(~own).count() <= 0.1 * docs.where(~F.col("lang").isin("en", "de")).count()


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    before.sort(key=lambda r: r["doc_id"])
    groups = components([fingerprint(r["text"]) for r in before], 3)
    assert sorted(r["doc_id"] for r in after.collect()) == [before[k]["doc_id"] for k in sorted(set(groups))]


def test_repeated_passages(stages):
    before, after = stages["repeated_passages"]
    want = {k: n for k, _, n, _, _ in brute([(r["doc_id"], r["text"]) for r in before])}
    text = {r["doc_id"]: r["text"] for r in before}
    got = {r["doc_id"]: r for r in after.collect()}
    assert set(got) == set(text)
    for k, r in got.items():
        lost = len(text[k].encode()) - len(r["text"].encode())
        assert want[k] <= lost <= want[k] + 8 * (want[k] // 50 + 1) and r["n_chars"] == len(r["text"])


def test_benchmark_leaks(stages, spark):
    before, after = stages["benchmark_leaks"]
    items = [r["text"] for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in before if any(t in r["text"] for t in items)}
    lost = {r["doc_id"] for r in before} - {r["doc_id"] for r in after.collect()}
    assert leaked <= lost and len(lost) <= len(leaked) + 2


def test_packing(stages):
    before, after = stages["packing"]
    check(after, [(r["doc_id"], r["text"]) for r in before], 2048)


def test_awkward_documents_go_through(spark):
    docs = cases.awkward(spark).selectExpr("doc_id", "text", "lang", "'s' AS source", "cast(1 AS bigint) AS n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, cases.SF))
    assert docs.count() > 0
    docs = cases.documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, cases.SF))
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins(spark, name):
    with connect(cases.SF) as con:
        assert spark_rows(QUERIES[name](spark, cases.SF)) == sql_rows(con, ORACLE[name])
