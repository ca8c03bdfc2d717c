import zlib

from pyspark.sql import functions as F

from tests.llm import cases
from tidemark.llm import langid
from tidemark.llm.queries import QUERIES


def test_held_out_accuracy_and_rows(spark):
    rows = QUERIES["op3_string_kernel_language"](spark, cases.SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in cases.documents(spark).collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    model = langid.train(cases.documents(spark), F.lit(True))
    rows = langid.identify(cases.awkward(spark), model).collect()
    assert len(rows) == len(cases.ROWS) and set(cases.EXTRA) - {"score", "__text"} <= set(rows[0].asDict())
    for r in rows:
        letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letter)
    assert langid.identify(cases.empty(spark), model).count() == 0


def test_no_labels_or_one_label(spark):
    none = langid.train(cases.empty(spark), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(cases.documents(spark), none, keep=["doc_id"]).collect()} == {"und"}
    one = langid.train(cases.documents(spark).where("lang = 'de'"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(cases.documents(spark), one, keep=["doc_id"]).collect()} == {"de"}


def test_the_kernel_counts_shared_grams():
    import numpy as np

    def spectrum(text):
        seen = np.zeros(langid.GRAMS, np.uint8)
        langid.grams(text, seen)
        return int(seen.sum())

    def plain(text):
        s = "".join(c if c.isalpha() else " " for c in text.lower())
        s = " ".join(s.split()) + (" " if not text[-1].isalpha() else "")
        return len({s[i: i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)})

    for text in ("abcabcab", "the cat, the  mat.", "x"):
        assert spectrum(text) == plain(text)


def test_texts_of_unlearned_languages_do_not_fit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for learnt in (["en", "de"], ["es", "de", "fr"], ["en", "fr"]):
        model = langid.train(docs.where(F.col("lang").isin(learnt)), F.lit(True))
        own = F.col("lang").isin(learnt)
        rows = langid.identify(docs, model, keep=["doc_id", "lang"]).groupBy(own.alias("own")).agg(F.avg(F.col("fits").cast("int")).alias("fits")).collect()
        share = {r["own"]: r["fits"] for r in rows}
        assert share[True] >= 0.99 and share[False] <= 0.1
