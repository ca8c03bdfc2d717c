import numpy as np

from pyspark.sql import functions as F

from tests.llm import cases
from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES

WORDS = "the of and to in is it on was with for as that by from at river stone walked green market paper window".split()
INSULTS = ["blorkhead", "snivelrat", "gruntface"]


def made_up(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        words = rng.choice(WORDS, 60).tolist()
        toxic = k % 4 == 0
        if toxic:
            words[int(rng.integers(60))] = INSULTS[k // 4 % 3]
        text = ". ".join(" ".join(words[a: a + 12]) for a in range(0, 60, 12)) + f". Number {k}."
        rows.append((k, text, int(toxic)))
    return rows


def test_learns_insults_and_takes_inserted_characters(spark):
    rows = made_up(600, 1)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    machine = toxicity.train(docs, labels, F.col("doc_id") < 400)
    got = {r["doc_id"]: r for r in toxicity.score(docs, machine, ["doc_id"]).collect()}
    assert len(got) == 600
    held = [(got[k]["predicted"], y) for k, _, y in rows if k >= 400]
    assert sum(p == y for p, y in held) >= 0.98 * len(held)
    value = lambda text: float(machine.probability(machine.decision([text]))[0])
    assert value("the river was a blorkhead in the market") > 0.7
    assert value("the river was a blor-khead in the market") > 0.5 and value("the river was a blorxkhead in the market") > 0.5
    assert value("the river was green in the market") < 0.3 and value("") < 0.3 and value(None) == value("")


def test_the_table_gives_the_kernel_expansion():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 28, (40, toxicity.WINDOW)).astype(np.uint8)
    table = rng.normal(size=toxicity.SYMBOLS**toxicity.LENGTH).astype(np.float32)
    codes, weights = toxicity.features(windows)
    direct = (table[codes] * weights).sum(axis=1)
    assert np.allclose([toxicity.values(w, table)[0] for w in windows], direct)


def test_awkward_rows_and_missing_labels(spark):
    docs = cases.documents(spark)
    labels = spark.read.parquet(f"{cases.SF}/labels.parquet")
    machine = toxicity.train(docs, labels, F.lit(True))
    rows = toxicity.score(cases.awkward(spark), machine, ["doc_id", "text", "key"]).collect()
    assert len(rows) == len(cases.ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    none = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert {r["predicted"] for r in toxicity.score(docs, none, ["doc_id"]).collect()} == {0}
    assert toxicity.score(cases.empty(spark), machine, ["doc_id"]).count() == 0


def test_query_has_a_row_for_every_document(spark):
    rows = QUERIES["op7_subsequence_kernel_toxicity"](spark, cases.SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in cases.documents(spark).collect())


def test_accents_and_other_scripts_have_symbols():
    same = lambda a, b: toxicity.encode([a])[0].tolist() == toxicity.encode([b])[0].tolist()
    assert same("\u00e9t\u00e9 Stra\u00dfe", "ete stra\u00dfe") and same("\u00d1and\u00fa", "nandu")
    assert not same("\u0434\u043e\u043c", "\u043a\u043e\u0442") and not same("\u4f60\u597d", "\u518d\u89c1") and not same("abc", "123")


def test_learns_insults_of_another_script(spark):
    insults = ["\u0434\u0443\u0440\u0430\u043b\u0435\u0439", "\u0431\u043e\u043b\u0432\u0430\u043d\u0438\u0449"]
    words = "\u0440\u0435\u043a\u0430 \u043a\u0430\u043c\u0435\u043d\u044c \u0437\u0435\u043b\u0435\u043d\u044b\u0439 \u0440\u044b\u043d\u043e\u043a \u0431\u0443\u043c\u0430\u0433\u0430 \u043e\u043a\u043d\u043e \u0434\u043e\u0440\u043e\u0433\u0430 \u0432\u0435\u0447\u0435\u0440 \u0433\u043e\u0440\u043e\u0434 \u043f\u043e\u0435\u0437\u0434".split()
    rng = np.random.default_rng(4)
    rows = []
    for k in range(500):
        text = rng.choice(words, 40).tolist()
        if k % 4 == 0:
            text[int(rng.integers(40))] = insults[k // 4 % 2]
        rows.append((k, " ".join(text) + ".", int(k % 4 == 0)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    machine = toxicity.train(docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int"), F.col("doc_id") < 350)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, machine, ["doc_id"]).collect()}
    held = [(got[k], y) for k, _, y in rows if k >= 350]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op7_subsequence_kernel_toxicity"](spark, folder).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL").collect()}
    held = [(got[k]["predicted"], y) for k, y in labels.items() if k in got and got[k]["held_out"]]
    found = [p for p, y in held if y == 1]
    wrong = [p for p, y in held if y == 0]
    print(sum(found), len(found), sum(wrong), len(wrong))
    assert sum(found) >= 0.7 * len(found) and sum(wrong) <= 0.03 * len(wrong)
