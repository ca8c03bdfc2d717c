import re
import time

from pyspark.sql import functions as F

from tests.llm import cases
from tidemark.llm import decontaminate

ITEMS = [
    (1, "On Monday the farmer Anna sold 12 crates for 30 dollars each while her neighbour Boris sold 7 crates for 25 dollars each."),
    (2, "A train leaves the northern station at 9 and travels 80 km per hour until it meets the slower freight train near the bridge."),
    (3, "What is the capital city"), (4, None), (5, ""), (6, "of the"),
    (7, "Both tanks hold 5 liters and after 5 minutes the valve lets 5 liters pass into the lower tank of the plant."),
]


def found(spark, texts, **more):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, item_id string")
    rows = decontaminate.mark(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), **more).collect()
    assert len(rows) == len(texts)
    return [sorted((x["item_id"], x["same_values"]) for x in r["leaks"]) for r in rows]


def test_templates_and_slots(spark):
    pad = "Some other words stand before it, many of them. "
    got = found(spark, [
        pad + ITEMS[0][1] + " And more follows.",
        pad + "On Monday the farmer Clara sold 15 crates for 41 dollars each while her neighbour Dmitri sold 9 crates for 18 dollars each.",
        pad + ITEMS[1][1].upper(),
        pad + "A train leaves the northern station at 11 and travels 95 km per hour",
        pad + "A train leaves the northern",
        "Tell me: what is the capital city?",
        pad, None, "", "of the of the",
        # one value of the item would have to be three values here
        "Both tanks hold 5 liters and after 6 minutes the valve lets 8 liters pass into the lower tank of the plant.",
        "Both tanks hold 9 liters and after 9 minutes the valve lets 9 liters pass into the lower tank of the plant.",
    ])
    assert got == [[(1, True)], [(1, False)], [(2, True)], [(2, False)], [], [(3, True)], [], [], [], [], [], [(7, False)]]


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    texts = [t or "" for _, t in ITEMS] * 2
    whole = found(spark, texts)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert found(spark, texts) == whole


def test_finds_every_contained_item_and_little_else(spark):
    docs = cases.documents(spark)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()]
    want = {(r["doc_id"], k) for r in docs.collect() for k, t in items if t in (r["text"] or "")}
    marked = decontaminate.mark(docs, spark.read.parquet(f"{cases.SF}/benchmark.parquet"))
    got = {(r["doc_id"], r["item_id"]) for r in marked.select("doc_id", F.explode("leaks.item_id").alias("item_id")).collect()}
    assert want <= got
    for k, i in got - want:  # the rest are the same words in other case or spacing
        bare = lambda t: " ".join(re.findall(r"\w+", t.lower()))
        text = next(r["text"] for r in docs.collect() if r["doc_id"] == k)
        assert bare(dict(items)[i]) in bare(text)


def test_awkward_rows(spark):
    benchmark = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    marked = decontaminate.mark(cases.awkward(spark), benchmark)
    assert marked.count() == len(cases.ROWS) and set(cases.EXTRA) <= set(marked.columns)
    assert decontaminate.mark(cases.empty(spark), benchmark).count() == 0
    assert {len(r["leaks"]) for r in decontaminate.mark(cases.awkward(spark), benchmark.limit(0)).collect()} == {0}


def leaks_of(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontaminate.mark(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r["doc_id"]: sorted((x["item_id"], x["same_values"]) for x in r["leaks"]) for r in rows}
    return [got[k] for k in range(len(texts))]


def test_whole_copies_of_items_with_few_literal_words(spark):
    items = [
        (1, "Compute 12 + 7 * 3 - 45 / 9 + 8"), (2, "小明有十二个苹果，他又买了七个，现在一共有多少个？"), (3, "ราคาของส้มสามลูกเท่ากับเท่าไร"),
        (4, "12 * 31 - 5"), (5, "¿Cuál es—según el mapa—la capital “antigua”?"),
    ]
    got = leaks_of(spark, items, [
        "Homework. Compute 12 + 7 * 3 - 45 / 9 + 8, then rest.",
        "Homework. Compute 13 + 6 * 4 - 41 / 8 + 2, then rest.",
        "老师说：小明有十二个苹果，他又买了七个，现在一共有多少个？请回答。", "小明有苹果，老师说现在请回答。",
        "คำถามราคาของส้มสามลูกเท่ากับเท่าไรครับ", "so 12 * 31 - 5 it is", "so 12 * 32 - 5 it is", "Di: cuál es según el mapa la capital antigua",
    ])
    assert got == [[(1, True)], [], [(2, True)], [], [(3, True)], [(4, True)], [], [(5, True)]]


def test_any_alignment_that_agrees_is_a_leak(spark):
    broken = "Both tanks hold 5 liters and after 6 minutes the valve lets 8 liters pass into the lower tank of the plant. "
    cut = ITEMS[6][1].replace("minutes the valve", "minutes, so they say, the valve")
    got = found(spark, [
        broken + ITEMS[6][1], broken * 3 + "Some other words stand between. " + ITEMS[6][1], broken + broken.replace("8", "9"),
        broken + "Some other words stand between them here. " + cut,
    ])
    assert got == [[(7, True)], [(7, True)], [], [(7, True)]]


def sums(k, name="Anna"):
    return f"On Monday the farmer {name} sold {k} crates for {k + 9} dollars each while her neighbour sold {2 * k + 100} crates for less."


def test_a_family_of_items_is_looked_up_as_one(spark):
    items = [(k, sums(k)) for k in range(1, 5001)] + [(9000, sums(77, "Clara")), (9001, ITEMS[1][1])]
    table = decontaminate.Table(items)
    assert len(set(table.group.tolist())) == 2
    page = " ".join(sums(k) for k in range(20_000, 29_000))  # some 1 MB of other values
    began = time.time()
    rows = leaks_of(spark, items, [page, page + " " + sums(4321), "So " + sums(77, "CLARA").upper(), sums(12) + " " + sums(13), sums(6000, "Clara")])
    assert time.time() - began < 120
    assert rows == [[(1, False)], [(4321, True)], [(9000, True)], [(12, True), (13, True)], [(1, False)]]


def test_one_class_needs_one_pattern_of_equal_values(spark):
    text = "Both tanks hold {} liters and after {} minutes the valve lets {} liters pass into the lower tank of the plant."
    items = [(1, text.format(5, 6, 5)), (2, text.format(5, 6, 7)), (3, text.format(1, 2, 3))]
    got = leaks_of(spark, items, [text.format(8, 9, 8), text.format(8, 9, 4), text.format(1, 2, 3), text.format(8, 9, 9)])
    assert got == [[(1, False)], [(2, False)], [(3, True)], []]


def test_short_items_leak_into_documents_that_are_nothing_else(spark):
    got = leaks_of(spark, [(1, "12 * 7"), (2, "of the"), (3, "Why?")], ["12 * 7 =", "and 12 * 7 is", "Of the", "of the of the", "why", "", None])
    assert got == [[(1, True)], [], [(2, True)], [], [(3, True)], [], []]
