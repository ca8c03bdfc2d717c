import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import cases
from tidemark.llm import treap

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(cases.ascii_lower(text))


def brute(docs, items, k=10):
    held = [(i, terms(t)) for i, t in docs if i is not None and terms(t)]
    n_docs, total = len(held), sum(len(t) for _, t in held)
    df = Counter(w for _, t in held for w in set(t))
    out = []
    for item, text in set(items):
        found = []
        for i, t in held:
            tf, m = Counter(t), 100 - 90 + (90 * len(t) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
                for w in set(terms(text)) if w in tf
            )
            if score > 0:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def compare(spark, docs, items, k=10):
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, term string, score int")
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, number int")
    got = sorted((tuple(r) for r in treap.rank(frame, asked, k).collect()), key=repr)
    assert got == brute(docs, items, k)
    return got


def test_given_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in cases.documents(spark).collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()]
    assert compare(spark, docs, items)


@pytest.mark.parametrize("rows", [16, 1 << 14])
def test_awkward_rows(spark, monkeypatch, rows):
    monkeypatch.setattr(treap, "RANGE", rows)
    docs = [(r[0], r[1]) for r in cases.ROWS]
    docs += [(100 + i, "the same words here") for i in range(60)] + [(90, "the same words here"), (500, "MB " * 700_000 + "unlike")]
    items = [
        (1, "river mill children"), (2, None), (3, ""), (4, " ?! "), (5, "Größe niñé 東京"), (6, "the same words here"), (6, "the same words here"),
        (6, "word7 runs"), (None, "summer day"), (7, "nowhereatall"), (8, "unlike mb"), (9, "123 a"),
    ]
    compare(spark, docs, items)
    compare(spark, docs, items, k=3)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(treap, "BLOCK_BYTES", 40)
    compare(spark, [(i, f"w{i % 7} w{i % 5} common w{i}") for i in range(90)], [(i, f"w{i} w{i + 3} common") for i in range(9)])


def test_empty_tables(spark):
    compare(spark, [], [(1, "a b")])
    compare(spark, [(1, "a b")], [])
    compare(spark, [(1, None), (2, "...")], [(1, "a b")])


def test_hash_collisions_are_confirmed(spark, monkeypatch):
    plain = treap.bytewise.Spans.hashes
    monkeypatch.setattr(treap.bytewise.Spans, "hashes", lambda self, data: plain(self, data) % np.uint64(3) << np.uint64(60))
    table = treap.Items([(1, "alpha beta gamma delta"), (2, "beta eps")])
    import pyarrow as pa
    data, spans = treap.term_spans(pa.array(["beta alphx alpha zeta delta", "EPS gamma ep"]))
    span, term = table.find(data, spans)
    found = sorted((data[spans.start[s]: spans.end[s]].tobytes(), table.words[t]) for s, t in zip(span, term))
    assert found == [(w, w) for w in (b"alpha", b"beta", b"delta", b"eps", b"gamma")]


def test_search_against_sums():
    rng = np.random.default_rng(3)
    for columns, rows in ((1, 1), (7, 40), (300, 90)):
        cells = np.unique(rng.integers(0, rows * columns, rows * columns // 4 + 1))
        row, column = cells // columns, cells % columns
        impact = rng.integers(1, 6, len(cells)) * 100
        ids = rng.permutation(columns * 3)[:columns]
        grid = treap.Treap(row, column, impact, ids)
        for _ in range(20):
            chosen = np.unique(rng.integers(0, rows, 5))
            total = np.bincount(column[np.isin(row, chosen)], impact[np.isin(row, chosen)], columns).astype(int)
            expected = sorted((-s, i) for s, i in zip(total, ids) if s)[:6]
            none = np.zeros(0, np.int64)
            scores, found = grid.search(chosen, 6, (none, none))
            assert [(-s, i) for s, i in zip(scores, found)] == expected
