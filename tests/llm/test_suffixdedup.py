import hashlib
import random

import numpy as np
import pyarrow as pa

from tests.llm import cases
from tidemark.llm import suffixdedup


def brute(rows, span=50):
    first = {}
    texts = [(2**63 - 1 if k is None else k, (t or "").encode()) for k, t in rows]
    for key, raw in texts:
        for i in range(len(raw) - span + 1):
            s = raw[i: i + span]
            first[s] = min(key, first.get(s, key))
    out = []
    for (shown, _), (key, raw) in zip(rows, texts):
        gone = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            if first[raw[i: i + span]] < key:
                gone[i: i + span] = b"\1" * span
        left = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((shown, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def test_many_chunks_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(suffixdedup, "PART_BYTES", 60_000)
    monkeypatch.setattr(suffixdedup, "BLOCK", 1000)
    docs = cases.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(suffixdedup.remove_repeats(docs)) == brute(rows)


def test_awkward_rows(spark):
    frame = suffixdedup.remove_repeats(cases.awkward(spark), keep_text=True)
    assert rows_of(frame) == brute([(r[0], r[1]) for r in cases.ROWS])
    assert set(cases.EXTRA) <= set(frame.columns)
    assert suffixdedup.remove_repeats(cases.empty(spark)).count() == 0


def test_cuts_inside_characters(spark):
    shared = "é" * 40
    rows = [(1, "x" + shared), (2, "yè" + shared), (3, "\u00c3" + shared[:-1] + "è"), (4, "ab" * 60), (5, "ba" * 70)]
    frame = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True)
    assert rows_of(frame) == brute(rows)
    assert all(r["kept_text"] is not None for r in frame.collect())


def phrase_amid_different_text(n):
    draw = random.Random(5)
    text = lambda: "".join(draw.choices("abcdefgh ", k=60))
    rows = [(k, f"{text()}Section: of the annual report {text()}") for k in range(n)]
    return rows + [(n + k, text() + rows[k][1][40: 110] + text()) for k in range(0, n, 7)]


def test_pieces_of_a_hot_anchor_are_dealt_to_many_parts():
    rows = phrase_amid_different_text(500)
    chunk = suffixdedup.Chunk(pa.table({"k": [k for k, _ in rows], "t": [t for _, t in rows]}), "k", "t")
    own, _ = chunk.anchors()
    top = np.argmax(chunk.sizes(own))
    assert chunk.sizes(own)[top] >= 7
    _, _, _, _, _, deal, _, _ = chunk.pieces(own[top: top + 1], np.array([True]))
    share = np.bincount((deal % np.uint64(16)).astype(int), minlength=16)
    assert share.max() < 2 * share.mean()
    same = suffixdedup.Chunk(pa.table({"k": range(500), "t": [rows[0][1]] * 500}), "k", "t")
    assert not same.sizes(same.anchors()[0]).any()  # one piece, however often


def test_hot_anchors_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(suffixdedup, "PART_BYTES", 10_000)
    monkeypatch.setattr(suffixdedup, "HOT_PIECES", 20)
    rows = phrase_amid_different_text(400)
    assert rows_of(suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
