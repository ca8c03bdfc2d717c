import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm import cases
from tidemark.llm import brown
from tidemark.llm.queries import QUERIES


def test_counts_and_base_score(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op5_brown_class_scores"](spark, cases.SF).collect()}
    texts = {r["doc_id"]: cases.split_words(r["text"]) + ["\0"] for r in cases.documents(spark).collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    count = Counter(w for k, t in texts.items() if not held[k] for w in t)
    n, v = sum(count.values()), len(count)
    for k, t in texts.items():
        r = rows[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    own = sum(r["score"] for r in rows.values() if r["held_out"])
    assert own > sum(r["base_score"] for r in rows.values() if r["held_out"])


def test_score_is_the_class_bigram_probability(spark):
    """A second, plain calculation with the model's own classes; probabilities of all words after a class sum to one."""
    texts = [(k, t) for k, t in enumerate(["a b a b c", "b a b a d e", "x y x y z", "", None, "a x unseen b", "z y x"])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = {}
    fit = brown.fit

    def keep(*args):
        kept["args"], kept["model"] = args, fit(*args)
        return kept["model"]

    brown.fit = keep
    try:
        rows = {r["doc_id"]: r for r in brown.score(docs, F.col("doc_id") != 5, vocabulary=4, classes=2).collect()}
    finally:
        brown.fit = fit
    model, frequent = kept["model"], kept["args"][1]
    words = {k: cases.split_words(t) for k, t in texts}
    count = Counter(w for k, t in words.items() if k != 5 for w in [*t, "\0"])
    key = {w: int(brown.tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0]) for k in words.values() for w in k}
    place = {int(w): k for k, w in enumerate(frequent)}

    def unit(w):
        if w == "\0":
            return len(frequent) + brown.BANDS
        return place.get(key[w], len(frequent) + int(math.log2(max(1, count[w]))))

    def logp(before, w):
        c = model.of[unit(w)]
        return model.transition[model.of[unit(before)], c] + math.log10((count[w] + 1) / model.emission[c])

    for k, t in words.items():
        chain = ["\0", *t, "\0"]
        assert math.isclose(rows[k]["score"], sum(logp(a, b) for a, b in zip(chain, chain[1:])), rel_tol=1e-9)
    vocabulary = [w for w, n in count.items() if n] + ["unseen"]
    for before in ("a", "z", "\0"):
        assert math.isclose(sum(10 ** logp(before, w) for w in vocabulary), 1, rel_tol=1e-9)


def test_exchange_raises_the_likelihood_and_ends_where_no_move_helps():
    rng = np.random.default_rng(3)
    pairs = rng.poisson(1.0, (14, 14)).astype(float)
    pairs[:5, 5:10] += rng.poisson(9, (5, 5))

    def value(of):
        m = np.zeros((14, of.max() + 1))
        m[np.arange(14), of] = 1
        t = m.T @ pairs @ m
        return brown._xlogx(t).sum() - brown._xlogx(t.sum(0)).sum() - brown._xlogx(t.sum(1)).sum()

    start = np.concatenate([np.arange(12) % 3, [3, 4]])
    of = brown.exchange(pairs, 12, 3, sweeps=50)
    assert value(of) > value(start) and of[12:].tolist() == [3, 4]
    for w in range(12):
        for c in range(3):
            moved = of.copy()
            moved[w] = c
            assert value(moved) <= value(of) + 1e-6


def test_pair_counts_are_added_up_before_the_shuffle(spark):
    """What is shuffled is bounded by the tasks and the pairs of units, however many blocks there are."""
    pairs = [(np.array([0, 4, 8], "<i8"), np.array([k, 1, 2], "<i8")) for k in range(1, 301)]
    packed = spark.createDataFrame([(bytearray(brown.pack(*p)),) for p in pairs], "payload binary").repartition(2)
    sent = brown.task_pairs(packed, 3).collect()
    assert len(sent) <= 2 * 3
    assert {p: sum(r["n"] for r in sent if r["pair"] == p) for p in (0, 4, 8)} == {0: 300 * 301 // 2, 4: 300, 8: 600}


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(brown, "PART_BYTES", 2000)
    rows = brown.score(cases.awkward(spark), F.col("lang") == "en").collect()
    assert len(rows) == len(cases.ROWS)
    words = {k: len(cases.split_words(t)) + 1 for k, t, _ in cases.ROWS}
    assert all(r["n_tokens"] == words[r["doc_id"]] and r["score"] < 0 for r in rows)
    assert brown.score(cases.empty(spark), F.lit(True)).count() == 0
    alone = brown.score(cases.awkward(spark), F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in alone)


def test_further_words_go_where_they_gain_most():
    rng = np.random.default_rng(5)
    pairs = np.kron(np.array([[2, 60, 2, 3], [60, 2, 3, 2], [2, 3, 40, 5], [4, 2, 5, 40]]), np.ones((3, 3)))
    pairs = pairs + rng.poisson(2, pairs.shape)
    # classes 0-2 hold units 0-8; units 9-11 are the band, the last of them a further word that acts like class 0
    pairs[9:, :] = rng.poisson(3, (3, 12))
    pairs[:, 9:] = rng.poisson(3, (12, 3))
    pairs[11, 3:6], pairs[3:6, 11] = 60, 60
    of = np.repeat(np.arange(4), 3)
    member = np.eye(4)[of]
    table = member.T @ pairs @ member
    left, right = (pairs[:, 11] @ member)[None], (pairs[11] @ member)[None]
    found = brown.place_further(table, left, right, np.array([3]), 3)
    assert found.tolist() == [0]

    def value(of):
        m = np.eye(4)[of]
        t = m.T @ pairs @ m
        return brown._xlogx(t).sum() - brown._xlogx(t.sum(0)).sum() - brown._xlogx(t.sum(1)).sum()

    assert int(np.argmax([value(np.append(of[:11], c)) for c in range(4)])) == 0
    plain = brown.place_further(table, (pairs[:, 9] @ member)[None], (pairs[9] @ member)[None], np.array([3]), 3)
    assert plain.tolist() == [int(np.argmax([value(np.concatenate([of[:9], [c], of[10:]])) for c in range(4)]))]


def test_further_words_lower_the_held_out_perplexity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    per_token = {}
    for further in (0, brown.FURTHER):
        held = brown.score(docs, train, further=further).where("NOT train").agg(
            (F.sum("score") / F.sum("n_tokens")).alias("s"), (F.sum("base_score") / F.sum("n_tokens")).alias("b")
        ).first()
        per_token[further], base = held["s"], held["b"]
    print(base, per_token)
    assert base < per_token[0] < per_token[brown.FURTHER]


def test_words_beyond_the_further_ones_are_placed_too(spark, monkeypatch):
    """Words that the driver does not place get the classes that it would give them; only words seen once stay where they are."""
    monkeypatch.setattr(brown, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(brown, "PART_BYTES", 3000)
    rng = np.random.default_rng(2)
    names = [[f"{kind}{n}" for n in range(40)] for kind in "abc"]
    texts = [" ".join(names[(t + k) % 3][int(rng.zipf(1.4)) % 40] for k in range(60)) for t in range(60)] + ["alone at last", "a1 b1 never"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept, fit = [], brown.fit

    def keep(*args):
        kept.append((args, fit(*args)))
        return kept[-1][1]

    monkeypatch.setattr(brown, "fit", keep)
    scores = [
        {r["doc_id"]: r["score"] for r in brown.score(docs, F.col("doc_id") != 61, vocabulary=12, classes=3, further=n).collect()} for n in (20_000, 5, 1, 0)
    ]
    for own in scores[1:3]:
        assert all(math.isclose(scores[0][k], own[k], rel_tol=1e-9) for k in own)
    assert any(not math.isclose(scores[0][k], scores[3][k], rel_tol=1e-6) for k in scores[3])
    for args, model in kept:
        assert np.allclose(model.transition, kept[0][1].transition) == (args is not kept[3][0])


def test_sweeps_go_on_until_none_moves():
    pairs = np.random.default_rng(1).poisson(1.0, (300, 300)).astype(float)
    of = brown.exchange(pairs, 290, 12)
    assert (of == brown.exchange(pairs, 290, 12, sweeps=10_000)).all() and (of != brown.exchange(pairs, 290, 12, sweeps=2)).any()
