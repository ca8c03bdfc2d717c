import numpy as np
import pytest
import xxhash

from tests.llm import cases
from tidemark.llm import simhash


def fingerprint(text, width=3):
    words = cases.split_words(text)
    shingles = [" ".join(words[k: k + width]) for k in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, budget):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(prints))]


def compare(spark, frame, rows):
    got = {(r["doc_id"], r["fingerprint"] & (2**64 - 1)): r["component_id"] for r in frame.collect()}
    prints = [fingerprint(t) for _, t in rows]
    groups = components(prints, 3)
    least = {}
    for (key, _), g in zip(rows, groups):
        if key is not None:
            least[g] = min(key, least.get(g, key))
    assert got == {(key, p): least.get(g) for (key, _), p, g in zip(rows, prints, groups)}


def test_against_all_pairs(spark):
    docs = cases.documents(spark)
    compare(spark, simhash.near_duplicates(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_awkward_rows(spark):
    frame = simhash.near_duplicates(cases.awkward(spark))
    assert frame.count() == len(cases.ROWS)
    compare(spark, frame, [(r[0], r[1]) for r in cases.ROWS])
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("leaves", [200_000, 20])
def test_walk_links_all_close_pairs(spark, monkeypatch, leaves):
    monkeypatch.setattr(simhash, "NODE_LEAVES", leaves)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 30, dtype=np.int64).astype(np.uint64)
    values = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(40):
            x = c
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
            values.add(x)
    ordered = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in ordered], "fingerprint long")
    links = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.trie_links(frame).collect()]
    assert all(bin(a ^ b).count("1") for a, b in links)
    place = {v: k for k, v in enumerate(ordered)}
    forest = simhash.Forest(len(ordered))
    forest.link(np.array([place[a] for a, _ in links]), np.array([place[b] for _, b in links]))
    assert forest.root.tolist() == components(ordered, 3)
