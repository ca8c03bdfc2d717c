import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tests.llm import cases
from tidemark.llm import packing, staging
from tidemark.llm.queries import tokenizer_path


def check(frame, rows, capacity):
    library = Tokenizer.from_file(tokenizer_path())
    library.encode_special_tokens = True
    want = Counter()
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        head = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(head, len(ids), capacity), len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[key, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = frame.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(r["length"] for r in got)


def test_pieces_and_places(spark):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    docs = cases.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    made, tokens = check(packing.pack(docs, tokenizer_path()), rows, 2048)
    assert made <= -(-tokens // 2048) + 1


def test_awkward_rows_and_small_capacity(spark):
    rows = [(r[0], r[1]) for r in cases.ROWS]
    check(packing.pack(cases.awkward(spark), tokenizer_path(), capacity=16), rows, 16)
    assert packing.pack(cases.empty(spark), tokenizer_path()).count() == 0


def test_ids_are_kept_on_request(spark):
    packed = packing.pack(cases.awkward(spark), tokenizer_path(), keep_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in packed)


def test_texts_reach_the_tokenizer_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(name), []
    docs = spark.range(400, numPartitions=1).selectExpr("id AS doc_id", "repeat('some words ', 10000) AS text")
    real = packing.staged

    def noted(df):
        sizes = docs.mapInArrow(lambda stream: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in stream), "n long")
        seen.append(max(r["n"] for r in sizes.collect()))
        return real(df)

    monkeypatch.setattr(packing, "staged", noted)
    packed = packing.pack(docs, tokenizer_path())
    assert seen[0] < 8 << 20 < seen[1]  # texts are read in the first step alone
    assert spark.conf.get(name) == before
    assert packed.select("doc_id").distinct().count() == 400
    with staging.small_batches(spark, 1):  # a row over the size is a batch of its own
        assert packing.pieces(docs.limit(3), tokenizer_path()).select("doc_id").distinct().count() == 3


def test_plan_uses_every_piece_once_and_comes_near_the_bound():
    rng = random.Random(3)
    for _ in range(20):
        capacity = rng.choice([20, 100, 2048])
        histogram = {rng.randint(1, capacity): rng.randint(1, 400) for _ in range(rng.randint(1, 300))}
        made = packing.plan(histogram, capacity)
        used = Counter()
        for inside, times in made:
            assert sum(inside) <= capacity and times > 0
            for length in inside:
                used[length] += times
        assert used == Counter(histogram)
        bound = max(
            -(-sum(k * n for k, n in histogram.items()) // capacity), sum(n for k, n in histogram.items() if 2 * k > capacity)
        )
        assert sum(t for _, t in made) <= 1.12 * bound + 2
    assert packing.plan({}, 10) == []
