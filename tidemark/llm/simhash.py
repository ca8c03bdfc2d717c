"""SimHash near-duplicates by a binary trie self-join.

Fingerprints: words `[^\\x20\\x09-\\x0D]+` of the A-Z-lowered text, shingles of `width` words joined by one space
(repeats count; fewer words: the whole sequence), XXH64 with seed 42 of each; a bit is 1 if it is set in more than half of them.
A text without words has fingerprint zero.

Join: distinct fingerprints are the leaves of a binary trie. Pairs of trie nodes are walked together from the
root; where the pair's branches differ the error grows by one, and a pair over the budget is dropped with all leaves
below it. A walk may spend its errors anywhere, but by the pigeonhole some one of budget + 1 blocks of bits is free of
errors; so each fingerprint is entered once per block, rotated to bring that block to the top, and the walk starts at the
trie nodes below the block, with no error spent. Spark deals these nodes to tasks; every walk is inside one node. A node of very
many leaves is split by its next six bits: pairs of its branches that differ in no more bits than the budget are dealt one by one.
A walk returns a spanning forest of the links it found, so large families of copies do not become all pairs.

Null text reads as empty; equal texts share one leaf; null ids are in a component but do not name it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytewise, components
from tidemark.llm.staging import staged

WIDTH = 3
SEED = 42
BUDGET = 3
WALK_ROWS = 200_000  # fingerprints of whole trie nodes that one walk takes at a time
NODE_LEAVES = 200_000  # a trie node of more leaves is dealt in pairs of branches
BRANCH_BITS = 6
PAIR_BLOCK = 500_000  # pairs of trie nodes, or of leaves, held at a time


def _normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, bytewise.Spans]:
    """Words joined by one space each, and their spans."""
    low = bytewise.LOWER[data]
    spans = bytewise.words(low, offsets, ~bytewise.SPACE[low])
    length = spans.end - spans.start
    start = np.cumsum(length + 1) - (length + 1)
    text = np.full(int((length + 1).sum()), 32, np.uint8)
    text[bytewise.ranges(start, length)] = low[bytewise.ranges(spans.start, length)]
    return text, bytewise.Spans(start, start + length, spans.row)


def _bit_counts(hashes: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in each run of hashes (runs are not empty).

    Eight bits are counted at a time, in the bytes of one word; a run is cut so that no byte overflows.
    """
    cuts = (count + 254) // 255
    first = np.cumsum(cuts) - cuts
    piece = np.repeat(begin, cuts) + 255 * bytewise.ranges(np.zeros(len(cuts), np.int64), cuts)
    out = np.empty((len(begin), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(0x0101010101010101), piece)
        out[:, k::8] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """One 64-bit fingerprint per row."""
    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    text, spans = _normal(data, offsets)
    if not len(spans):
        return out
    per_row = np.bincount(spans.row, minlength=n)
    first = np.cumsum(per_row) - per_row
    shingles = np.where(per_row == 0, 0, np.maximum(per_row - width + 1, 1))
    at = bytewise.ranges(first, shingles)
    last = np.minimum(at + width - 1, np.repeat(first + per_row - 1, shingles))
    whole, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(whole[a:b], seed) for a, b in zip(spans.start[at].tolist(), spans.end[last].tolist())), np.uint64, len(at)
    )
    some = np.flatnonzero(shingles)
    ones = _bit_counts(hashes, (np.cumsum(shingles) - shingles)[some], shingles[some])
    set_bits = (2 * ones > shingles[some][:, None]).astype(np.uint64)
    out[some] = (set_bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def with_fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, fingerprint long) per row."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            data, offsets = bytewise.flat(batch.column(1))
            parts = [
                fingerprints(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], width)
                for a, b in bytewise.slices(offsets)
            ]
            value = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value.view(np.int64))], ["key", "fingerprint"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(task, "key long, fingerprint long").withColumnRenamed("key", key)


class Forest:
    """Disjoint sets over 0 .. n-1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


def walk(values: np.ndarray, low: np.ndarray, high: np.ndarray, top: int, budget: int, forest: Forest) -> None:
    """Walk the trie nodes [low, high) of the sorted values, each with itself, and link leaves within the budget.

    `top` is the highest bit in which leaves of one node may differ.
    """
    zero = np.zeros(len(low), np.int64)
    stack = [(top, low, high, low, high, zero)]
    while stack:
        bit, a0, a1, b0, b1, spent = stack.pop()
        if len(a0) > PAIR_BLOCK:
            half = len(a0) // 2
            stack += [(bit, *[x[half:] for x in (a0, a1, b0, b1, spent)]), (bit, *[x[:half] for x in (a0, a1, b0, b1, spent)])]
            continue
        few = (a1 - a0) * (b1 - b0) <= 16
        if bit < 0:
            few[:] = True
        _leaves(values, a0[few], a1[few], b0[few], b1[few], budget, forest)
        many = ~few
        if not many.any():
            continue
        a0, a1, b0, b1, spent = a0[many], a1[many], b0[many], b1[many], spent[many]
        mask = np.uint64((1 << bit) - 1)
        am = _middle(values, a0, a1, bit, mask)
        bm = _middle(values, b0, b1, bit, mask)
        twin = (a0 == b0) & (a1 == b1)
        pairs = [
            (a0, am, b0, bm, spent), (am, a1, bm, b1, spent), (a0, am, bm, b1, spent + 1),
            tuple(x[~twin] for x in (am, a1, b0, bm, spent + 1)),
        ]
        joined = [np.concatenate([p[k] for p in pairs]) for k in range(5)]
        going = (joined[0] < joined[1]) & (joined[2] < joined[3]) & (joined[4] <= budget)
        going &= ~((joined[0] == joined[2]) & (joined[1] - joined[0] == 1) & (joined[3] - joined[2] == 1))
        if going.any():
            stack.append((bit - 1, *[x[going] for x in joined]))


def _middle(values: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int, mask: np.uint64) -> np.ndarray:
    """The first place in [low, high) where the bit is set; all bits above agree there."""
    one = np.uint64(1 << bit)
    border = (values[low] & ~(mask | one)) | one
    return np.clip(np.searchsorted(values, border), low, high)


def _leaves(values, a0, a1, b0, b1, budget, forest) -> None:
    """Compare the leaves of the node pairs one by one."""
    if not len(a0):
        return
    count = (a1 - a0) * (b1 - b0)
    cuts = np.searchsorted(np.cumsum(count), np.arange(PAIR_BLOCK, count.sum() + PAIR_BLOCK, PAIR_BLOCK))
    first = 0
    for last in np.unique(np.append(cuts + 1, len(count))).clip(0, len(count)):
        if last <= first:
            continue
        part = slice(first, last)
        n = count[part]
        k = bytewise.ranges(np.zeros(len(n), np.int64), n)
        wide = np.repeat(b1[part] - b0[part], n)
        i = np.repeat(a0[part], n) + k // wide
        j = np.repeat(b0[part], n) + k % wide
        near = (np.bitwise_count(values[i] ^ values[j]) <= budget) & (i != j)
        forest.link(i[near], j[near])
        first = last


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return values if not by else (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def trie_links(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Distinct fingerprints in; links (a, b) that connect exactly what lies within the budget."""
    blocks = budget + 1
    bits = 64 // blocks

    def walked(block: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links among sorted rotated values of whole trie nodes."""
        node = values >> np.uint64(64 - bits)
        low = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        high = np.append(low[1:], len(values))
        some = high - low > 1
        forest = Forest(len(values))
        walk(values, low[some], high[some], 63 - bits, budget, forest)
        moved = np.flatnonzero(forest.root != np.arange(len(values)))
        back = _rotated(values, -block * bits)
        return back[moved], back[forest.root[moved]]

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, np.zeros(0, np.uint64)

        def flush(values: np.ndarray):
            if len(values) > 1:
                a, b = walked(held_key[0], values)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in stream:
            # whole nodes of a block are walked together; pairs of branches (lane > 0) one by one
            block, lane, node = (batch.column(k).to_numpy() for k in range(3))
            value = batch.column(3).to_numpy().view(np.uint64)
            keys = np.stack([block, lane, np.where(lane > 0, node, 0)], axis=1)
            new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
            for a, b in zip(new, np.append(new[1:], len(keys))):
                key, mine = tuple(keys[a].tolist()), value[a:b]
                if key != held_key:
                    yield from flush(held)
                    held_key, held = key, mine
                    continue
                held = np.concatenate([held, mine])
                if key[1] == 0 and len(held) > WALK_ROWS:
                    last = held[-1] >> np.uint64(64 - bits)
                    cut = int(np.searchsorted(held, last << np.uint64(64 - bits)))
                    yield from flush(held[:cut])
                    held = held[cut:]
        yield from flush(held)

    entered = prints.select("fingerprint").distinct().select(
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("block"), (
                F.col("fingerprint") if k == 0 else
                F.shiftleft("fingerprint", k * bits).bitwiseOR(F.shiftrightunsigned("fingerprint", 64 - k * bits))
            ).alias("value")) for k in range(blocks)
        ])).alias("e")
    ).select("e.block", "e.value")
    # unsigned order of the values: the sign bit is flipped for the sort
    placed = entered.withColumn("node", F.shiftrightunsigned("value", 64 - bits))
    large = placed.groupBy("block", "node").agg(F.count(F.lit(1)).alias("leaves")).where(F.col("leaves") > NODE_LEAVES)
    branch = F.shiftrightunsigned("value", 64 - bits - BRANCH_BITS).bitwiseAND(F.lit(2**BRANCH_BITS - 1)).cast("int")
    lanes = F.expr(f"""CASE WHEN leaves IS NULL THEN array(0) ELSE transform(
        filter(sequence(0, {2**BRANCH_BITS - 1}), o -> bit_count(o ^ branch) <= {budget}),
        o -> 1 + {2**BRANCH_BITS} * least(branch, o) + greatest(branch, o)) END""")
    dealt = (
        placed.withColumn("branch", branch).join(large, ["block", "node"], "left")
        .select("block", F.explode(lanes).alias("lane"), "node", "value").repartition("block", "lane", "node")
    )
    return dealt.sortWithinPartitions(
        "block", "lane", "node", F.col("value").bitwiseXOR(F.lit(-(2**63)).cast("long"))
    ).mapInArrow(task, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, budget: int = BUDGET) -> DataFrame:
    """(key, fingerprint long, component_id): the smallest key reachable over links of at most `budget` bits."""
    prints = staged(with_fingerprint(docs, key, text, width))
    classes = staged(prints.groupBy("fingerprint").agg(F.min(key).alias("least")))
    root = components.roots(trie_links(classes, budget))
    rooted = staged(
        classes.join(root, classes.fingerprint == root.node, "left")
        .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return (
        prints.join(rooted.join(named, "root").select("fingerprint", "component_id"), "fingerprint")
        .select(key, "fingerprint", "component_id")
    )
