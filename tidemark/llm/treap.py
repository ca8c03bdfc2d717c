"""Ranked lexical search by K2-treaps over the term x document grid (Brisaboa, de Bernardo, Konow, Navarro and Seco, 2016).

1. Documents are read once: each becomes its length in terms and the counts of those terms that an item holds. Term
   frequencies over all documents, N and L are summed from that table.
2. A range of documents is a grid: a row is a term (in the order of weights, so that near rows have near impacts), a column is a document (in
   the order of lengths, for the same reason), a cell is the term's impact on the document's score. The grid is a quadtree that stores its
   non-empty cells only: a node has a mask of its four children, the place of the first one, and the largest impact below.
3. Each item descends that tree with the paths of all its rows at once, best first: a state is a range of columns and the node of each
   row there; its bound is the sum of the nodes' maxima. The states of the highest bounds are halved, a few at a time; a state of one
   column is a document with its exact score. States below the item's k-th best so far are dropped, those equal to it too where no document id
   in them is small enough. The best of earlier ranges in a task count from the start.
4. The k best of each task and item meet in one ranking per item.

Items are taken in blocks of about BLOCK_BYTES of text; a block's terms are sent to all tasks. Texts are never shuffled; no cell of
the grid leaves its task. Terms that no item holds count in the lengths and are in no grid.

Null and empty texts (and those without a term) are no documents: N does not count them. Rows without an id are left out and count
nowhere. Repeated document rows are documents each, so an id may come twice in a ranking. Equal item rows count once; an id with several
texts is ranked for each of them; items without a term, or without a document, give no row. Ties go to the smaller id. Only the named columns
are read, so further ones do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import bytewise
from tidemark.llm.staging import staged

BLOCK_BYTES = 4 << 20  # of item texts
RANGE = 1 << 14  # documents of one grid
STATES = 512  # halved at a time, at most
FILTER_BITS = 20

# ASCII letters and digits, and every byte of a character beyond ASCII
INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = True
INSIDE[128:] = True

SET_BITS = np.array([bin(m).count("1") for m in range(16)])


def term_spans(column: pa.Array) -> tuple[np.ndarray, bytewise.Spans]:
    """Lower-cased bytes of a text column and the spans of its terms."""
    data, offsets = bytewise.flat(column)
    data = bytewise.LOWER[data]
    return data, bytewise.words(data, offsets, INSIDE[data])


class Items:
    """Distinct items and the table of their terms; a term is found by hash and confirmed byte by byte."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in rows]
        data, spans = term_spans(pa.array([t for _, t in rows], pa.string()))
        words = [data[a:b].tobytes() for a, b in zip(spans.start, spans.end)]
        self.words = sorted(set(words))
        place = {w: k for k, w in enumerate(self.words)}
        self.terms: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rows)
        number = np.array([place[w] for w in words], np.int64)
        for row in np.unique(spans.row):
            self.terms[row] = np.unique(number[spans.row == row])
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(self.words), np.uint8)
        none = np.zeros(len(self.words), np.int64)
        hashes = bytewise.Spans(self.start, self.start + self.length, none).hashes(self.data)
        self.order = np.argsort(hashes, kind="stable")
        self.hash = hashes[self.order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hash >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, data: np.ndarray, spans: bytewise.Spans) -> tuple[np.ndarray, np.ndarray]:
        """(span, term) for the spans that are terms of an item."""
        value = spans.hashes(data)
        maybe = np.flatnonzero(self.filter[value >> np.uint64(64 - FILTER_BITS)])
        low, high = np.searchsorted(self.hash, value[maybe]), np.searchsorted(self.hash, value[maybe], "right")
        span, term = np.repeat(maybe, high - low), self.order[bytewise.ranges(low, high - low)]
        size = spans.end[span] - spans.start[span]
        fit = size == self.length[term]
        span, term, size = span[fit], term[fit], size[fit]
        same = data[bytewise.ranges(spans.start[span], size)] == self.data[bytewise.ranges(self.start[term], size)]
        differ = np.unique(np.repeat(np.arange(len(span)), size)[~same])
        return np.delete(span, differ), np.delete(term, differ)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def postings(docs: DataFrame, items, key: str, text: str) -> DataFrame:
    """(id, n, terms, counts): each document's length in terms, and its counts of item terms. `items`: broadcast Items."""
    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytewise.batches(stream):
            column = batch.column(1)
            _, offsets = bytewise.flat(column)
            for a, b in bytewise.slices(offsets):
                data, spans = term_spans(column.slice(a, b - a))
                n = np.bincount(spans.row, minlength=b - a)
                span, term = items.value.find(data, spans)
                width = max(1, len(items.value.words))
                cells, count = np.unique(spans.row[span] * width + term, return_counts=True)
                some = n > 0
                per_row = np.bincount(cells // width, minlength=b - a)[some]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a).filter(pa.array(some)), pa.array(n[some]), _lists(cells % width, per_row), _lists(count, per_row),
                ], ["id", "n", "terms", "counts"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).where("id is not null")
    return rows.mapInArrow(task, "id long, n long, terms array<int>, counts array<int>")


def frequencies(listed: DataFrame, width: int) -> np.ndarray:
    """Documents that hold each term; tasks add up their own."""
    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(width, np.int64)
        for batch in stream:
            out += np.bincount(batch.column(0).flatten().to_numpy(), minlength=width)
        held = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(out[held])], ["term", "df"])

    df = np.zeros(width, np.int64)
    for r in listed.select("terms").mapInArrow(task, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of x at even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """The quadtree of a grid of positive impacts, and the ids of its columns.

    Nodes of all levels are numbered through, the root is 0. Child q of a node (2 x row half + column half) exists if bit q of `mask`
    is set, and is `first` plus the number of set bits below q.
    """

    def __init__(self, row: np.ndarray, column: np.ndarray, impact: np.ndarray, ids: np.ndarray):
        self.levels = max(1, int(max(row.max(initial=0), len(ids) - 1)).bit_length())
        code = (_spread(row) << np.uint64(1)) | _spread(column)
        order = np.argsort(code)
        code, top = code[order], impact[order]
        masks, tops = [], [top]
        for _ in range(self.levels):
            parent = code >> np.uint64(2)
            start = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(code) else np.zeros(0, np.int64)
            masks.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), start) if len(code) else np.zeros(0, np.uint8))
            top = np.maximum.reduceat(top, start) if len(code) else top
            tops.append(top)
            code = parent[start]
        self.mask = np.concatenate([*masks[::-1], np.zeros(len(impact), np.uint8)])
        self.top = np.concatenate(tops[::-1])
        self.first = 1 + np.cumsum(SET_BITS[self.mask]) - SET_BITS[self.mask]
        # the smallest id below each range of columns; level by level, as a heap
        least = np.full(1 << self.levels, np.iinfo(np.int64).max)
        least[: len(ids)] = ids
        heap = [least]
        while len(heap[-1]) > 1:
            heap.append(heap[-1].reshape(-1, 2).min(axis=1))
        self.least = np.concatenate(heap[::-1])

    def search(self, rows: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, ids) of `best` and of this grid's columns, by the rows' summed impacts."""
        scores, ids = best
        rows = rows[rows < 1 << self.levels]  # further rows have no cell here
        if not len(self.top) or not len(rows):
            return best
        node_row, node = rows, np.zeros(len(rows), np.int64)  # of all waiting states, state by state
        bound, level, column = np.array([self.top[0] * len(rows)]), np.zeros(1, np.int64), np.zeros(1, np.int64)
        size = np.array([len(rows)])
        batch = 4
        while len(bound):
            if len(scores) == k:
                place = (1 << level) - 1 + column
                alive = (bound > scores[-1]) | ((bound == scores[-1]) & (self.least[place] < ids[-1]))
                if not alive.all():
                    held = np.repeat(alive, size)
                    node_row, node = node_row[held], node[held]
                    bound, level, column, size = bound[alive], level[alive], column[alive], size[alive]
                    if not len(bound):
                        break
            batch = min(STATES, 2 * batch)
            chosen = np.zeros(len(bound), bool)
            chosen[np.argpartition(bound, len(bound) - batch)[-batch:] if batch < len(bound) else slice(None)] = True
            taken = np.repeat(chosen, size)
            r, x = node_row[taken], node[taken]
            state = np.repeat(np.arange(int(chosen.sum())), size[chosen])
            depth, left = level[chosen], column[chosen] * 2
            half = (r >> (self.levels - 1 - depth[state])) & 1
            fresh = []
            for side in (0, 1):
                q = 2 * half + side
                there = (self.mask[x] >> q) & 1 == 1
                y = x[there]
                child = self.first[y] + SET_BITS[self.mask[y] & ((1 << q[there]) - 1)]
                own = state[there]
                total = np.zeros(len(depth), np.int64)
                np.add.at(total, own, self.top[child])
                fresh.append((total, depth + 1, left + side, np.bincount(own, minlength=len(depth)), r[there], child))
            total, depth, col, count = (np.concatenate([f[i] for f in fresh]) for i in range(4))
            r, child = (np.concatenate([f[i] for f in fresh]) for i in (4, 5))
            done = (depth == self.levels) & (count > 0)
            if done.any():
                at = (1 << self.levels) - 1 + col[done]
                scores, ids = np.concatenate([scores, total[done]]), np.concatenate([ids, self.least[at]])
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
            on = (depth < self.levels) & (count > 0)
            onward = np.repeat(on, count)
            node_row, node = np.concatenate([node_row[~taken], r[onward]]), np.concatenate([node[~taken], child[onward]])
            bound, level = np.concatenate([bound[~chosen], total[on]]), np.concatenate([level[~chosen], depth[on]])
            column, size = np.concatenate([column[~chosen], col[on]]), np.concatenate([size[~chosen], count[on]])
        return scores, ids


def rank(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, key, score): the k best documents of each item with a score above 0."""
    asked = items.select(F.col(item).cast("long").alias("id"), F.col(item_text).cast("string").alias("t")).distinct()
    blocks = asked.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0] // BLOCK_BYTES + 1
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == block)
        table = Items(sorted(((r["id"], r["t"]) for r in mine.collect()), key=repr))  # about BLOCK_BYTES
        ranked = _rank_block(docs, table, k, key, text, item)
        found = ranked if found is None else found.unionAll(ranked)
    return found


def _rank_block(docs: DataFrame, table: Items, k: int, key: str, text: str, item: str) -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(table)
    listed = staged(postings(docs, sent, key, text))
    facts = listed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = facts["n"], facts["l"]
    df = frequencies(listed, len(table.words))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    row_of = np.empty(len(df), np.int64)
    row_of[np.argsort(weight, kind="stable")] = np.arange(len(df))
    weights = spark.sparkContext.broadcast((weight, row_of))

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, row_of = weights.value
        items = sent.value
        rows = [row_of[t[weight[t] > 0]] for t in items.terms]
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(rows)
        for batch in _ranges(stream):
            ids, n = batch["id"].to_numpy(), batch["n"].to_numpy()
            order = np.argsort(n, kind="stable")
            column_of = np.empty(len(ids), np.int64)
            column_of[order] = np.arange(len(ids))
            per_row = batch["terms"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(ids)), per_row)
            term = batch["terms"].combine_chunks().flatten().to_numpy().astype(np.int64)
            count = batch["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
            m = 100 - 90 + (90 * n[doc] * n_docs) // max(1, n_terms)
            impact = weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m))
            some = impact > 0
            grid = Treap(row_of[term[some]], column_of[doc[some]], impact[some], ids[order])
            best = [grid.search(r, k, b) for r, b in zip(rows, best)]
        number = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
        yield pa.RecordBatch.from_arrays([
            pa.array(number.astype(np.int32)), pa.array(np.concatenate([none, *[i for _, i in best]])), pa.array(np.concatenate([none, *[s for s, _ in best]])),
        ], ["number", key, "score"])

    entries = listed.mapInArrow(task, f"number int, `{key}` long, score long")
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col(key))
    ranked = entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(table.ids)), f"number int, `{item}` long")
    return ranked.join(F.broadcast(names), "number").select(item, "rank", key, "score")


def _ranges(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of RANGE rows; the last one may be shorter."""
    waiting, rows = [], 0
    for batch in stream:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, RANGE - rows)
            waiting.append(part)
            rows += part.num_rows
            at += part.num_rows
            if rows == RANGE:
                yield pa.Table.from_batches(waiting)
                waiting, rows = [], 0
    if rows:
        yield pa.Table.from_batches(waiting)
