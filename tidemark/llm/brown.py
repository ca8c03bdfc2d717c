"""Language-model scores by a Brown class-based bigram model.

Tokens: words `[^\\x20\\x09-\\x0D]+` of the A-Z-lowered text, then one end per text. The model is
P(w | before) = P(class(w) | class(before)) * P(w | class(w)).

Classes: the `VOCABULARY` most frequent training words are put into `CLASSES` classes by exchange clustering: each word in turn goes
to the class that raises the likelihood of the class bigrams most, until a sweep moves none. Every other word seen twice or more then
goes to the class of the largest gain, by its counts with the classes of its neighbours, or stays in the
class of its frequency (counts 1, 2-3, 4-7, ...) where none gains. The end is a class of its own, and words unseen in training are one
more word of the class of words seen once. So a word seen once stays there: with its text left out it is an unseen word, whatever class it has, and
its class is what unseen words are judged by. Counts cover all training texts.

Smoothing: emission (c + 1) / (N_class + V_class), with one more word in the class of words seen once; transitions mix the counts with
`PRIOR` pseudo-counts of the classes' own shares. With infinite prior the model is the add-one base exactly.

Steps: texts are tokenized once, in blocks of bounded size, each with its distinct words (64-bit keys). Blocks
send each distinct word once to the part that counts it and get all counts back; then they count pairs of
units (clustered words and frequency classes: a bounded number), which each task adds up before Spark sums them and the driver
clusters. The `FURTHER` next words' pairs with units become pairs with classes in the tasks, Spark sums them (words x classes), and the driver
places these words. The rest is placed where it was counted: blocks send its pairs with units to the words' parts and get classes back. With all
classes known the class pairs are counted in one more pass; last, blocks score their texts.

Null and empty texts are one end token. Equal rows score alike. Without training tokens the vocabulary is empty and all tokens are unseen.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytewise
from tidemark.llm.staging import staged, total_bytes

VOCABULARY = 1000
FURTHER = 20_000  # words placed by the driver; tasks place the rest
CLASSES = 48
PRIOR = 20.0
BLOCK_BYTES = 8 << 20  # text tokenized as one block
PART_BYTES = 8 << 20  # text that one part's words come from, on average
SLAB = 1 << 14  # pairs of words and classes weighed at a time
BANDS = 63  # classes by frequency: floor(log2(count))
END = 0  # the end token's key


def pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], "<i8")
    return zstandard.compress(sizes.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 3)


def unpack(raw: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.decompress(raw)
    sizes = np.frombuffer(raw, "<i8", len(types))
    at = 8 * len(types) + np.cumsum(sizes) - sizes
    return [np.frombuffer(raw, t, int(n) // np.dtype(t).itemsize, int(a)) for t, n, a in zip(types, sizes, at)]


TEXTS = ("<i8", "u1", "u1", "<i4", "<u4")  # key, key is valid, training, tokens, the tokens' places among the block's words
WORDS = ("<u8", "<i4")  # keys, most frequent first; count in training texts
ANSWER = ("<i8", "<u4")  # count and number in its part of each word
UNITS = ("<u2", "<i8", "<u4")  # unit (later: class) and count of each word; which words are of the rest, part by part
REST = ("<u4", "<u4", "<u4", "<u4")  # number in its part and pairs of each word of the rest; each pair's side x units + unit, and its count


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all tokens in a row, ends included, and how many each row has."""
    keys, counts = [], []
    for a, b in bytewise.slices(offsets):
        low = bytewise.LOWER[data[offsets[a]: offsets[b]]]
        own = offsets[a: b + 1] - offsets[a]
        spans = bytewise.words(low, own, ~bytewise.SPACE[low])
        n = np.bincount(spans.row, minlength=b - a)
        out = np.full(len(spans) + b - a, END, np.uint64)
        out[np.arange(len(spans)) + spans.row] = np.maximum(spans.hashes(low), np.uint64(1)) if len(spans) else []
        keys.append(out)
        counts.append(n + 1)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(counts)


def blocks(docs: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    """Blocks of tokenized texts: (block, texts, words)."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in stream:
            data, offsets = bytewise.flat(batch.column(2))
            for a, b in bytewise.slices(offsets, BLOCK_BYTES):
                token, count = tokens(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                ids = batch.column(0).slice(a, b - a)
                trains = batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.uint8)
                word, place, often = np.unique(token, return_inverse=True, return_counts=True)
                order = np.argsort(-often, kind="stable")  # small numbers for frequent words, which pack well
                number = np.empty(len(order), np.int64)
                number[order] = np.arange(len(order))
                word, place = word[order], number[place]
                learnt = np.bincount(place[np.repeat(trains, count) == 1], minlength=len(word))
                texts = pack(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), ids.is_valid().to_numpy(zero_copy_only=False).astype("u1"),
                             trains, count.astype("<i4"), place.astype("<u4"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | made]), pa.array([texts], pa.binary()), pa.array([pack(word.astype("<u8"), learnt.astype("<i4"))], pa.binary())],
                    ["block", "texts", "words"],
                )
                made += 1

    rows = docs.select(F.col(key).cast("long"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text))
    return rows.mapInArrow(task, "block long, texts binary, words binary")


COUNTED = "kind int, to long, by int, payload binary, more binary, a long, b long"


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
    names = ("kind", "to", "by", "payload", "more", "a", "b")
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(names, kinds))})


def _band(count: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(count, 1)).astype(np.int64)


def count_words(made: DataFrame, parts: int, vocabulary: int) -> DataFrame:
    """Rows by kind. 1: counts and numbers for block `to`, of its words in part `by`. 0: tokens and words of a part. 2: a frequent word and
    its count. 5: a band and its number of words.
    6: counts of further words' neighbours (in `score`). 7: the end's count. 8: counts of the neighbours of the rest of block `to`, for part `by`; and from there,
    in `place_rest`, their classes."""

    def send(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                word, learnt = unpack(raw, *WORDS)
                part = word % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                edge = np.searchsorted(part[order], np.arange(parts + 1))
                some = np.flatnonzero(np.diff(edge))
                yield pa.RecordBatch.from_arrays([
                    pa.array(some.astype(np.int32)), pa.array(np.full(len(some), block)),
                    pa.array([pack(word[order[edge[p]: edge[p + 1]]], learnt[order[edge[p]: edge[p + 1]]]) for p in some], pa.binary()),
                ], ["part", "block", "payload"])

    def count(table: pa.Table) -> pa.Table:
        part, block = table["part"][0].as_py(), table["block"].to_pylist()
        got = [unpack(p, *WORDS) for p in table["payload"].to_pylist()]
        word, place = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([g[1] for g in got]), minlength=len(word)).astype(np.int64)
        rows, at = [(0, None, part, None, None, int(total.sum()), int((total > 0).sum()))], 0
        for b, g in zip(block, got):
            own = place[at: at + len(g[0])]
            rows.append((1, b, part, pack(total[own].astype("<i8"), own.astype("<u4")), None, None, None))
            at += len(g[0])
        top = np.lexsort((word, -total))[: vocabulary + 1]
        rows += [(2, None, part, None, None, int(w), int(n)) for w, n in zip(word[top].view(np.int64), total[top]) if n > 0 and w != END]
        rows += [(7, None, part, None, None, END, int(n)) for n in total[word == END] if n]
        rows += [(5, None, part, None, None, k, int(n)) for k, n in enumerate(np.bincount(_band(total[total > 0]), minlength=BANDS)) if n]
        return _rows(rows)

    sent = made.select("block", "words").mapInArrow(send, "part int, block long, payload binary")
    return sent.groupBy("part").applyInArrow(count, COUNTED)


# --- classes ----------------------------------------------------------------------------------------


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, words: int, classes: int, sweeps: int | None = None) -> np.ndarray:
    """The class of each unit, from the matrix of unit pair counts (before, after).

    Units below `words` are exchanged among `classes` classes; every later unit keeps a class of its own. A word's move changes
    the sum of n log n over class pairs, less the sums over the classes' margins; it goes where that is largest, its own class on ties.
    The sweeps go on until one moves no word, or for `sweeps` of them. Each move raises the likelihood, so they end.
    """
    units = len(pairs)
    of = np.concatenate([np.arange(words) % classes, classes + np.arange(units - words)])
    total = classes + units - words
    member = np.zeros((units, total))
    member[np.arange(units), of] = 1
    right = pairs @ member  # word before, class after
    left = pairs.T @ member  # word after, class before
    table = member.T @ right
    before, after = table.sum(axis=1), table.sum(axis=0)
    n_before, n_after = pairs.sum(axis=1), pairs.sum(axis=0)
    k = np.arange(classes)
    for _ in itertools.count() if sweeps is None else range(sweeps):
        moved = 0
        for w in np.argsort(-(n_before + n_after)[:words], kind="stable"):
            own, self_ = of[w], pairs[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[own] -= self_
            l[own] -= self_
            table[own] -= r
            table[:, own] -= l
            table[own, own] -= self_
            before[own] -= n_before[w]
            after[own] -= n_after[w]
            gain = (_xlogx(table[:classes] + r) - _xlogx(table[:classes])).sum(axis=1)
            gain += (_xlogx(table[:, :classes] + l[:, None]) - _xlogx(table[:, :classes])).sum(axis=0)
            at = table[k, k]  # the cell that both sums change
            gain += _xlogx(at + r[:classes] + l[:classes] + self_) - _xlogx(at + r[:classes]) - _xlogx(at + l[:classes]) + _xlogx(at)
            gain -= _xlogx(before[:classes] + n_before[w]) - _xlogx(before[:classes])
            gain -= _xlogx(after[:classes] + n_after[w]) - _xlogx(after[:classes])
            new = int(np.argmax(gain))
            if gain[new] <= gain[own] + 1e-9:
                new = own
            table[new] += r
            table[:, new] += l
            table[new, new] += self_
            before[new] += n_before[w]
            after[new] += n_after[w]
            if new != own:
                of[w] = new
                moved += 1
                right[:, own] -= pairs[:, w]
                right[:, new] += pairs[:, w]
                left[:, own] -= pairs[w]
                left[:, new] += pairs[w]
        if not moved:
            break
    return of


class Model:
    """What scoring needs: the class of each unit, class transitions, and emission denominators."""

    def __init__(self, of: np.ndarray, transition: np.ndarray, emission: np.ndarray, classes: int, tokens_: int, words_: int):
        self.of, self.transition, self.emission = of, transition, emission
        self.classes, self.tokens, self.words = classes, tokens_, words_

    def scores(self, cls: np.ndarray, count: np.ndarray, place: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, ...]:
        """Known tokens, base score and model score of each text; all in log10."""
        first = np.cumsum(per_text) - per_text
        base = np.log10((count + 1) / (self.tokens + self.words + 1))
        emit = np.log10(count + 1) - np.log10(self.emission[cls])
        after = cls[place]
        before = np.empty(len(place), np.int64)
        before[1:] = after[:-1]
        before[first] = self.of[-1]
        value = self.transition[before, after] + emit[place]
        return tuple(np.add.reduceat(x, first) for x in ((count > 0)[place].astype(np.int64), base[place], value))


def units_of(word: np.ndarray, count: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The unit of each word: its place among the frequent words, or its band, or the end (the last unit)."""
    unit = len(frequent) + _band(count)
    if len(frequent):
        at = np.searchsorted(frequent, word).clip(0, len(frequent) - 1)
        unit = np.where(frequent[at] == word, at, unit)
    return np.where((word == END) & (count > 0), len(frequent) + BANDS, unit)


def task_pairs(packed: DataFrame, units: int) -> DataFrame:
    """(pair, n): the blocks' unit pair counts (`payload`), added up in each task; a task holds one table of all pairs of units."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(units * units, np.int64)
        for batch in stream:
            for raw in batch.column(0):
                both, n = unpack(raw.as_py(), "<i8", "<i8")
                table[both] += n
        yield from _sparse(table)

    return packed.select("payload").mapInArrow(task, "pair long, n long")


def _sparse(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    some = np.flatnonzero(table)
    for at in range(0, len(some), 1 << 16):
        pair = some[at: at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(table[pair])], ["pair", "n"])


def _dense(pairs: DataFrame, size: int) -> np.ndarray:
    sums = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return out


def task_contexts(packed: DataFrame, units: int, of: np.ndarray, classes: int, words: int) -> DataFrame:
    """(pair, n): how often each class comes before (side 0) and after (side 1) each further word; pair = (2 word + side) x classes + class."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 * words * classes, np.int64)
        for batch in stream:
            for raw in batch.column(0):
                both, n = unpack(raw.as_py(), "<i8", "<i8")
                np.add.at(table, both // units * classes + of[both % units], n)
        yield from _sparse(table)

    return packed.select("payload").mapInArrow(task, "pair long, n long")


def task_class_pairs(packed: DataFrame, end: int, classes: int) -> DataFrame:
    """(pair, n): class pairs of all training tokens."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(classes * classes, np.int64)
        for batch in stream:
            for words, texts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cls = unpack(words, *UNITS)[0]
                _, _, trains, per_text, place = unpack(texts, *TEXTS)
                after, before = _chain(cls[place], per_text, end)
                learnt = np.repeat(trains, per_text) == 1
                table += np.bincount(before[learnt] * classes + after[learnt], minlength=classes * classes)
        yield from _sparse(table)

    return packed.select("payload", "more").mapInArrow(task, "pair long, n long")


def _chain(after: np.ndarray, per_text: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's value and its predecessor's; before a text's first token comes the end."""
    before = np.empty(len(after), np.int64)
    before[1:] = after[:-1]
    before[np.cumsum(per_text) - per_text] = end
    return after.astype(np.int64), before


def place_further(table: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, classes: int) -> np.ndarray:
    """The class of each further word: the one of the first `classes` that gains most by taking it, or its own where it is.

    `left` and `right`: counts of each class before and after the word (rows). The gain is the change of the sum of n log n over
    class pairs less those of the margins, each word for itself against the clustered table.
    """
    word, side, cls = np.nonzero(np.stack([left, right], axis=1))
    return place_words(table, word, side, cls, np.where(side, right[word, cls], left[word, cls]), own, classes)


def place_words(
    table: np.ndarray, word: np.ndarray, side: np.ndarray, cls: np.ndarray, n: np.ndarray, own: np.ndarray, classes: int
) -> np.ndarray:
    """`place_further` from the counts that are not zero: class `cls` is `n` times before (side 0) or after (side 1) `word`; words ascend."""
    table = table.astype(float)
    before, after = table.sum(axis=1), table.sum(axis=0)
    margins = _xlogx(before) + _xlogx(after)
    sides = np.stack([table, table.T])  # [side, class beside the word, class of the word]
    now = _xlogx(sides)
    out, at = own.copy(), 0
    ends = np.searchsorted(word, np.arange(len(own)), "right")
    while at < len(own):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLAB, "right")))
        stop = min(stop, at + SLAB)
        some = slice(ends[at - 1] if at else 0, ends[stop - 1])
        w, s, c, k, home = word[some] - at, side[some], cls[some], n[some].astype(float), own[at:stop]
        size = stop - at
        as_after, as_before = (np.bincount(w[s == x], weights=k[s == x], minlength=size) for x in (0, 1))
        gain = np.zeros((size, classes))
        each = _xlogx(sides[s, c, :classes] + k[:, None]) - now[s, c, :classes]
        first = np.flatnonzero(np.diff(w, prepend=-1))
        if len(first):
            gain[w[first]] = np.add.reduceat(each, first, axis=0)
        gain -= _xlogx(before[:classes] + as_before[:, None]) + _xlogx(after[:classes] + as_after[:, None]) - margins[:classes]
        rest = np.maximum(sides[s, c, home[w]] - k, 0)
        stay = np.bincount(w, weights=now[s, c, home[w]] - _xlogx(rest), minlength=size)
        stay -= margins[home] - _xlogx(np.maximum(before[home] - as_before, 0)) - _xlogx(np.maximum(after[home] - as_after, 0))
        best = gain.argmax(axis=1)
        moves = gain[np.arange(size), best] > stay + 1e-9
        out[at:stop] = np.where(moves, best, home)
        at = stop
    return out


def place_rest(packed: DataFrame, table: np.ndarray, clustered: np.ndarray, classes: int) -> DataFrame:
    """From rows of kind 8 those of the classes of the rest. 8: for block `to`, of its words in part `by`. 5: a class and its number of these words."""
    units, total = len(clustered), len(table)

    def place(rows: pa.Table) -> pa.Table:
        part, block = rows["by"][0].as_py(), rows["to"].to_pylist()
        got = [unpack(p, *REST) for p in rows["payload"].to_pylist()]
        word, at = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        code, n = (np.concatenate([g[x] for g in got]).astype(np.int64) for x in (2, 3))
        keys = (np.repeat(at, np.concatenate([g[1] for g in got])) * 2 + code // units) * total + clustered[code % units]
        key, where = np.unique(keys, return_inverse=True)
        sums = np.bincount(where, weights=n, minlength=len(key)).astype(np.int64)
        of, side, cls = key // (2 * total), key // total % 2, key % total
        count = np.bincount(of[side == 0], weights=sums[side == 0], minlength=len(word))
        found = place_words(table, of, side, cls, sums, classes + _band(count), classes)
        out, begin = [], 0
        for b, g in zip(block, got):
            out.append((8, b, part, pack(found[at[begin: begin + len(g[0])]].astype("<u2")), None, None, None))
            begin += len(g[0])
        return _rows(out + [(5, None, part, None, None, c, int(m)) for c, m in enumerate(np.bincount(found)) if m])

    return packed.select("to", "by", "payload").groupBy("by").applyInArrow(place, COUNTED)


def fit(table: np.ndarray, frequent: np.ndarray, of: np.ndarray, classes: int, tokens_: int, words_: int, types: np.ndarray, prior: float = PRIOR) -> Model:
    """The model from class pair counts. `of`: the class of each unit; `types`: words of each class that are not frequent words."""
    n = table.sum(axis=0)
    v = np.bincount(of[: len(frequent)], minlength=len(table)).astype(float) + types
    v[-1] += 1 if tokens_ else 0
    once = classes  # the class of words seen once; the unseen word is one more of it
    emission = n + v
    emission[once] += 1
    share = emission / (tokens_ + words_ + 1)
    with np.errstate(divide="ignore"):
        transition = np.log10((table + prior * share[None, :]) / (table.sum(axis=1, keepdims=True) + prior))
    emission = np.maximum(emission, 1)
    return Model(of, transition, emission, classes, tokens_, words_)


# --- the whole job ----------------------------------------------------------------------------------


def score(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, classes: int = CLASSES,
    prior: float = PRIOR, further: int = FURTHER,
) -> DataFrame:
    """(key, train, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Without further words (0) those beyond the vocabulary stay in the classes of their frequency.
    """
    parts = total_bytes(docs, text) // PART_BYTES + 1
    made = staged(blocks(docs, train, key, text))
    counted = staged(count_words(made, parts, vocabulary + further))
    sums = counted.where("kind = 0").agg(F.sum("a").alias("n"), F.sum("b").alias("v")).first()
    tokens_, words_ = sums["n"] or 0, sums["v"] or 0
    top = counted.where("kind = 2").orderBy(F.col("b").desc(), "a").limit(vocabulary + further).select("a", "b").collect()
    ranked = [(np.uint64(r["a"] & (2**64 - 1)), r["b"], k < vocabulary) for k, r in enumerate(top)]
    ranked.sort()
    frequent = np.array([w for w, _, _ in ranked], np.uint64)
    core = np.array([c for _, _, c in ranked], bool)
    band = _band(np.array([n for _, n, _ in ranked], np.int64))
    types = np.zeros(BANDS, np.int64)
    for r in counted.where("kind = 5").groupBy("a").agg(F.sum("b").alias("n")).collect():
        types[r["a"]] = r["n"]
    types -= np.bincount(band, minlength=BANDS)
    if ends := counted.where("kind = 7").select("b").collect():
        types[_band(np.array([ends[0]["b"]]))[0]] -= 1
    # units: the frequent words, the bands, the end. Clustering sees the core words as they are and the further ones as their bands
    n_core, n_further = int(core.sum()), int((~core).sum())
    coarse_units = n_core + BANDS + 1
    coarse = np.concatenate([np.where(core, np.cumsum(core) - 1, n_core + band), n_core + np.arange(BANDS + 1)]).astype(np.int64)
    further_place = np.full(len(coarse), -1)
    further_place[: len(core)][~core] = np.arange(n_further)

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        answers = dict(zip(right["by"].to_pylist(), right["payload"].to_pylist()))
        for block, texts, words in zip(*(left[c].to_pylist() for c in ("block", "texts", "words"))):
            word, _ = unpack(words, *WORDS)
            part = word % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            count, number = np.empty(len(word), np.int64), np.empty(len(word), np.int64)
            got = [unpack(answers[p], *ANSWER) for p in sorted(answers)]
            count[order], number[order] = (np.concatenate([g[x] for g in got]) for x in (0, 1))
            _, _, trains, per_text, place = unpack(texts, *TEXTS)
            unit = units_of(word, count, frequent)
            after, before = _chain(unit[place], per_text, len(coarse) - 1)
            learnt = np.repeat(trains, per_text) == 1
            after, before = after[learnt], before[learnt]
            counts = [(3, coarse[before] * coarse_units + coarse[after])]
            entries = []
            for side, own, other in ((0, after, before), (1, before, after)):
                mine = np.flatnonzero(further_place[own] >= 0)
                entries.append((2 * further_place[own[mine]] + side) * coarse_units + coarse[other[mine]])
            counts.append((6, np.concatenate(entries)))
            for kind, pairs in counts:
                both, n = np.unique(pairs, return_counts=True)
                if len(both):
                    rows.append((kind, block, None, pack(both.astype("<i8"), n.astype("<i8")), None, None, None))
            rest = order[(unit[order] >= len(frequent)) & (unit[order] < len(frequent) + BANDS) & (count[order] > 1)] if further else order[:0]
            rank = np.full(len(word) + 1, -1)  # the last is for the end before a text
            rank[rest] = np.arange(len(rest))
            own_after, own_before = (rank[x[learnt]] for x in _chain(place, per_text, len(word)))
            entries = [
                (2 * own[own >= 0] + side) * coarse_units + coarse[other[own >= 0]] for side, own, other in ((0, own_after, before), (1, own_before, after))
            ]
            both, n = np.unique(np.concatenate(entries), return_counts=True)
            edge = np.searchsorted(part[rest], np.arange(parts + 1))
            pairs_edge = np.searchsorted(both, edge * 2 * coarse_units)
            per_word = np.bincount(both // (2 * coarse_units), minlength=len(rest))
            for p in np.flatnonzero(np.diff(edge)):
                words_, pairs_ = slice(edge[p], edge[p + 1]), slice(pairs_edge[p], pairs_edge[p + 1])
                rows.append((8, block, int(p), pack(
                    number[rest[words_]].astype("<u4"), per_word[words_].astype("<u4"), (both[pairs_] % (2 * coarse_units)).astype("<u4"), n[pairs_].astype("<u4"),
                ), None, None, None))
            rows.append((4, block, None, pack(unit.astype("<u2"), count.astype("<i8"), rest.astype("<u4")), None, None, None))
        return _rows(rows)

    answers = counted.where("kind = 1").select(F.col("to").alias("block"), "by", "payload")
    paired = staged(made.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(pair, COUNTED))
    pairs = _dense(task_pairs(paired.where("kind = 3"), coarse_units), coarse_units**2).reshape(coarse_units, coarse_units)
    classes = min(classes, max(1, n_core))
    clustered = exchange(pairs.astype(float), n_core, classes)
    total = classes + BANDS + 1
    of = clustered[coarse]
    by_class = np.concatenate([np.zeros(classes, np.int64), types, np.zeros(1, np.int64)])
    known = paired.where("kind = 4")
    if further:
        member = np.zeros((coarse_units, total))
        member[np.arange(coarse_units), clustered] = 1
        class_pairs = member.T @ pairs @ member
        rest = staged(place_rest(paired.where("kind = 8"), class_pairs, clustered, classes))
        by_class[classes + 1:] = 0
        for r in rest.where("kind = 5").groupBy("a").agg(F.sum("b").alias("n")).collect():
            by_class[r["a"]] += r["n"]
        known = known.unionAll(rest.where("kind = 8"))
    if n_further:
        contexts = _dense(
            task_contexts(paired.where("kind = 6"), coarse_units, clustered, total, n_further), 2 * n_further * total
        ).reshape(n_further, 2, total)
        own = of[: len(core)][~core]
        placed = place_further(class_pairs, contexts[:, 0], contexts[:, 1], own, classes)
        of[: len(core)][~core] = np.where(band[~core] > 0, placed, own)

    def classed(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, answers = [], dict(zip(right["by"].to_pylist(), right["payload"].to_pylist()))
        for block, texts in zip(left["block"].to_pylist(), left["texts"].to_pylist()):
            unit, count, rest = unpack(answers.pop(None), *UNITS)
            cls = of[unit]
            if answers:
                cls[rest] = np.concatenate([unpack(answers[p], "<u2")[0] for p in sorted(answers)])
            rows.append((4, block, None, pack(cls.astype("<u2"), count, rest[:0]), texts, None, None))
        return _rows(rows)

    known = known.select(F.col("to").alias("block"), "by", "payload")
    scored = staged(made.select("block", "texts").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(classed, COUNTED)).select("payload", "more")
    table = _dense(task_class_pairs(scored, int(of[-1]), total), total * total).reshape(total, total)
    model = docs.sparkSession.sparkContext.broadcast(fit(table, frequent, of, classes, tokens_, words_, by_class, prior))

    def value(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for words, texts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cls, count, _ = unpack(words, *UNITS)
                ids, valid, trains, per_text, place = unpack(texts, *TEXTS)
                known, base, own = model.value.scores(cls, count, place, per_text)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, mask=valid == 0), pa.array(trains == 1), pa.array(per_text.astype(np.int64)), pa.array(known),
                    pa.array(np.full(len(ids), tokens_)), pa.array(base), pa.array(own), pa.array(10 ** (-own / per_text)),
                ], ["key", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return scored.mapInArrow(
        value, "key long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    ).withColumnRenamed("key", key)
