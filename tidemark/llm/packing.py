"""Best-fit packing: pattern packing by non-negative least squares.

Documents become token ids and an end id (0). Longer ones are cut into pieces of the capacity, the first piece taking
what does not divide. The histogram of piece lengths has at most `capacity` entries whatever the corpus, and the
packing is planned on it:

1. patterns of one, two or three lengths that fill a sequence as far as present lengths can;
2. repeat counts by non-negative least squares against the histogram, weighted by length;
3. counts rounded, largest first, within what the histogram still holds;
4. what is left packed best-fit decreasing, many equal pieces per step.

Pieces then take their places by rank: the n-th piece of a length goes to the n-th place that the plan has for that length.
A piece's rank is its number among its length within its part (given when the pieces are written) plus the counts
of the parts before, so no task sees all pieces of a length.

Null and empty texts are one piece of the end id alone. Equal rows are packed one by one. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import bytewise
from tidemark.llm.staging import small_batches, staged

CAPACITY = 2048
END_ID = 0
CACHED_UNITS = 300_000  # units whose ids a worker keeps
TOKEN_SLICE = 2 << 20  # bytes of text encoded together; a worker holds some 30 bytes a byte of it
THIRD_LENGTHS = 24  # second lengths tried in patterns of three


# --- tokens -----------------------------------------------------------------------------------------


class Encoder:
    """Ids of whole texts, each distinct unit encoded once.

    A unit is a run of white space and what follows up to the next one. The tokenizer's own splitting always breaks
    between a character that is no white space and an ASCII space, so ids of units in a row are the ids of
    the text. Units of ASCII and Latin-1 letters go through the byte-pair ranks of the vocabulary file; units
    with other bytes go to the library that the file is made for. Special tokens' strings are ordinary text.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        special = {t["content"] for t in stored["added_tokens"]}
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=_pattern(), special_tokens={},
            mergeable_ranks={_bytes(t): i for t, i in stored["model"]["vocab"].items() if t not in special},
        )
        self.known: dict[int, bytes] = {}

    def unit(self, raw: bytes) -> bytes:
        text = raw.decode("utf-8")
        if max(raw, default=0) < 0xC4 and b"\xc2" not in raw:
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in a row, and how many each row has."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(rows, np.int64)
        space = bytewise.SPACE[data]
        before = np.empty(len(data), np.uint8)
        before[0], before[1:] = 32, data[:-1]
        lead = np.empty(len(data), np.uint8)
        lead[:2], lead[2:] = 32, data[:-2]
        plain = ((before > 32) & (before < 127)) | ((lead == 0xC3) & (before >= 0x80))
        opens = space & plain
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(opens)
        end = np.append(start[1:], len(data))
        spans = bytewise.Spans(start, end, np.searchsorted(offsets, start, "right") - 1)
        keys = bytewise.mixed(spans.hashes(data) + (end - start).astype(np.uint64))
        key, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        whole, known, found = data.tobytes(), self.known, []
        if len(known) > CACHED_UNITS:
            known.clear()
        for k, a, b in zip(key.tolist(), start[first].tolist(), end[first].tolist()):
            ids = known.get(k)
            if ids is None:
                ids = known[k] = self.unit(whole[a:b])
            found.append(ids)
        pool = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        place = np.cumsum(size) - size
        per_unit = size[inverse]
        ids = pool[bytewise.ranges(place[inverse], per_unit)]
        return ids, np.bincount(spans.row, weights=per_unit, minlength=rows).astype(np.int64)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _bytes(token: str) -> bytes:
    """The bytes that a byte-level vocabulary writes as printable characters."""
    if not _unprintable:
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        _unprintable.update({chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)})
    return bytes(_unprintable[c] for c in token)


_unprintable: dict[str, int] = {}
_encoders: dict[str, Encoder] = {}

PIECES = "key long, piece int, start long, length int, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece; `part` and `nth` number the pieces of a length within a task. Write before use."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(tokenizer)
        if encoder is None:
            encoder = _encoders[tokenizer] = Encoder(tokenizer)
        pa.default_memory_pool().release_unused()  # a worker may hold what the steps before had in use
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in stream:
            data, offsets = bytewise.flat(batch.column(1))
            for a, b in bytewise.slices(offsets, TOKEN_SLICE):
                own = offsets[a: b + 1] - offsets[a]
                ids, count = encoder.encode(data[offsets[a]: offsets[b]], own)
                yield _cut(batch.column(0).slice(a, b - a), ids, count, capacity, part, seen, keep_ids)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(task, PIECES + (", ids array<int>" if keep_ids else "")).withColumnRenamed("key", key)


def _cut(keys, ids, count, capacity, part, seen, keep_ids) -> pa.RecordBatch:
    length = count + 1
    n = (length + capacity - 1) // capacity
    row = np.repeat(np.arange(len(n)), n)
    piece = bytewise.ranges(np.zeros(len(n), np.int64), n)
    head = length - (n - 1) * capacity  # the first piece
    start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
    size = np.where(piece == 0, head[row], capacity)
    full = np.zeros(int(length.sum()), "<u4")
    begin = np.cumsum(length) - length
    full[bytewise.ranges(begin, count)] = ids
    full[begin + count] = END_ID
    at = begin[row] + start
    raw = memoryview(full).cast("B")
    crc = np.fromiter((zlib.crc32(raw[4 * a: 4 * (a + b)]) for a, b in zip(at.tolist(), size.tolist())), np.int64, len(at))
    order = np.argsort(size, kind="stable")
    inside = np.arange(len(size)) - np.searchsorted(size[order], size[order])
    nth = np.empty(len(size), np.int64)
    nth[order] = seen[size[order]] + inside
    seen += np.bincount(size, minlength=len(seen))
    columns = [keys.take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size.astype(np.int32)),
               pa.array(crc), pa.array(np.full(len(size), part, np.int32)), pa.array(nth)]
    names = ["key", "piece", "start", "length", "ids_crc32", "part", "nth"]
    if keep_ids:
        columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(full)).astype(np.int32)), pa.array(full.astype(np.int32))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


# --- plan -------------------------------------------------------------------------------------------


def patterns(lengths: np.ndarray, capacity: int, counts: np.ndarray) -> np.ndarray:
    """Rows of up to three indexes into `lengths` (sorted; -1: none), each filling a sequence as far as it can."""

    def largest(room: np.ndarray) -> np.ndarray:
        return np.searchsorted(lengths, room, "right") - 1

    alone = np.arange(len(lengths))
    pair = np.stack([alone, largest(capacity - lengths), np.full(len(alone), -1)], axis=1)
    spread = np.cumsum(counts) / counts.sum()
    second = np.unique(np.searchsorted(spread, (np.arange(THIRD_LENGTHS) + 0.5) / THIRD_LENGTHS).clip(0, len(lengths) - 1))
    a, b = (x.ravel() for x in np.meshgrid(alone, second, indexing="ij"))
    fits = lengths[a] + lengths[b] <= capacity
    a, b = a[fits], b[fits]
    triple = np.stack([a, b, largest(capacity - lengths[a] - lengths[b])], axis=1)
    return np.unique(np.sort(np.concatenate([pair, triple]), axis=1), axis=0)


def nonnegative_fit(members: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 with the least sum of (weight * (lengths used by x - target))^2.

    Projected gradient steps with momentum, restarted when the momentum points uphill.
    """
    used = members >= 0
    at = np.where(used, members, 0)
    n = len(target)

    def lengths_used(x: np.ndarray) -> np.ndarray:
        return np.bincount(at.ravel(), weights=(used * x[:, None]).ravel(), minlength=n)

    def gradient(x: np.ndarray) -> np.ndarray:
        miss = weight**2 * (lengths_used(x) - target)
        return (miss[at] * used).sum(axis=1)

    v = np.ones(len(members))
    for _ in range(20):
        v = (((weight**2 * lengths_used(v))[at]) * used).sum(axis=1)
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (1.05 * size)
    x = y = np.zeros(len(members))
    t = 1.0
    for _ in range(rounds):
        g = gradient(y)
        after = np.maximum(y - step * g, 0)
        if (g * (after - x)).sum() > 0:
            t = 1.0
        t_after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: (lengths in a sequence, how many such sequences)."""
    open_: dict[int, list[list]] = {}  # free space -> groups [lengths, count]
    spaces: list[int] = []

    def put(space: int, inside: tuple[int, ...], count: int) -> None:
        if space not in open_:
            open_[space] = []
            insort(spaces, space)
        open_[space].append([inside, count])

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            k = bisect_left(spaces, length)
            if k == len(spaces):
                most = capacity // length
                if count >= most:
                    put(capacity - most * length, (length,) * most, count // most)
                if count % most:
                    put(capacity - count % most * length, (length,) * (count % most), 1)
                break
            space = spaces[k]
            group = open_[space][-1]
            took = min(count, group[1])
            group[1] -= took
            count -= took
            if not group[1]:
                open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    spaces.pop(k)
            put(space - length, (*group[0], length), took)
    return [(inside, n) for groups in open_.values() for inside, n in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences); uses every piece of the histogram once."""
    left = {k: n for k, n in histogram.items() if n}
    out = []
    if full := left.pop(capacity, 0):
        out.append(((capacity,), full))
    if left:
        lengths = np.array(sorted(left))
        counts = np.array([left[k] for k in lengths.tolist()], float)
        members = patterns(lengths, capacity, counts)
        x = nonnegative_fit(members, counts, lengths / capacity)
        for k in np.argsort(-x, kind="stable").tolist():
            want = int(x[k] + 0.5)
            if not want:
                break
            inside = [int(lengths[m]) for m in members[k] if m >= 0]
            times = min(want, *(left[m] // inside.count(m) for m in inside))
            if times:
                out.append((tuple(sorted(inside, reverse=True)), times))
                for m in inside:
                    left[m] -= times
    return out + best_fit({k: n for k, n in left.items() if n}, capacity)


# --- places -----------------------------------------------------------------------------------------


def _places(made: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Per length, runs of places: (length << 40 | first rank), sequence of that rank, offset in it. Sorted."""
    runs, taken, sequence = [], {}, 0
    for inside, times in made:
        offset = 0
        for length in inside:
            first = taken.get(length, 0)
            runs.append((length << 40 | first, sequence, offset))
            taken[length] = first + times
            offset += length
        sequence += times
    table = np.array(sorted(runs), np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces with their sequence and offset. The plan has at most a few places per length and pattern, so what
    is sent to the tasks is bounded by the capacity and not by the corpus."""
    with small_batches(docs.sparkSession):
        cut = staged(pieces(docs, tokenizer, key, text, capacity, keep_ids))
    counted = staged(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    first_rank, sequence, offset = _places(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = cut.join(ahead, ["part", "length"]).withColumn("rank", F.col("ahead") + F.col("nth"))
    names = [key, "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy().astype(np.int64)
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            k = np.searchsorted(first_rank, length << 40 | rank, "right") - 1
            own = sequence[k] + rank - (first_rank[k] & ((1 << 40) - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(own), pa.array(offset[k])], [*names, "sequence_id", "offset"]
            )

    chosen = ranked.select(*names, "rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[: len(names)])
    return chosen.mapInArrow(task, f"{fields}, sequence_id long, offset long")
