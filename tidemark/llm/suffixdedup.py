"""Removal of repeated passages by blockwise suffix sorting with a difference cover.

A byte goes if it lies in a string of `span` (50) bytes that also begins in a row of a smaller key. All strings are judged
on the input, as UTF-8 bytes; matches never cross rows.

1. Screen. Every 50-byte string has an anchor, the smallest hash of its 20-byte strings; equal strings have equal anchors.
   Rows are dealt into chunks of bounded size. A chunk reports four bytes of each anchor once, and whether several keys have it.
   Anchors of one chunk and one key only cannot lie in a repeated string, and end here; the answer is a bit each. A second bit
   tells the hot anchors, around which there are more than `HOT_PIECES` distinct pieces (a short phrase amid different text).
2. Suffix sort. For the other anchors a chunk sends its distinct pieces: the bytes of all strings around one anchor. A part
   receives all pieces of its anchors, makes them one text, and finds its equal 50-byte strings as a suffix array
   construction does (Kaerkkaeinen, 2007): suffixes at the places of a difference cover modulo 7 are ranked first by 44 bytes;
   then one block of suffixes at a time, of neighbouring leading bytes, is sorted by those bytes, and ties are
   resolved by the cover ranks: any two suffixes reach the cover together within six steps. What the last steps do not cover is compared as bytes.
   Strings of hot anchors are sent one by one, to the part that a hash of all their bytes names, so equal ones still meet.
   Memory is bounded by the part and the block, not by the corpus.
3. Marks. A chunk gets back, for its pieces, the smallest key of each string, and marks the strings that a smaller key has.

A chunk sends each distinct anchor and piece once however often it holds it, so a passage in a third of all rows is one
record per chunk. Text is shuffled once; the three steps read the same exchange.

Null text reads as empty; rows shorter than a span lose nothing; a null key counts as larger than all others; rows of equal keys
do not remove from each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytewise
from tidemark.llm.staging import fresh, total_bytes

SPAN = 50
ANCHOR = 20
CHUNK_BYTES = 8 << 20  # text of one chunk, on average
PART_BYTES = 4 << 20  # text that one part's anchors come from, on average
BLOCK = 1 << 19  # suffixes sorted at a time
COVER, STEP = (0, 1, 3), 7  # every difference modulo 7 is one of two members
DEEP = SPAN - STEP + 1  # bytes that cover ranks compare
ANCHOR_SLICE = 1 << 17
HOT_PIECES = 4096  # distinct pieces of one anchor, summed over the chunks, that go to one part
COUNTED_USES = 16  # an anchor's pieces are told apart in a chunk that has it so often

Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def runs(data: np.ndarray, offsets: np.ndarray) -> Runs:
    """Runs of neighbouring spans with one anchor: row, first start, end of starts, anchor."""
    out: list[Runs] = []
    for a, b in bytewise.slices(offsets, ANCHOR_SLICE):
        base = int(offsets[a])
        own = offsets[a: b + 1] - base
        part = data[base: int(offsets[b])]
        if len(part) < SPAN:
            continue
        least = bytewise.sliding_min(bytewise.mixed(bytewise.rolling(part, ANCHOR)), SPAN - ANCHOR + 1)
        breaks = np.empty(len(least) + 1, bool)
        breaks[1:-1] = least[1:] != least[:-1]
        breaks[own[own <= len(least)]] = True
        breaks[0] = breaks[-1] = True
        at = np.flatnonzero(breaks)
        first, end = at[:-1], at[1:]
        row = np.searchsorted(own, first, "right") - 1
        end = np.minimum(end, own[row + 1] - SPAN + 1)
        good = end > first
        out.append((row[good] + a, first[good] + base, end[good] + base, least[first[good]]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def smallest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(values, first) if len(first) else values[:0]


def largest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(values, first) if len(first) else values[:0]


def counted(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    some = np.flatnonzero(np.diff(offsets))
    out = np.zeros(len(offsets) - 1, np.int64)
    if len(some):
        out[some] = np.add.reduceat(flags, offsets[some], dtype=np.int64)
    return out


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts the keys, and where each distinct key begins in it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    return order, np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(keys) else order


# --- the sort of one part ---------------------------------------------------------------------------


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place, as a number that sorts as they do; zeros follow the end."""
    w = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for n in (1, 2, 4):
        w = (w[:-n] << np.uint64(8 * n)) | w[n:]
    return w[: len(text)]


def cover_ranks(word: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The dense rank of the DEEP bytes from each place `at`; -1 elsewhere."""
    rank = np.full(len(word), -1, np.int64)
    if len(at):
        keys = [word[at + k] for k in (*range(0, DEEP - 8, 8), DEEP - 8)]
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), bool)
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        rank[at[order]] = np.cumsum(new)
    return rank


def least_owner(text: np.ndarray, lengths: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pieces laid end to end: the starts of all spans, and the smallest owner of each span's bytes."""
    begin = np.cumsum(lengths) - lengths
    inside = lengths - SPAN + 1
    start = bytewise.ranges(begin, inside)
    own = np.repeat(owner, inside)
    word = words(text)
    deep = bytewise.ranges(begin, lengths - DEEP + 1)
    rank = cover_ranks(word, deep[np.isin(deep % STEP, COVER)])
    head = word[start]
    best = own.copy()
    cuts = np.sort(head[:: max(1, len(head) // 4096)])
    blocks = len(head) // BLOCK + 1
    edges = np.unique(cuts[(np.arange(1, blocks) * len(cuts)) // blocks])  # leading bytes between the blocks
    block = np.searchsorted(edges, head, "right")
    for b in range(len(edges) + 1):
        mine = np.flatnonzero(block == b) if len(edges) else np.arange(len(head))
        _sort_block(word, rank, start, mine, own, best)
    return start, best


def _sort_block(word, rank, start, mine, own, best) -> None:
    """Sort the suffixes of one block; lower `best` to the smallest owner of equal spans."""
    order, first = grouped(word[start[mine]])
    size = np.diff(np.append(first, len(order)))
    tied = np.repeat(size > 1, size)
    mine, group = mine[order][tied], np.repeat(np.arange(len(first)), size)[tied]
    if not len(mine):
        return
    tail = word[start[mine] + SPAN - 8]
    order = np.lexsort((tail, group))
    ends = np.cumsum(np.append(False, (group[order][1:] != group[order][:-1]) | (tail[order][1:] != tail[order][:-1])))
    both = np.empty(len(mine), np.int64)
    both[order] = ends
    place = start[mine]
    for step in range(STEP):
        here = np.flatnonzero(np.isin((place + step) % STEP, COVER))
        order, first = grouped((both[here] << 32) | rank[place[here] + step])
        least = np.repeat(smallest(own[mine[here]][order], first), np.diff(np.append(first, len(order))))
        at = mine[here][order]
        best[at] = np.minimum(best[at], least)


# --- chunks and parts -------------------------------------------------------------------------------


class Chunk:
    """A chunk's rows in memory, with the runs of their spans."""

    def __init__(self, table: pa.Table, key: str, text: str):
        keys = table[key].combine_chunks()
        self.key = keys.fill_null(2**63 - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.data, self.offsets = bytewise.flat(table[text])
        self.row, self.first, self.end, self.anchor = runs(self.data, self.offsets)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, sorted, and whether several keys have each."""
        order, first = grouped(self.anchor)
        key = self.key[self.row[order]]
        return self.anchor[order][first], smallest(key, first) < largest(key, first)

    def digests(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return bytewise.Spans(start, start + length, start).hashes(self.data) ^ bytewise.mixed(length.astype(np.uint64))

    def sizes(self, own: np.ndarray) -> np.ndarray:
        """The binary logarithm, rounded down, of each anchor's number of distinct pieces. `own` are all anchors, sorted."""
        of = np.searchsorted(own, self.anchor)
        count = np.bincount(of, minlength=len(own))
        run = np.flatnonzero(count[of] >= COUNTED_USES)
        digest, of = self.digests(self.first[run], self.end[run] - self.first[run] + SPAN - 1), of[run]
        order = np.lexsort((digest, of))
        again = np.flatnonzero((of[order][1:] == of[order][:-1]) & (digest[order][1:] == digest[order][:-1]))
        count -= np.bincount(of[order][again], minlength=len(own))
        return np.log2(np.maximum(count, 1)).astype(np.uint8)

    def repeated(self, answers: dict[int, bytes], parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The anchors that the parts have found repeated, and which of them are hot: two bits for each anchor, in the order of sending."""
        own, _ = self.anchors()
        found, hot = np.zeros(len(own), bool), np.zeros(len(own), bool)
        for part, mine in _by_part(own % np.uint64(parts)):
            if part in answers:
                bits = np.unpackbits(np.frombuffer(answers[part], np.uint8)).reshape(2, -1)[:, : len(mine)].astype(bool)
                found[mine], hot[mine] = bits
        return own[found], hot[found]

    def pieces(self, repeated: np.ndarray, hot: np.ndarray) -> tuple:
        """Uses of the repeated anchors' pieces: (run, start, the distinct piece); and of each distinct piece start, length,
        the number that names its part, keys. Every span of a hot anchor is a piece of its own."""
        at = np.searchsorted(repeated, self.anchor).clip(0, max(0, len(repeated) - 1))
        run = np.flatnonzero(repeated[at] == self.anchor) if len(repeated) else np.zeros(0, np.int64)
        split = hot[at[run]] if len(run) else np.zeros(0, bool)
        uses = np.where(split, self.end[run] - self.first[run], 1)
        start = bytewise.ranges(self.first[run], uses)
        run, split = np.repeat(run, uses), np.repeat(split, uses)
        length = np.where(split, 1, self.end[run] - start) + SPAN - 1
        digest = self.digests(start, length)
        order, first = grouped(digest)
        piece = np.empty(len(run), np.int64)
        piece[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        head, key = order[first], self.key[self.row[run[order]]]
        deal = np.where(split[head], bytewise.mixed(digest[head]), self.anchor[run[head]])
        return run, start, piece, start[head], length[head], deal, smallest(key, first), largest(key, first)


def _packed(*arrays: np.ndarray) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], "<i8")
    return zstandard.compress(sizes.tobytes() + b"".join(a.tobytes() for a in arrays), 1)


def _unpacked(raw: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.decompress(raw)
    sizes = np.frombuffer(raw, "<i8", len(types))
    at = 8 * len(types) + np.cumsum(sizes) - sizes
    return [np.frombuffer(raw, t, int(n) // np.dtype(t).itemsize, int(a)) for t, n, a in zip(types, sizes, at)]


def _blobs(to: list[int], by: int, payload: list[bytes]) -> pa.Table:
    return pa.table({"to": pa.array(to, pa.int32()), "by": pa.array([by] * len(to), pa.int32()), "payload": pa.array(payload, pa.binary())})


def _short(anchor: np.ndarray, parts: int) -> np.ndarray:
    """Four bytes of an anchor. A part holds some hundred thousand anchors, so few agree by chance; those only cost work."""
    return (anchor // np.uint64(parts) & np.uint64(0xFFFFFFFF)).astype("<u4")


BLOB = "to int, by int, payload binary"


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order, first = grouped(part)
    for a, b in zip(first, np.append(first[1:], len(order))):
        yield int(part[order[a]]), order[a:b]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """All columns of docs but the text, and n_bytes, n_removed, n_spans, kept_sha256; with keep_text also the text that is
    left (characters that lost a byte are left out)."""
    size = total_bytes(docs, text)
    chunks, parts = size // CHUNK_BYTES + 1, size // PART_BYTES + 1
    names = docs.columns
    mark_ = fresh(docs, "__chunk")
    hot_pieces = HOT_PIECES
    rows = docs.withColumn(mark_, F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(chunks)).cast("int"))

    def report(table: pa.Table) -> pa.Table:
        chunk = Chunk(table, key, text)
        anchor, several = chunk.anchors()
        sizes = chunk.sizes(anchor)
        to, payload = [], []
        for part, mine in _by_part(anchor % np.uint64(parts)):
            to.append(part)
            payload.append(_packed(_short(anchor[mine], parts), np.packbits(several[mine]), sizes[mine]))
        return _blobs(to, table[mark_][0].as_py(), payload)

    def screen(table: pa.Table) -> pa.Table:
        by = table["by"].to_pylist()
        got = [_unpacked(p, "<u4", "u1", "u1") for p in table["payload"].to_pylist()]
        anchor = np.concatenate([g[0] for g in got])
        many = np.concatenate([np.unpackbits(g[1], count=len(g[0])) for g in got]).astype(bool)
        order, first = grouped(anchor)
        size = np.diff(np.append(first, len(order)))
        several = np.add.reduceat(many[order].astype(np.int64), first) + size > 1
        many[order] = np.repeat(several, size)
        pieces = np.left_shift(1, np.concatenate([g[2] for g in got]).astype(np.int64))
        hot = np.empty(len(anchor), bool)
        hot[order] = np.repeat(np.add.reduceat(pieces[order], first) > hot_pieces, size)
        done, payload = 0, []
        for g in got:
            payload.append(b"".join(np.packbits(x[done: done + len(g[0])]).tobytes() for x in (many, hot)))
            done += len(g[0])
        return _blobs(by, table["to"][0].as_py(), payload)

    def send(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows or not told.num_rows:
            return _blobs([], 0, [])
        chunk = Chunk(table, key, text)
        answers = dict(zip(told["by"].to_pylist(), told["payload"].to_pylist()))
        _, _, _, start, length, deal, low, high = chunk.pieces(*chunk.repeated(answers, parts))
        to, payload = [], []
        for part, mine in _by_part(deal % np.uint64(parts)):
            to.append(part)
            payload.append(_packed(length[mine].astype("<i4"), low[mine], high[mine], chunk.data[bytewise.ranges(start[mine], length[mine])]))
        return _blobs(to, table[mark_][0].as_py(), payload)

    def sort(table: pa.Table) -> pa.Table:
        by = table["by"].to_pylist()
        got = [_unpacked(p, "<i4", "<i8", "<i8", "<u1") for p in table["payload"].to_pylist()]
        length, low, high, data = (np.concatenate([g[k] for g in got]) for k in range(4))
        length = length.astype(np.int64)
        begin = np.cumsum(length) - length
        # copies of a piece from several chunks are sorted once
        digest = bytewise.Spans(begin, begin + length, begin).hashes(data) ^ bytewise.mixed(length.astype(np.uint64))
        order, first = grouped(digest)
        one = np.empty(len(length), np.int64)
        one[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        head = order[first]
        text_ = data[bytewise.ranges(begin[head], length[head])]
        _, best = least_owner(text_, length[head], smallest(low[order], first))
        inside = length[head] - SPAN + 1
        at = np.cumsum(inside) - inside
        to, payload, done = [], [], 0
        for chunk, g in zip(by, got):
            mine = np.arange(done, done + len(g[0]))
            done += len(g[0])
            n = inside[one[mine]]
            least = best[bytewise.ranges(at[one[mine]], n)]
            piece = np.repeat(np.arange(len(mine)), n)
            offset = bytewise.ranges(np.zeros(len(mine), np.int64), n)
            # neighbouring spans of one piece and one owner are one entry; a piece's first owner has nothing to mark
            new = np.append(True, (least[1:] != least[:-1]) | (piece[1:] != piece[:-1])) if len(n) else np.zeros(0, bool)
            where = np.flatnonzero(new)
            count = np.diff(np.append(where, len(least)))
            marks = least[where] < high[mine][piece[where]]
            where, count = where[marks], count[marks]
            if len(where):
                to.append(chunk)
                payload.append(_packed(piece[where].astype("<i4"), offset[where].astype("<i4"), count.astype("<i4"), least[where]))
        return _blobs(to, table["to"][0].as_py(), payload)

    def mark(table: pa.Table, told: pa.Table) -> pa.Table:
        # told: kind 0 repeated anchors, kind 1 smallest keys of spans
        if not table.num_rows:
            return out_schema.empty_table()
        chunk = Chunk(table, key, text)
        depth = np.zeros(len(chunk.data) + 1, np.int32)
        kind, by, payloads = told["kind"].to_pylist(), told["by"].to_pylist(), told["payload"].to_pylist()
        answers = {b: p for k, b, p in zip(kind, by, payloads) if k == 1}
        if answers:
            run, start, piece, _, _, deal, _, _ = chunk.pieces(
                *chunk.repeated({b: p for k, b, p in zip(kind, by, payloads) if k == 0}, parts)
            )
            by_piece = np.argsort(piece, kind="stable")
            first = np.searchsorted(piece[by_piece], np.arange(len(deal)))
            uses = np.bincount(piece, minlength=len(deal))
            for part, mine in _by_part(deal % np.uint64(parts)):
                if part not in answers:
                    continue
                local, offset, count, least = _unpacked(answers[part], "<i4", "<i4", "<i4", "<i8")
                p = mine[local]
                used = by_piece[bytewise.ranges(first[p], uses[p])]
                again = np.repeat(np.arange(len(p)), uses[p])
                hit = chunk.key[chunk.row[run[used]]] > least[again]
                a = start[used[hit]] + offset[again[hit]]
                np.add.at(depth, a, 1)
                np.add.at(depth, a + count[again[hit]] + SPAN - 1, -1)
        gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
        del depth
        n = table.num_rows
        # per-row counts from row borders; a running count of all bytes would be eight times the text
        sums = counted(gone, chunk.offsets)
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        starts = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
        edge[starts] = gone[starts]
        spans = counted(edge, chunk.offsets)
        a, b = chunk.offsets[:-1], chunk.offsets[1:]
        left = [chunk.data[x:y][~gone[x:y]].tobytes() if lost else chunk.data[x:y].tobytes() for x, y, lost in zip(a, b, sums)]
        columns = [table[c] for c in names if c != text] + [
            pa.array(b - a), pa.array(sums), pa.array(spans),
            pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
        ]
        if keep_text:
            columns.append(pa.array([x.decode("utf-8", "ignore") for x in left], pa.string()))
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=out_schema)

    made = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")] + ([("kept_text", "string")] if keep_text else [])
    kept = [f for f in docs.schema.fields if f.name != text]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in made])
    from pyspark.sql.pandas.types import to_arrow_type

    out_schema = pa.schema([
        *[(f.name, to_arrow_type(f.dataType)) for f in kept], *[(n, pa.int64() if t == "long" else pa.string()) for n, t in made],
    ])
    by_chunk = rows.groupBy(mark_)
    anchors = by_chunk.applyInArrow(report, BLOB)
    repeated = anchors.groupBy("to").applyInArrow(screen, BLOB)
    sent = by_chunk.cogroup(repeated.groupBy("to")).applyInArrow(send, BLOB)
    answered = sent.groupBy("to").applyInArrow(sort, BLOB)
    told = repeated.withColumn("kind", F.lit(0)).unionAll(answered.withColumn("kind", F.lit(1)))
    return by_chunk.cogroup(told.groupBy("to")).applyInArrow(mark, ddl)
