"""Benchmark decontamination by template canonicalisation.

Texts become template tokens: numbers (digits or number words), units right after a number, and names (words with a capital
inside a sentence) are typed placeholders; other words are their lower-case form. Unicode punctuation and spaces separate words as
those of ASCII do, and each character of a script without spaces is a word. A second template keeps names as words, so
that copies in other case are found too. Windows of `WIDTH` template tokens of the documents are looked up in
a hash table of the benchmark's windows; an item of fewer tokens is one window.

A document leaks an item if windows that agree in their slots cover at least `COVERAGE` of the item's tokens. Slots agree if the
placeholders of all matched windows give a one-to-one map from the item's values to the document's (exact copies: the identity), so
re-parameterised questions are found and chance matches of number-rich text are not. Where the map breaks, the windows
of each alignment are tried alone, then those of each run of near alignments (copies with insertions); any that agrees and covers
enough is a leak.

The benchmark is cut into blocks of at most about `BLOCK_BYTES`, whose tables are broadcast one after the other; a benchmark of
any size is looked up whole. Documents are never shuffled.

Items of one template whose values are equal at the same places are a class and are looked up as one. A document that holds whole copies of
members leaks those (a second look-up by the values); one that holds the template with other values leaks the class, which is
reported once, as its first item. So the work does not grow with the number of items of a template.

Windows with fewer than `LITERALS` literal words are evidence of the same values only: the table has them with their real values
in place of placeholders. Items of fewer than `LITERALS` tokens leak only into a document that is nothing but the item ("of the"
within a text is no leak). Null and empty texts leak nothing; repeated items
are reported each; an empty benchmark or table gives no leaks.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytewise

WIDTH = 8
LITERALS = 3
COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
FILTER_BITS = 22

# Number words and units of measure, in several languages of the test tables
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen"
).split()
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes "
    "pound pounds lb lbs ounce ounces oz ml cl l liter liters litre litres gallon gallons second seconds sec s minute minutes "
    "min hour hours h day days week weeks month months year years percent degrees degree celsius fahrenheit dollar dollars "
    "cent cents euro euros usd eur meter meters metre metres kilometer kilometers kilometre kilometres mph kmh hz khz mhz ghz "
    "watt watts kw kwh volt volts amp amps joule joules byte bytes kb mb gb tb"
).split()

LETTER, DIGIT, SINGLE = 1, 2, 3
KINDS = np.zeros(256, np.uint8)
KINDS[ord("0"): ord("9") + 1] = DIGIT
KINDS[ord("A"): ord("Z") + 1] = LETTER
KINDS[ord("a"): ord("z") + 1] = LETTER
KINDS[128:] = LETTER
CODE_POINTS = 1 << 18  # all beyond are letters
# Scripts without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, kana and ideographs
UNSPACED = (
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x30FF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
)


def _kinds_of_characters() -> np.ndarray:
    out = np.full(CODE_POINTS + 1, LETTER, np.uint8)
    for a, b in UNSPACED:
        out[a: min(b + 1, CODE_POINTS)] = SINGLE
    for c in range(128, 0x20000):
        category = unicodedata.category(chr(c))
        if category in ("So", "Sk"):
            out[c] = SINGLE
        elif category[0] in "PSZ" or category in ("Cc", "Cf"):
            out[c] = 0
        elif category == "Nd":
            out[c] = DIGIT
    return out


CHARACTERS = _kinds_of_characters()
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True
WORD, NUMBER, UNIT, NAME = range(4)
SAME = np.uint64(1 << 32)  # tells windows of values from template windows
PLACEHOLDER = bytewise.mixed(np.arange(1, 5, dtype=np.uint64))


def _hashes_of(listed: list[str]) -> np.ndarray:
    raw = "".join(listed).encode()
    ends = np.cumsum([len(w) for w in listed])
    return np.sort(bytewise.Spans(np.append(0, ends[:-1]), ends, ends).hashes(np.frombuffer(raw, np.uint8)))


NUMBERS, MEASURES = _hashes_of(NUMBER_WORDS), _hashes_of(UNITS)


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.searchsorted(listed, values).clip(0, len(listed) - 1)] == values


def _characters(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Set the kind of all bytes of characters beyond ASCII; the places where a character that is a word begins, and where it ends."""
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return lead
    head = data[lead].astype(np.int64)
    more = 1 + (head >= 0xE0) + (head >= 0xF0)
    code = head & (0x3F >> more)
    for k in (1, 2, 3):
        own = more >= k
        code[own] = code[own] << 6 | (data[np.minimum(lead[own] + k, len(data) - 1)] & 0x3F)
    found = CHARACTERS[np.minimum(code, CODE_POINTS)]
    kind[lead] = found
    for k in (1, 2, 3):
        own = more >= k
        kind[np.minimum(lead[own] + k, len(data) - 1)] = found[own]
    alone = found == SINGLE
    return np.concatenate([lead[alone], np.minimum(lead[alone] + more[alone] + 1, len(data))])


class Tokens:
    """Template tokens of rows: spans, rows, kinds, values (hash of the lower-case form)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = KINDS[data]
        alone = _characters(data, kind)
        joint = np.flatnonzero((data[1:-1] == 46) | (data[1:-1] == 44)) + 1  # a point or comma within a number
        joint = joint[(kind[joint - 1] == DIGIT) & (kind[joint + 1] == DIGIT)]
        kind[joint] = DIGIT
        low = bytewise.LOWER[data]
        edge = np.empty(len(data) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[offsets] = True
        edge[alone] = True
        edge[0] = edge[-1] = True
        at = np.flatnonzero(edge)
        inside = kind[at[:-1]] > 0 if len(data) else np.zeros(0, bool)
        self.start, self.end = at[:-1][inside], at[1:][inside]
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        n = len(self.start)
        self.value = bytewise.Spans(self.start, self.end, self.row).hashes(low) if n else np.zeros(0, np.uint64)
        first = np.append(True, self.row[1:] != self.row[:-1]) if n else np.zeros(0, bool)
        ends = np.concatenate([[0], np.cumsum(ENDS[data])])
        opens = first.copy()
        opens[1:] |= ends[self.start[1:]] > ends[self.end[:-1]]
        head = data[self.start]
        second = data[np.minimum(self.start + 1, len(data) - 1)] if n else head
        capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        number = (kind[self.start] == DIGIT) | _among(self.value, NUMBERS)
        unit = np.zeros(n, bool)
        unit[1:] = number[:-1] & ~first[1:] & _among(self.value[1:], MEASURES)
        self.kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(capital & ~opens, NAME, WORD)))

    def windows(self, width: int, names: bool | None) -> tuple[np.ndarray, np.ndarray]:
        """First token and hash of every window of one row that is evidence; without placeholders, if `names` is None."""
        if len(self.kind) < width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if names is None:
            value = bytewise.mixed(bytewise.rolling(self.value, width) + np.uint64(width) + SAME)
            at = np.flatnonzero(self.row[width - 1:] == self.row[: len(value)])
            return at, value[at]
        kind = self.kind if names else np.where(self.kind == NAME, WORD, self.kind)
        code = np.where(kind == WORD, self.value, PLACEHOLDER[kind])
        value = bytewise.mixed(bytewise.rolling(code, width) + np.uint64(width))
        literal = np.concatenate([[0], np.cumsum(kind == WORD)])
        fit = (self.row[width - 1:] == self.row[: len(value)]) & (literal[width:] - literal[:-width] >= min(LITERALS, width))
        return np.flatnonzero(fit), value[fit]


def _digest(values: np.ndarray) -> np.ndarray:
    """A 64-bit value of each row of token values."""
    return bytewise.mixed((bytewise.mixed(values) * bytewise.powers(bytewise.BASE, values.shape[1])).sum(axis=1, dtype=np.uint64))


class Table:
    """The hash table of one benchmark block.

    Items of one template (and one pattern of equal values) are a class: their windows are those of its first item, so a family of
    thousands of items is looked up as one. `owner` is the item of a window of real values, -1 of a template window.
    """

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        data, offsets = bytewise.flat(pa.array([t or "" for _, t in items], pa.string()))
        self.tokens = Tokens(data, offsets)
        size = np.bincount(self.tokens.row, minlength=len(items)) if len(items) else np.zeros(0, np.int64)
        self.size, self.first = size, np.cumsum(size) - size
        self.group = self._classes()
        self.members: dict[int, list[int]] = defaultdict(list)
        for k, rep in enumerate(self.group):
            self.members[int(rep)].append(k)
        self.exact: dict[tuple[int, int], list[int]] = defaultdict(list)
        self.short: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for k, n in enumerate(size):
            values = self.tokens.value[self.first[k]: self.first[k] + n]
            if 0 < n < LITERALS:
                self.short[tuple(values.tolist())].append(k)
            elif n and len(self.members[int(self.group[k])]) > 1:
                self.exact[int(self.group[k]), int(_digest(values[None])[0])].append(k)
        self.widths = sorted({WIDTH, *size[(size >= LITERALS) & (size < WIDTH)].tolist()})
        hashes, places, widths, owners = [], [], [], []
        for width in self.widths:
            for names in (True, False, None):
                at, value = self.tokens.windows(width, names)
                if names is None:  # only where the template is no evidence
                    few = ~np.isin(at, self.tokens.windows(width, False)[0])
                    at, value = at[few], value[few]
                item = self.tokens.row[at]
                fit = (size[item] >= WIDTH) if width == WIDTH else (size[item] == width)
                at, item, rep = at[fit], item[fit], self.group[item[fit]]
                hashes.append(value[fit])
                places.append(at - self.first[item] + self.first[rep])
                widths.append(np.full(len(at), width))
                owners.append(item if names is None else np.full(len(at), -1))
        columns = [np.concatenate(hashes).view(np.int64), *[np.concatenate(x) for x in (places, widths, owners)]]
        rows = np.unique(np.stack(columns, axis=1), axis=0)
        hash_ = rows[:, 0].copy().view(np.uint64)
        order = np.argsort(hash_, kind="stable")
        self.hash, self.place, self.width, self.owner = hash_[order], rows[order, 1], rows[order, 2], rows[order, 3]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hash >> np.uint64(64 - FILTER_BITS)] = True

    def _classes(self) -> np.ndarray:
        """The first item of the same template and pattern of equal values, for each item."""
        tokens, seen = self.tokens, {}
        code = np.where(tokens.kind == WORD, tokens.value, PLACEHOLDER[tokens.kind])
        out = np.arange(len(self.size))
        for k, (a, n) in enumerate(zip(self.first, self.size)):
            if n >= LITERALS:
                values = tokens.value[a: a + n]
                _, first, back = np.unique(values, return_index=True, return_inverse=True)
                out[k] = seen.setdefault((code[a: a + n].tobytes(), first[back].tobytes()), k)
        return out

    def find(self, tokens: Tokens) -> Iterator[tuple[int, np.ndarray]]:
        """For every row with a window in the table: the row, and (first token, of the class's windows, width, owner) of its windows."""
        found = []
        for width in self.widths:
            for names in (True, False, None):
                at, value = tokens.windows(width, names)
                maybe = np.flatnonzero(self.filter[value >> np.uint64(64 - FILTER_BITS)])
                at, value = at[maybe], value[maybe]
                low, high = np.searchsorted(self.hash, value), np.searchsorted(self.hash, value, "right")
                k = bytewise.ranges(low, high - low)
                mine = np.repeat(at, high - low)
                right = self.width[k] == width
                found.append(np.stack([mine[right], self.place[k[right]], self.width[k[right]], self.owner[k[right]]], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        row = tokens.row[pairs[:, 0]]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
        for a, b in zip(first, np.append(first[1:], len(row))):
            yield int(row[a]), pairs[a:b]

    def _agree(self, tokens: Tokens, at: np.ndarray, place: np.ndarray, width: np.ndarray) -> tuple[bool, bool]:
        """Whether the slots of these windows agree, and whether all values are the same."""
        step = bytewise.ranges(np.zeros(len(width), np.int64), width)
        a, b = np.repeat(at, width) + step, np.repeat(place, width) + step
        slot = (tokens.kind[a] != WORD) | (self.tokens.kind[b] != WORD)
        pairs = np.unique(np.stack([self.tokens.value[b[slot]], tokens.value[a[slot]]], axis=1), axis=0)
        ours, theirs = len(np.unique(pairs[:, 0])), len(np.unique(pairs[:, 1]))
        return len(pairs) == ours == theirs, bool((pairs[:, 0] == pairs[:, 1]).all())

    def _alignments(self, at: np.ndarray, place: np.ndarray, size: int, coverage: float) -> Iterator[np.ndarray]:
        """The windows of each alignment that could cover enough, most windows first; then those of each run of near alignments."""
        shift = at - place
        order = np.lexsort((at, shift))
        ranked = shift[order]
        for near in (0, max(1, size // 4)):
            first = np.flatnonzero(np.append(True, np.diff(ranked) > near))
            end = np.append(first[1:], len(ranked))
            for k in np.argsort(first - end, kind="stable"):
                a, b = first[k], end[k]
                if (b - a) * WIDTH < coverage * size:
                    break
                if not near or ranked[a] != ranked[b - 1]:
                    yield np.sort(order[a:b])

    def _covers(self, tokens: Tokens, windows: np.ndarray, size: int, coverage: float) -> tuple | None:
        """(share, windows, same values, first token, last token) of the first alignment that agrees and covers enough."""
        at, place, width = windows[:, 0], windows[:, 1], windows[:, 2]
        every = np.arange(len(windows))
        for mine in chain([every], self._alignments(at, place, size, coverage)):
            share = len(np.unique(bytewise.ranges(place[mine], width[mine]))) / size
            if share >= coverage:
                agree, same = self._agree(tokens, at[mine], place[mine], width[mine])
                if agree:
                    return share, len(mine), same, int(at[mine].min()), int((at[mine] + width[mine]).max()) - 1
        return None

    def _whole(self, tokens: Tokens, rep: int, windows: np.ndarray) -> dict[int, tuple]:
        """The members of a class of which the row holds a whole copy, found by a hash of all values."""
        size = int(self.size[rep])
        begin, count = np.unique(windows[:, 0] - windows[:, 1] + self.first[rep], return_counts=True)
        inside = (begin >= 0) & (begin + size <= len(tokens.value))
        begin, count = begin[inside], count[inside]
        together = tokens.row[begin] == tokens.row[begin + size - 1]
        begin, count = begin[together], count[together]
        out: dict[int, tuple] = {}
        for cut in range(0, len(begin), 4096):
            part = begin[cut: cut + 4096]
            values = tokens.value[part[:, None] + np.arange(size)]
            for i, digest in enumerate(_digest(values).tolist()):
                for k in self.exact.get((rep, digest), ()):
                    if k not in out and np.array_equal(values[i], self.tokens.value[self.first[k]: self.first[k] + size]):
                        out[k] = (1.0, int(count[cut + i]), True, int(part[i]), int(part[i]) + size - 1)
        return out

    def leaks(self, data: np.ndarray, offsets: np.ndarray, coverage: float) -> dict[int, list[tuple]]:
        """row -> [(item, coverage, windows, same values, first byte, end byte)]"""
        tokens, out = Tokens(data, offsets), defaultdict(list)
        for row, windows in self.find(tokens):
            rep = self.group[self.tokens.row[windows[:, 1]]]
            order = np.argsort(rep, kind="stable")
            windows, rep = windows[order], rep[order]
            edges = np.flatnonzero(np.append(True, rep[1:] != rep[:-1]))
            for a, b in zip(edges, np.append(edges[1:], len(rep))):
                k, mine, hits = int(rep[a]), windows[a:b], {}
                size, template = int(self.size[k]), mine[:, 3] < 0
                if len(self.members[k]) == 1:
                    hits[k] = self._covers(tokens, mine, size, coverage)
                else:
                    hits = self._whole(tokens, k, mine)
                    for owner in np.unique(mine[~template, 3]).tolist():
                        if owner not in hits:
                            hits[owner] = self._covers(tokens, mine[template | (mine[:, 3] == owner)], size, coverage)
                    if template.any() and not any(hits.values()):
                        hits[k] = self._covers(tokens, mine[template], size, coverage)
                for item, hit in hits.items():
                    if hit:
                        share, count, same, first, last = hit
                        out[row].append((
                            self.ids[item], share, count, same, int(tokens.start[first] - offsets[row]), int(tokens.end[last] - offsets[row]),
                        ))
        if self.short:
            held = np.bincount(tokens.row, minlength=len(offsets) - 1)
            first = np.cumsum(held) - held
            for row in np.flatnonzero((held > 0) & (held < LITERALS)).tolist():
                a, n = int(first[row]), int(held[row])
                for k in self.short.get(tuple(tokens.value[a: a + n].tolist()), ()):
                    out[row].append((
                        self.ids[k], 1.0, 1, True, int(tokens.start[a] - offsets[row]), int(tokens.end[a + n - 1] - offsets[row]),
                    ))
        return out


LEAK = "item_id long, coverage double, windows int, same_values boolean, first_byte int, end_byte int"


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", coverage: float = COVERAGE, out: str = "leaks") -> DataFrame:
    """All columns of docs and `out`, the benchmark items that the row leaks (empty: none)."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0))).first()[0]
    blocks = size // BLOCK_BYTES + 1
    names = docs.columns
    marked = docs.withColumn(out, F.expr(f"cast(array() as array<struct<{LEAK.replace(' ', ':').replace(',:', ',')}>>)"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields)
    fields = [p.split(" ")[0] for p in LEAK.split(", ")]
    kind = pa.list_(pa.struct([
        ("item_id", pa.int64()), ("coverage", pa.float64()), ("windows", pa.int32()), ("same_values", pa.bool_()), ("first_byte", pa.int32()), ("end_byte", pa.int32()),
    ]))
    for block in range(blocks):
        mine = benchmark.select(F.col(item).cast("long").alias("id"), F.col(item_text).alias("t"))
        rows = mine.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES
        table = docs.sparkSession.sparkContext.broadcast(Table(sorted(((r["id"], r["t"]) for r in rows), key=repr)))

        def task(stream: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                data, offsets = bytewise.flat(batch.column(names.index(text)))
                found: dict[int, list[tuple]] = {}
                for a, b in bytewise.slices(offsets):
                    own = table.value.leaks(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], coverage)
                    found |= {a + k: v for k, v in own.items()}
                before = batch.column(len(names)).to_pylist() if blocks > 1 else [[]] * batch.num_rows
                leaks = [[*have, *(dict(zip(fields, x)) for x in found.get(k, ()))] for k, have in enumerate(before)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(leaks, kind)], [*names, out])

        marked = marked.mapInArrow(task, ddl)
    return marked
