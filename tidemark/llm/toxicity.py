"""Toxicity by a support vector machine on a subsequence string kernel, with Nystroem landmarks.

Kernel: windows of `WINDOW` symbols; features are their subsequences of four symbols within a span of six, each gap worth `DECAY`. A
word with an inserted or dropped-in character keeps most of its subsequences, so it stays near the word itself.

Training, on labelled sentences: the distinct sentences of sampled labelled texts. Runs of five symbols that come far more often in sentences of
toxic texts are the witnesses; windows at a witness in toxic texts are the positives, windows of clean texts the negatives. Landmarks are drawn
from both; a squared-hinge machine is fitted on kernel values with the landmarks times the inverse root of the landmarks'
own matrix, and again with the clean windows that scored highest among the negatives.

Scoring: the machine is a weighted sum of kernels with the landmarks, so its landmarks' features are added up once into one table,
and the sum over a window's subsequences gives exactly the machine's value. A text's value is its largest window's; a
logistic curve fitted on the sampled texts makes it a probability.

Null and empty texts score as texts without evidence. Without labels of both kinds every text scores 0.
Samples (rows and sentences) are bounded by the parameters below; scoring reads whole texts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import bytewise
from tidemark.llm.staging import fresh, staged

ROWS_PER_CLASS = 1500
SENTENCES_PER_CLASS = 30_000
SENTENCE_CHARS = 400
LANDMARKS = 160
POSITIVES, NEGATIVES, HARD = 2500, 8000, 2000
WINDOW = 11
DECAY = 0.6
LENGTH, SPAN = 4, 6
SYMBOLS = 40
DIGIT = 27
WITNESS_Z = 6.0
GRAM = 5
THRESHOLD = 0.7
PAD = WINDOW + 2

TAILS = [(0, *rest) for rest in combinations(range(1, SPAN), LENGTH - 1)]

_table: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """a-z, also under accents: 1-26, digits: 27, letters of other scripts: one of 28-39 by code point, anything else: 0."""
    if not _table:
        out = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            x = chr(c)
            if x.isalnum():
                low = ord(unicodedata.normalize("NFD", x.lower())[0])
                other = DIGIT if x.isnumeric() and not x.isalpha() else DIGIT + 1 + low % (SYMBOLS - DIGIT - 1)
                out[c] = low - 96 if 97 <= low <= 122 else other
        _table.append(out)
    return _table[0]


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in a row, a border of zeros before each and at the end; and where each border begins."""
    parts, starts, at = [], [], 0
    border = np.zeros(PAD, np.uint8)
    for text in texts:
        s = _symbols()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = s > 0
        keep[1:] |= s[:-1] > 0
        s = s[keep]
        parts += [border, s]
        starts.append(at)
        at += PAD + len(s)
    return np.concatenate([*parts, border]), np.array(starts, np.int64)


def _codes(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each shape of subsequence: the code at every start, and the shape's weight."""
    s = symbols.astype(np.int32)
    n = len(s) - SPAN + 1
    for shape in TAILS:
        code = s[:n]
        for k in shape[1:]:
            code = code * SYMBOLS + s[k: k + n]
        yield code, DECAY ** (shape[-1] - LENGTH + 1)


def values(symbols: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The sum of `table` over the subsequences of the window at each place."""
    if len(symbols) < WINDOW:
        return np.zeros(0)
    per_start = np.zeros(len(symbols) - SPAN + 1)
    for code, weight in _codes(symbols):
        per_start += weight * table[code]
    sums = np.concatenate([[0.0], np.cumsum(per_start)])
    inside = WINDOW - SPAN + 1
    return sums[inside:] - sums[:-inside]


def features(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of the subsequences of each window (rows of symbols)."""
    n = WINDOW - SPAN + 1
    s = windows.astype(np.int64)
    codes, weights = [], []
    for shape in TAILS:
        code = s[:, :n]
        for k in shape[1:]:
            code = code * SYMBOLS + s[:, k: k + n]
        codes.append(code)
        weights.append(np.full(code.shape[1], DECAY ** (shape[-1] - LENGTH + 1)))
    return np.concatenate(codes, axis=1), np.concatenate(weights)


class Machine:
    """The fitted machine: one table of subsequence weights, a bias, and the logistic curve."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.slope, self.shift = 0.0, -30.0

    def decision(self, texts: list[str | None]) -> np.ndarray:
        symbols, starts = encode(texts)
        if not len(starts):
            return np.zeros(0)
        return np.maximum.reduceat(values(symbols, self.table), starts) + self.bias

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -30, 30)))


def _project(windows: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    codes, weights = features(windows)
    at = np.searchsorted(vocabulary, codes).clip(0, len(vocabulary) - 1)
    hit = vocabulary[at] == codes
    flat = (np.arange(len(windows))[:, None] * len(vocabulary) + at)[hit]
    out = np.bincount(flat, weights=np.broadcast_to(weights, codes.shape)[hit], minlength=len(windows) * len(vocabulary))
    return out.reshape(len(windows), -1)


def _solve(phi: np.ndarray, y: np.ndarray, cost: float = 1.0) -> np.ndarray:
    """Squared hinge, both classes of equal weight, by Newton steps on the rows inside the margin."""
    x = np.concatenate([phi, np.ones((len(phi), 1))], axis=1)
    c = cost * np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * len(y) / 2
    w = np.zeros(x.shape[1])
    ridge = np.diag([*[1.0] * phi.shape[1], 1e-6])
    for _ in range(30):
        inside = y * (x @ w) < 1
        a = (x[inside] * c[inside, None]).T @ x[inside] + ridge
        new = np.linalg.solve(a, (x[inside] * c[inside, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-6):
            break
        w = 0.5 * w + 0.5 * new
    return w


def _fit(positive: np.ndarray, negative: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    half = LANDMARKS // 2
    marks = np.concatenate([positive[rng.permutation(len(positive))[:half]], negative[rng.permutation(len(negative))[:half]]])
    marks = np.unique(marks, axis=0)
    codes, weights = features(marks)
    vocabulary = np.unique(codes)
    own = _project(marks, vocabulary)
    scale = np.mean((own**2).sum(axis=1))
    root, axes = np.linalg.eigh(own @ own.T / scale)
    good = root > 1e-6 * root.max()
    whiten = axes[:, good] / np.sqrt(root[good])
    rows = np.concatenate([positive, negative])
    phi = np.concatenate([_project(rows[a: a + 500], vocabulary) @ own.T for a in range(0, len(rows), 500)]) / scale @ whiten
    w = _solve(phi, np.where(np.arange(len(rows)) < len(positive), 1.0, -1.0))
    table = np.zeros(SYMBOLS**LENGTH, np.float32)
    table[vocabulary] = own.T @ (whiten @ w[:-1]) / scale
    return table, float(w[-1])


def _windows(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    at = at[(at >= 0) & (at + WINDOW <= len(symbols))]
    return symbols[at[:, None] + np.arange(WINDOW)]


def _grams(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sentence, code) pairs of the symbol runs of `GRAM`, borders left out; and the code at every place."""
    n = len(symbols) - GRAM + 1
    code = symbols[:n].astype(np.int64)
    for k in range(1, GRAM):
        code = code * SYMBOLS + symbols[k: k + n]
    sentence = np.searchsorted(starts, np.arange(n), "right") - 1
    top = SYMBOLS**GRAM
    pairs = np.unique(sentence * top + code)
    return pairs // top, pairs % top, code


def witnesses(toxic: np.ndarray, n: int, clean: np.ndarray, m: int) -> np.ndarray:
    """Codes far commoner among n sentences of toxic texts than among m of clean ones (arguments: codes, one per sentence
    that has it). Sorted."""
    code, k = np.unique(toxic, return_counts=True)
    other, j = np.unique(clean, return_counts=True)
    at = np.searchsorted(other, code).clip(0, max(0, len(other) - 1))
    q = np.where(other[at] == code, j[at], 0) / m if len(other) else np.zeros(len(code))
    p = k / n
    both = (p * n + q * m) / (n + m)
    far = p - q > WITNESS_Z * np.sqrt(both * (1 - both) * (1 / n + 1 / m))
    return code[(k >= 3) & (p > 4 * q) & far]


def fit_sentences(toxic: list[str], clean: list[str]) -> Machine:
    """The machine from distinct sentences of toxic and of clean texts."""
    if not toxic or not clean:
        return Machine(np.zeros(SYMBOLS**LENGTH, np.float32), 0.0)
    rng = np.random.default_rng(11)
    symbols, starts = encode(toxic)
    clean_symbols, clean_starts = encode(clean)
    _, in_toxic, code = _grams(symbols, starts)
    _, in_clean, _ = _grams(clean_symbols, clean_starts)
    found = witnesses(in_toxic, len(toxic), in_clean, len(clean))
    at = np.flatnonzero(np.isin(code, found))
    at = at[np.append(True, np.diff(at) > WINDOW)] if len(at) else at  # once for each run of witnesses
    if len(at):
        at = at + rng.integers(-2, 1, len(at))
    else:  # nothing stands out: any window of a toxic text may be the reason
        at = rng.integers(0, max(1, len(symbols) - WINDOW), POSITIVES)
    positive = _windows(symbols, rng.permutation(at)[:POSITIVES])
    negative = _windows(clean_symbols, rng.integers(0, max(1, len(clean_symbols) - WINDOW), NEGATIVES))
    if not len(positive) or not len(negative):
        return Machine(np.zeros(SYMBOLS**LENGTH, np.float32), 0.0)
    table, bias = _fit(positive, negative, rng)
    hard = np.argsort(-values(clean_symbols, table))[:HARD]
    table, bias = _fit(positive, np.concatenate([negative, _windows(clean_symbols, hard)]), rng)
    return Machine(table, bias)


def calibrate(machine: Machine, decision: np.ndarray, toxic: np.ndarray) -> None:
    """The logistic curve of label against value, by Newton steps with a weak pull to zero."""
    if not len(toxic) or toxic.min() == toxic.max():
        return
    x = np.stack([decision, np.ones(len(decision))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - toxic) + 0.01 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        w = w - np.linalg.solve(h, g)
    machine.slope, machine.shift = float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> Machine:
    """Fit on a bounded sample of the labelled rows for which `learn` holds (an expression over the labels table)."""
    marked = labels.where(learn & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect() if r["toxic"] in (0, 1)}
    if len(counts) < 2:
        return Machine(np.zeros(SYMBOLS**LENGTH, np.float32), 0.0)
    draw = F.shiftrightunsigned(F.xxhash64("key"), 11) / float(2**53)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, 2.0 * rows_per_class / n)])
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("key"), "key")
    ids = (
        marked.where(F.col("toxic").isin(0, 1)).where(draw < share[F.col("toxic")])
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows_per_class).select("key", "toxic")
    )
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    chosen = staged(rows.join(F.broadcast(ids), "key"))  # at most two classes of rows_per_class ids
    # whole sentences; a longer one is several
    sentences = chosen.select("toxic", F.explode(F.split("text", r"(?<=[.!?])\s+|\n|(?<=\G.{%d})" % SENTENCE_CHARS)).alias("s")).where("s <> ''")
    held = {r["toxic"]: r["count"] for r in sentences.groupBy("toxic").count().collect()}
    parts = {}
    for kind in (0, 1):
        share_ = min(1.0, SENTENCES_PER_CLASS / max(1, held.get(kind, 0)))
        spread = F.shiftrightunsigned(F.xxhash64("s"), 11) / float(2**53)
        got = sentences.where((F.col("toxic") == kind) & (spread < share_)).select("s").collect()
        parts[kind] = sorted({r["s"] for r in got})
    machine = fit_sentences(parts[1], parts[0])
    seen = decide(chosen, machine, ["toxic"], "text").collect()
    calibrate(machine, np.array([r["decision"] for r in seen]), np.array([r["toxic"] for r in seen], float))
    return machine


def decide(docs: DataFrame, machine: Machine, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns with decision and score."""
    keep = [c for c in keep if c not in ("decision", "score", "predicted")]
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(*keep, F.col(text).alias(fresh(docs, "__text")))

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            column = batch.column(batch.num_columns - 1)
            _, offsets = bytewise.flat(column)
            for a, b in bytewise.slices(offsets):
                value = sent.value.decision(column.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(a, b - a) for c in batch.columns[:-1]], pa.array(value), pa.array(sent.value.probability(value))],
                    [*keep, "decision", "score"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(task, f"{fields}, decision double, score double")


def score(docs: DataFrame, machine: Machine, keep: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    return decide(docs, machine, keep, text).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("decision")
