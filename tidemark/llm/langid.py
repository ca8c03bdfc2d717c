"""Language identification by string kernels.

Kernel: blended-spectrum presence. A text is the set of its 1-, 2- and 3-grams over a 64-symbol alphabet; the kernel of two texts
is the number of n-grams they share, divided by the root of the product of their set sizes.

Training: a sample of at most `PER_LANGUAGE` labelled texts per language (chosen by a hash of the row's key), of which at
most `LANDMARKS` are Nystroem landmarks. A text becomes its kernel values with the landmarks times the inverse root of the
landmarks' own kernel matrix; one-versus-rest kernel ridge regression is solved on these.

Scoring: whole texts, in batches. A batch is a presence matrix over the landmarks' n-grams; its kernel values and its class
scores are two matrix products. The result is the class of the largest score, and a probability from the scores by
softmax. A text that is null or has no letter is `und` with score 0. Without any labelled text every text is `und`.

A text fits none of the languages if its winning decision value is below the floor: the 0.5 % quantile of the sample's
own winning values, less 0.1, so it does not depend on how many languages there are. Texts of under 100 distinct n-grams hold too
little evidence to be rejected; with one language there is nothing to compare with, and all texts with a letter fit.

Letters are lower-cased; a-z are symbols of their own, other letters share 37 symbols by code point, and a run of
anything else is one symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.staging import fresh

PER_LANGUAGE = 400
LANDMARKS = 96
RIDGE = 0.1
SHARPNESS = 4.0
EVIDENCE = 100  # distinct n-grams below which no text is rejected
OWN_SHARE, MARGIN = 0.005, 0.1  # where the floor lies: a quantile of the sample's own decision values, and below it
MOST_LANGUAGES = 500
UNKNOWN = "und"
GRAMS = 64 + 64**2 + 64**3
FIRST = (0, 64, 64 + 64**2)  # where the codes of 1-, 2- and 3-grams begin
BATCH = 256

_symbols: list[np.ndarray] = []


def symbols() -> np.ndarray:
    """The symbol of every code point; 0: no letter."""
    if not _symbols:
        table = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = ord(chr(c).lower()[0])
                table[c] = low - 96 if 97 <= low <= 122 else 27 + low % 37
        _symbols.append(table)
    return _symbols[0]


def grams(text: str, seen: np.ndarray) -> bool:
    """Mark the n-grams of the text in `seen` (of GRAMS bytes, all zero). False if the text has no letter."""
    s = symbols()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = s > 0
    if not keep.any():
        return False
    keep[1:] |= s[:-1] > 0  # the first symbol of a run that is no letter
    s = s[keep].astype(np.int32)
    seen[s] = 1
    two = s[:-1] * 64 + s[1:]
    seen[FIRST[1] + two] = 1
    seen[FIRST[2] + two[:-1] * 64 + s[2:]] = 1
    return True


class Model:
    """Landmark n-grams and the weights of each language; small arrays that go to every task."""

    def __init__(self, languages: list[str], vocabulary: np.ndarray, landmarks: np.ndarray, size: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.vocabulary, self.landmarks = languages, vocabulary, landmarks
        self.size, self.weights, self.bias = size, weights, bias
        self.floor = -np.inf

    def kernel(self, present: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (present @ self.landmarks) / np.sqrt(np.maximum(size, 1)[:, None] * self.size[None, :])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Label, score, and whether a learned language fits: the winning decision value is not below the floor."""
        label, score, fits = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if not self.languages:
            return label, score, fits
        seen = np.zeros(GRAMS, np.uint8)
        for at in range(0, len(texts), BATCH):
            part = texts[at: at + BATCH]
            present, size, rows = np.zeros((len(part), len(self.vocabulary)), np.float32), np.zeros(len(part)), []
            for k, text in enumerate(part):
                if text and grams(text, seen):
                    present[k] = seen[self.vocabulary]
                    size[k] = np.count_nonzero(seen)
                    seen[:] = 0
                    rows.append(k)
            f = self.kernel(present[rows], size[rows]) @ self.weights + self.bias
            p = np.exp(SHARPNESS * (f - f.max(axis=1, keepdims=True)))
            p /= p.sum(axis=1, keepdims=True)
            held = (f.max(axis=1) >= self.floor) | (size[rows] < EVIDENCE)
            for k, best, q, fit in zip(rows, p.argmax(axis=1), p.max(axis=1), held):
                label[at + k], score[at + k], fits[at + k] = self.languages[best], q, fit
        return label, score, fits


def sample(docs: DataFrame, learn: Column, key: str, text: str, lang: str, per_language: int) -> list:
    """At most `per_language` rows of each language as (lang, sorted gram codes)."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(GRAMS, np.uint8)
        for batch in stream:
            kept, codes = [], []
            for k, value in enumerate(batch.column(1).to_pylist()):
                if grams(value, seen):
                    kept.append(k)
                    codes.append(np.flatnonzero(seen).astype("<i4").tobytes())
                seen[:] = 0
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(codes, pa.binary())], ["lang", "codes"])

    # a draw below twice the wanted share first, so that few rows are ranked; the ranking then holds the bound
    draw = F.shiftrightunsigned(F.xxhash64("key"), 11) / float(2**53)
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).cast("string").alias("key")
    )
    counts = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError("more labels than a one-versus-rest model is made for")
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], 2.0 * per_language / r["count"])])
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), F.xxhash64("text"))
    rows = (
        rows.where(draw < share[F.col("lang")])
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    )
    taken = rows.select("lang", "text").mapInArrow(task, "lang string, codes binary").collect()
    return sorted((r["lang"], bytes(r["codes"])) for r in taken)


def train(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on the rows where `learn` holds. What reaches the driver is bounded by the sample and the alphabet."""
    taken = [(name, np.frombuffer(codes, "<i4")) for name, codes in sample(docs, learn, key, text, lang, per_language)]
    languages = sorted({name for name, _ in taken})
    if not languages:
        none = np.zeros(0)
        return Model([], none.astype(int), none.reshape(0, 0), none, none.reshape(0, 0), none)
    rng = np.random.default_rng(7)
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([
        rng.permutation([k for k, (n, _) in enumerate(taken) if n == name])[:each] for name in languages
    ]).astype(int)
    vocabulary = np.unique(np.concatenate([taken[k][1] for k in chosen]))

    def presence(codes: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(codes), len(vocabulary)), np.float32)
        for k, c in enumerate(codes):
            at = np.searchsorted(vocabulary, c).clip(0, len(vocabulary) - 1)
            out[k, at[vocabulary[at] == c]] = 1
        return out

    marks = presence([taken[k][1] for k in chosen]).T.copy()
    size = np.array([len(taken[k][1]) for k in chosen], float)
    model = Model(languages, vocabulary, marks, size, np.zeros((0, 0)), np.zeros(0))
    values = np.concatenate([
        model.kernel(presence([c for _, c in taken[a: a + BATCH]]), np.array([len(c) for _, c in taken[a: a + BATCH]], float))
        for a in range(0, len(taken), BATCH)
    ])
    own = model.kernel(marks.T, size)
    root, axes = np.linalg.eigh((own + own.T) / 2)
    good = root > 1e-6 * root.max()
    whiten = axes[:, good] / np.sqrt(root[good])
    phi = values @ whiten
    label = np.array([languages.index(name) for name, _ in taken])
    target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    balance = (1 / np.bincount(label, minlength=len(languages)))[label] * len(label) / len(languages)
    phi_bias = np.concatenate([phi, np.ones((len(phi), 1))], axis=1)
    gram = (phi_bias * balance[:, None]).T @ phi_bias + ridge * np.diag([*[1.0] * phi.shape[1], 0])
    solved = np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), (phi_bias * balance[:, None]).T @ target)
    model.weights, model.bias = whiten @ solved[:-1], solved[-1]
    own_value = (values @ model.weights + model.bias).max(axis=1)[[len(c) >= EVIDENCE for _, c in taken]]
    if len(languages) > 1 and len(own_value):
        model.floor = float(np.quantile(own_value, OWN_SHARE)) - MARGIN
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all, if None) with lang_pred, score and fits, which replace columns of these names. The prediction
    sees the text alone. `fits` is false for `und`, and for texts that no learned language fits."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score", "fits")]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*names, F.col(text).alias(fresh(docs, "__text")))

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            label, score, fits = sent.value.predict(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(label, pa.string()), pa.array(score), pa.array(fits)],
                [*names, "lang_pred", "score", "fits"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(task, f"{fields}, lang_pred string, score double, fits boolean")
