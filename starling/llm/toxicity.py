"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct words (lower-cased, punctuation at the ends
removed) and their first four and five characters, each hashed to 32 bits; a
stem that is inflected or lengthened still shares a term.  The score is the
sigmoid of a factorization machine over term presence: a bias, a weight per
term, and for each pair of terms the dot product of their factors, so a pair
(an insult with a mention of a group) can weigh more than its parts.

Training runs on the driver over a bounded sample of labelled rows: at most
about ``MAX_ROWS`` documents, chosen by hash.  Terms seen in fewer than
``MIN_ROWS`` of them, or whose presence says little about the label (chi-square
below ``MIN_CHI2``), are left out; weights follow AdaGrad with an L1 proximal
step; factors count only for terms with a weight.  The model (a few thousand terms) is sent to the tasks.  Labels,
language, source and id are never inputs of a score.

Scoring reads every whole text.  A task looks each distinct word up once and
keeps the active terms it has (for most words none), in a cache of bounded
size.

Defined cases: a null or empty text has no terms and scores the bias; a null
label or id is not used for training; without a positive and a negative label
the score is the mean label (or one half); repeated rows are scored alike; an
empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starling.llm.common import text_or_empty

MAX_ROWS, MIN_ROWS, MIN_CHI2 = 20_000, 3, 16.0
FACTORS, EPOCHS, BATCH, SEED = 4, 30, 256, 11
L1, L2_FACTORS, STEP_SIZE = 2.0e-4, 1.0e-3, 0.3
CACHE_WORDS, STEP = 200_000, 512
PREFIXES = (4, 5)
DECISION = 0.7  # the score from which a text counts as toxic
_STRIP = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "…«»“”‘’¡¿"


def word_terms(word: str) -> bytes:
    """The hashed terms of one word, as little-endian unsigned 32-bit numbers."""
    w = word.strip(_STRIP)
    if not w:
        return b""
    terms = [zlib.crc32(b"w" + w.encode())]
    terms += [zlib.crc32(b"p" + w[:k].encode()) for k in PREFIXES if len(w) > k]
    return np.array(terms, dtype="<u4").tobytes()


def text_terms(text: str) -> np.ndarray:
    """The distinct hashed terms of a text, in order."""
    return np.unique(np.frombuffer(b"".join(map(word_terms, set(text.lower().split()))), dtype="<u4"))


@dataclass
class Model:
    """A factorization machine over active terms (sorted hashes)."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def active(self, terms: np.ndarray) -> np.ndarray:
        """Positions of the active ones among ``terms``."""
        if not len(self.terms) or not len(terms):
            return np.empty(0, dtype=np.int64)
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return at[self.terms[at] == terms]

    def raw(self, at: np.ndarray) -> float:
        """Bias, weights and pairwise factors of a text whose distinct active terms are at these positions."""
        if not len(at):
            return self.bias
        v = self.factors[at]
        return self.bias + float(self.weights[at].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum())

    def score(self, at: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(at), -35.0, 35.0))))


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, factors: int = FACTORS,
        min_rows: int = MIN_ROWS, seed: int = SEED) -> Model:
    """Train on the distinct terms of each document and its 0/1 label."""
    none = np.empty(0, dtype=np.uint32)
    y = np.asarray(labels, dtype=float)
    mean = float(y.mean()) if len(y) else 0.5
    prior = float(np.log(max(mean, 1e-6) / max(1 - mean, 1e-6)))
    if not len(y) or mean in (0.0, 1.0):
        return Model(prior, none, np.empty(0), np.empty((0, factors)))
    terms, counts = np.unique(np.concatenate(rows), return_counts=True)
    hits = np.zeros(len(terms))
    for r, label in zip(rows, y):
        if label:
            hits[np.searchsorted(terms, r)] += 1
    expected = counts * mean  # chi-square of presence against the label, one degree of freedom
    spread = expected * (1 - mean) * (1 - counts / len(y)).clip(1e-9)
    terms = terms[(counts >= min_rows) & ((hits - expected) ** 2 >= MIN_CHI2 * spread)]
    empty = Model(prior, terms, np.zeros(len(terms)), np.zeros((len(terms), factors)))
    data = [empty.active(r) for r in rows]
    rng = np.random.default_rng(seed)
    m = len(terms)
    bias, w, v = prior, np.zeros(m), rng.normal(0, 0.01, (m, factors))
    sw, sv, sb = np.full(m, 1e-8), np.full((m, factors), 1e-8), 1e-8
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            size = np.array([len(data[i]) for i in pick])
            ids = np.concatenate([data[i] for i in pick]) if size.sum() else np.empty(0, dtype=np.int64)
            row = np.repeat(np.arange(len(pick)), size)
            use = w[ids] != 0  # factors count only for terms with a weight
            vi = v[ids] * use[:, None]
            sums = np.zeros((len(pick), factors))
            np.add.at(sums, row[use], vi[use])
            squares = np.bincount(row, (vi ** 2).sum(axis=1), len(pick))
            z = bias + np.bincount(row, w[ids], len(pick)) + 0.5 * ((sums ** 2).sum(axis=1) - squares)
            miss = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[pick]
            g = np.bincount(ids, miss[row], m) / len(pick)
            seen = np.flatnonzero(np.bincount(ids, minlength=m))
            sw[seen] += g[seen] ** 2
            rate = STEP_SIZE / np.sqrt(sw[seen])
            moved = w[seen] - rate * g[seen]
            w[seen] = np.sign(moved) * np.maximum(np.abs(moved) - rate * L1, 0)
            if use.any():
                touched, inverse = np.unique(ids[use], return_inverse=True)
                part = np.zeros((len(touched), factors))
                np.add.at(part, inverse, miss[row[use], None] * (sums[row[use]] - vi[use]))
                part = part / len(pick) + L2_FACTORS * v[touched]
                sv[touched] += part ** 2
                v[touched] -= 0.5 * STEP_SIZE * part / np.sqrt(sv[touched])
            sb += miss.mean() ** 2
            bias -= 0.5 * STEP_SIZE * miss.mean() / np.sqrt(sb)
    live = np.flatnonzero(w)
    model = Model(float(bias), terms[live], w[live], v[live])
    return calibrated(model, np.array([model.raw(model.active(r)) for r in rows]), y)


def calibrated(model: Model, z: np.ndarray, y: np.ndarray) -> Model:
    """Shift the bias so that ``DECISION`` is the score where the training rows are told apart best.

    Of the cuts with the fewest errors, the middle of the widest gap is taken.
    """
    values = np.unique(z)
    if len(values) < 2:
        return model
    positive, negative = np.sort(z[y == 1]), np.sort(z[y == 0])
    cuts = (values[1:] + values[:-1]) / 2
    errors = np.searchsorted(positive, cuts) + len(negative) - np.searchsorted(negative, cuts)
    best = np.flatnonzero(errors == errors.min())
    cut = cuts[best[np.argmax((values[1:] - values[:-1])[best])]]
    return replace(model, bias=model.bias - float(cut) + float(np.log(DECISION / (1 - DECISION))))


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", max_rows: int = MAX_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """Terms and labels of a hash sample of about ``max_rows`` labelled documents that are ``usable``."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isNotNull() & F.col("id").isNotNull() & usable)
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(n)) < max_rows)
    picked = F.broadcast(known.select("id", "y"))  # about max_rows rows at most
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(picked, "id")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                terms = [text_terms(t).tobytes() for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").cast(pa.string()), piece.column("y"), pa.array(terms, pa.binary())],
                    names=["id", "y", "terms"])

    table = texts.select("id", "y", "text").mapInArrow(run, "id string, y int, terms binary").toArrow()
    rows = sorted(zip(table.column("id").to_pylist(), table.column("y").to_pylist(), table.column("terms").to_pylist()))
    return [np.frombuffer(t, dtype="<u4") for _, _, t in rows], np.array([y for _, y, _ in rows], dtype=float)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        cache: dict[str, bytes] = {}
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                out = []
                for text in piece.column("text").to_pylist():
                    words = set(text.lower().split())
                    new = words.difference(cache)
                    if len(cache) + len(new) > CACHE_WORDS:
                        cache.clear()
                        new = words
                    for word in new:
                        cache[word] = model.active(np.frombuffer(word_terms(word), dtype="<u4")).astype("<i4").tobytes()
                    at_terms = np.frombuffer(b"".join(map(cache.__getitem__, words)), dtype="<i4")
                    out.append(model.score(np.unique(at_terms)))
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(out, pa.float64())], names=["id", "score"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)
