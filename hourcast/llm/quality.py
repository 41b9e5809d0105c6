"""Document quality by random-indexing word vectors and a small neural network.

Every word slot has a fixed sparse ternary index vector. A slot's word vector is
the sum, over all documents, of the index vectors of the words around it: one
pass of Spark tasks sums them, and the sums of tasks are added by slot. Besides
its words a text has a second sequence, the shapes of its words (case, length,
kind, repetition of the word before), which gets vectors in the same way.

A document pools the vectors of both sequences (means). A network of two layers,
trained in numpy on a bounded sample of labelled documents, gives the logit; its
temperature is fitted on labelled documents kept from training.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_of, text_slices, with_columns

TOKEN = re.compile(r"\w+|[^\w\s]+")
SLOTS, DIM, NONZERO, HIDDEN = 1 << 13, 32, 4, 32
BLANK = SLOTS  # stands between documents; its index vector is zero

_rng = np.random.default_rng(77)
INDEX_AT = _rng.integers(0, DIM, (SLOTS + 1, NONZERO))
INDEX_SIGN = _rng.choice([-1.0, 1.0], (SLOTS + 1, NONZERO))
INDEX_SIGN[BLANK] = 0.0


def shape(token: str) -> str:
    if token[0].isalnum() or token[0] == "_":
        kind = "number" if token.isdigit() else "capital" if token.isupper() else "title" if token[0].isupper() else "lower" if token.islower() else "mixed"
        return f"{kind} {min(len(token), 15) // 3}"
    return f"mark {token[0]} {min(len(token), 4)}"


class TokenSlots(dict):
    """(slot of the word, slot of its shape), kept up to a fixed number."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= 300_000:
            self.clear()
        found = self[token] = (zlib.crc32(token.lower().encode()) % SLOTS, zlib.crc32(b"shape " + shape(token).encode()) % SLOTS)
        return found


TOKENS = TokenSlots()
AGAIN = zlib.crc32(b"shape again") % SLOTS


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word slots, shape slots, start of each text) of texts end to end, each
    followed by two blanks."""
    flat, starts, n = [], [], 0
    for text in texts:
        tokens = TOKEN.findall(text)
        starts.append(n)
        flat += map(TOKENS.__getitem__, tokens)
        flat += ((BLANK, BLANK), (BLANK, BLANK))
        n += len(tokens) + 2
    both = np.array(flat, np.int64).reshape(-1, 2)
    words, shapes = both[:, 0], both[:, 1].copy()
    shapes[1:][(words[1:] == words[:-1]) & (words[1:] != BLANK)] = AGAIN
    return words, shapes, np.array(starts, np.int64)


def context_sums(row: np.ndarray, window: int = 2) -> np.ndarray:
    """Sum of the index vectors within ``window`` places, by slot."""
    out = np.zeros((SLOTS + 1) * DIM)
    for d in range(1, window + 1):
        for here, there in ((row[:-d], row[d:]), (row[d:], row[:-d])):
            at = (here * DIM)[:, None] + INDEX_AT[there]
            out += np.bincount(at.ravel(), INDEX_SIGN[there].ravel(), len(out))
    return out.reshape(SLOTS + 1, DIM)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all slots, of length one (SLOTS + 1 rows), over all documents.
    Each task sums its own rows; the driver receives one row per slot."""
    ship(docs.sparkSession)
    columns = [f"c{i}" for i in range(DIM)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SLOTS + 1, DIM))
        for _, texts in text_slices(batches, limit=1 << 20):
            words, shapes, _ = sequences(texts)
            total += context_sums(words) + context_sums(shapes)
        at = np.flatnonzero(total[:BLANK].any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(total[at, i].astype(np.int64)) for i in range(DIM))], names=["slot", *columns])

    rows = docs.select(text_of(F.col("text")).alias("text"))
    schema = "slot int, " + ", ".join(f"{c} long" for c in columns)
    sums = rows.mapInArrow(count, schema).groupBy("slot").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = np.zeros((SLOTS + 1, DIM))
    if sums.num_rows:
        out[sums.column("slot").to_numpy()] = np.stack([sums.column(c).to_numpy() for c in columns], axis=1)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(length > 0, length, 1)).astype(np.float32)


def pool(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Means of the word and the shape vectors of each text, and the logarithm
    of its number of words."""
    words, shapes, starts = sequences(texts)
    counts = np.diff(np.append(starts, len(words))) - 2
    scale = 1 / np.maximum(counts, 1)[:, None]
    parts = [np.add.reduceat(vectors[x], starts, axis=0, dtype=np.float64) * scale for x in (words, shapes)]
    return np.hstack([*parts, np.log1p(counts)[:, None]])


@dataclass
class QualityModel:
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.spread @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pool(texts, self.vectors)) / self.temperature, -50, 50)))


def fit(texts: list[str], labels: np.ndarray, vectors: np.ndarray, epochs: int = 60, step: float = 0.01, size: int = 64, seed: int = 3) -> QualityModel:
    """Train on texts and 0/1 labels (a fifth is kept for the temperature)."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float64)
    width = 2 * DIM + 1
    model = QualityModel(vectors, np.zeros(width), np.ones(width), rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), 0.0)
    if len(texts) == 0 or labels.min() == labels.max():
        model.w2[:] = 0
        model.b2 = 3.0 if len(texts) == 0 or labels.max() > 0 else -3.0
        return model
    x = np.vstack([pool(texts[i : i + 256], vectors) for i in range(0, len(texts), 256)])
    shuffled = rng.permutation(len(texts))
    held, learn = shuffled[::5], np.delete(shuffled, np.s_[::5])
    model.mean, model.spread = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-6
    z = (x - model.mean) / model.spread
    params = {"w1": model.w1, "b1": model.b1, "w2": model.w2, "b2": np.zeros(1)}
    first, second, t = {k: np.zeros_like(v) for k, v in params.items()}, {k: np.zeros_like(v) for k, v in params.items()}, 0
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(learn), max(1, len(learn) // size)):
            a = z[part] @ params["w1"] + params["b1"]
            h = np.maximum(a, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ params["w2"] + params["b2"], -30, 30)))
            g = (p - labels[part]) / len(part)
            back = np.outer(g, params["w2"]) * (a > 0)
            grads = {"w1": z[part].T @ back + 1e-4 * params["w1"], "b1": back.sum(axis=0), "w2": h.T @ g + 1e-4 * params["w2"], "b2": np.array([g.sum()])}
            t += 1
            for k, grad in grads.items():  # Adam
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                params[k] -= step * (0.3 if epoch > epochs * 2 // 3 else 1) * first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    model.b2 = float(params["b2"][0])
    logits, y = model.logits(x[held]), labels[held]
    temperatures = np.geomspace(0.25, 8, 41)
    losses = [np.log1p(np.exp(-np.clip(np.where(y > 0, logits, -logits) / s, -50, 50))).mean() for s in temperatures]
    model.temperature = float(temperatures[int(np.argmin(losses))])
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: better), one row per input row.

    Null and empty texts get the score of a text without words; a null doc_id
    stays null; repeated rows score alike; other columns are ignored."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, limit=1 << 20):
            yield with_columns(batch, {"text"}, score=pa.array(shared.value.scores(texts)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
