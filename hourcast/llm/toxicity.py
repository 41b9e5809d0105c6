"""Toxicity scores by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of three rows of a hashed table: of the word, and
of its first four and first five letters. Filters of several widths run over the
words of the whole text; each filter keeps its largest value. A linear layer on
these gives a logit. Thresholds on the logit are calibrated by language, where
the language is guessed from the text's own function words, and the score is the
logistic function of the distance to the threshold, so that 0.5 is the threshold
of every language.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import crc_fold, ship, text_of, text_slices, with_columns

WORD = re.compile(r"\w+")
SLOTS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 16, (1, 2, 3)
STRETCH = 50_000  # words of a text that are convolved at a time

# Common function words of some languages, to tell them apart.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht ein eine zu mit von den im auf dem des sich auch",
    "en": "the and of to is that it in for was on are with this be by not an",
    "es": "el los las que y del una por con para se no su al como lo",
    "fr": "le les des et est une dans pour que qui pas au sur avec ce ne du",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
_VOTES = {w: [lang for lang, ws in FUNCTION_WORDS.items() if w in ws.split()] for ws in FUNCTION_WORDS.values() for w in ws.split()}


class WordSlots(dict):
    """Table rows of words, kept up to a fixed number."""

    def __missing__(self, word: str) -> tuple[int, int, int]:
        if len(self) >= 300_000:
            self.clear()
        found = self[word] = tuple(zlib.crc32(x.encode()) % SLOTS for x in (word, "4 " + word[:4], "5 " + word[:5]))
        return found


WORDS = WordSlots()


def guess_language(counts: dict[str, int] | list[str]) -> int:
    votes = dict.fromkeys(FUNCTION_WORDS, 0)
    for w in counts:
        for lang in _VOTES.get(w, ()):
            votes[lang] += 1
    best = max(votes, key=votes.get)
    return LANGUAGES.index(best if votes[best] else "other")


@dataclass
class Batch:
    """Texts as one sequence of distinct-word numbers, each stretch followed by
    blanks (number 0, a zero embedding) that keep the filters inside it."""

    slots: np.ndarray
    order: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    texts: int
    langs: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Batch:
        ids: dict[str, int] = {}
        order, starts, ends, owner, langs = [], [], [], [], []
        pad = [0] * (max(WIDTHS) - 1)
        for k, text in enumerate(texts):
            words = WORD.findall(text.lower())
            langs.append(guess_language(words))
            row = [ids.setdefault(w, len(ids) + 1) for w in words] or [0]
            for a in range(0, len(row), STRETCH):
                part = row[max(0, a - max(WIDTHS) + 1) : a + STRETCH]
                starts.append(len(order))
                order += part
                ends.append(len(order))
                owner.append(k)
                order += pad
        slots = np.array([WORDS[w] for w in ids], np.int64).reshape(-1, 3)
        return cls(slots, np.array(order, np.int64), np.array(starts, np.int64), np.array(ends, np.int64), np.array(owner, np.int64), len(texts), np.array(langs, np.int64))


@dataclass
class ToxicityModel:
    table: np.ndarray
    filters: list[np.ndarray]  # by width: (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    slope: float = 1.0

    def embed(self, batch: Batch) -> np.ndarray:
        words = self.table[batch.slots].sum(axis=1) if len(batch.slots) else np.empty((0, DIM), np.float32)
        return np.vstack([np.zeros((1, DIM), np.float32), words]).astype(np.float32)

    def responses(self, batch: Batch, words: np.ndarray) -> Iterator[np.ndarray]:
        """By width: the filters' values at every place of the sequence."""
        n = len(batch.order)
        for w, kernel in zip(WIDTHS, self.filters):
            z = np.zeros((n, FILTERS), np.float32)
            for k in range(w):
                part = (words @ kernel[k])[batch.order[k:]]
                z[: n - k] += part
            yield z

    def pooled(self, batch: Batch) -> np.ndarray:
        words = self.embed(batch)
        cuts = np.stack([batch.starts, batch.ends], axis=1).ravel()
        parts = np.hstack([np.maximum.reduceat(z, cuts, axis=0)[::2] for z in self.responses(batch, words)])
        out = np.full((batch.texts, parts.shape[1]), -np.inf, np.float32)
        np.maximum.at(out, batch.owner, parts)
        return np.maximum(out + self.bias, 0)

    def logits(self, batch: Batch) -> np.ndarray:
        return self.pooled(batch) @ self.out + self.out_bias

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        batch = Batch.of(texts)
        x = self.slope * (self.logits(batch) - self.thresholds[batch.langs])
        return 1 / (1 + np.exp(-np.clip(x, -50, 50))), batch.langs


def fit(texts: list[str], labels: np.ndarray, epochs: int = 8, step: float = 0.08, size: int = 32, seed: int = 5) -> ToxicityModel:
    """Train on texts and 0/1 labels (a fifth is kept for the thresholds)."""
    rng = np.random.default_rng(seed)
    k = FILTERS * len(WIDTHS)
    model = ToxicityModel((rng.normal(0, 0.1, (SLOTS, DIM))).astype(np.float32), [rng.normal(0, 0.25, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                          np.zeros(k, np.float32), rng.normal(0, 0.1, k).astype(np.float32), 0.0)
    labels = np.asarray(labels, np.float32)
    if len(texts) == 0 or labels.min() == labels.max():
        model.out[:] = 0
        model.out_bias = -3.0 if len(texts) == 0 or labels.max() == 0 else 3.0
        return model
    shuffled = rng.permutation(len(texts))
    held, learn = shuffled[::5], np.delete(shuffled, np.s_[::5])
    squares = {name: np.full_like(x, 1e-3) for name, x in (("table", model.table), ("out", model.out), ("bias", model.bias))}
    kernel_squares, bias_square = [np.full_like(x, 1e-3) for x in model.filters], 1e-3
    weight = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    batches = [(Batch.of([texts[i] for i in part]), part) for part in np.array_split(learn, max(1, len(learn) // size))]
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            batch, part = batches[b]
            words = model.embed(batch)
            tops, places = [], []
            for z in model.responses(batch, words):
                at = np.stack([z[s:e].argmax(axis=0) + s for s, e in zip(batch.starts, batch.ends)])
                top = np.take_along_axis(z, at, 0)
                if len(at) > batch.texts:  # long texts came in stretches
                    best = np.array([np.flatnonzero(batch.owner == d)[top[batch.owner == d].argmax(axis=0)] for d in range(batch.texts)])
                    at, top = np.take_along_axis(at, best, 0), np.take_along_axis(top, best, 0)
                tops.append(top)
                places.append(at)
            pre = np.hstack(tops) + model.bias
            pooled = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.out_bias, -30, 30)))
            g = ((p - labels[part]) * weight[part] / len(part)).astype(np.float32)
            hidden = (g[:, None] * model.out) * (pre > 0)
            grads = {"out": pooled.T @ g, "bias": hidden.sum(axis=0)}
            rows, values = [], []
            for j, (w, kernel) in enumerate(zip(WIDTHS, model.filters)):
                gj = hidden[:, j * FILTERS : (j + 1) * FILTERS]
                change = np.zeros_like(kernel)
                for o in range(w):
                    ids = batch.order[np.minimum(places[j] + o, len(batch.order) - 1)]
                    change[o] = np.einsum("bfd,bf->df", words[ids], gj)
                    real = (ids > 0) & (gj != 0)
                    rows.append(batch.slots[ids[real] - 1])
                    values.append((gj[..., None] * kernel[o].T[None])[real])
                kernel_squares[j] += change * change
                kernel -= step * change / np.sqrt(kernel_squares[j])
            rows, values = np.vstack(rows), np.vstack(values)
            if len(rows):
                at, back = np.unique(rows.ravel(), return_inverse=True)
                total = np.zeros((len(at), DIM), np.float32)
                np.add.at(total, back, np.repeat(values, 3, axis=0))
                squares["table"][at] += total * total
                model.table[at] -= step * total / np.sqrt(squares["table"][at])
            for name, change in grads.items():
                squares[name] += change * change
                getattr(model, name)[:] -= step * change / np.sqrt(squares[name])
            bias_square += float(g.sum()) ** 2
            model.out_bias -= step * float(g.sum()) / bias_square**0.5
    calibrate(model, [texts[i] for i in held], labels[held])
    return model


def calibrate(model: ToxicityModel, texts: list[str], labels: np.ndarray) -> None:
    """Threshold of each guessed language with the fewest errors (labels weighted
    to count alike), in the middle of the widest such gap; all languages' own
    threshold where a language has too few labels of either kind."""
    parts = [Batch.of(texts[i : i + 64]) for i in range(0, len(texts), 64)]
    logits, langs = np.concatenate([model.logits(b) for b in parts]), np.concatenate([b.langs for b in parts])

    def threshold(x: np.ndarray, y: np.ndarray) -> float:
        order = np.argsort(x)
        x, y = x[order], y[order]
        ones, zeros = max(y.sum(), 1), max((1 - y).sum(), 1)
        errors = np.concatenate([[0], np.cumsum(y / ones)]) + np.concatenate([np.cumsum(((1 - y) / zeros)[::-1])[::-1], [0]])
        cuts = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
        gaps = np.concatenate([[2], np.diff(x), [2]])
        good = np.flatnonzero(errors <= errors.min() + 1e-9)
        return float(cuts[good[gaps[good].argmax()]])

    common = threshold(logits, labels)
    model.thresholds = np.full(len(LANGUAGES), common)
    for k in range(len(LANGUAGES)):
        mine = langs == k
        if min(labels[mine].sum(), (1 - labels[mine]).sum()) >= 10:
            model.thresholds[k] = threshold(logits[mine], labels[mine])
    slopes = np.array([0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0])
    x = logits - model.thresholds[langs]
    losses = [np.log1p(np.exp(-np.clip(np.where(labels > 0, s * x, -s * x), -50, 50))).mean() for s in slopes]
    model.slope = float(slopes[int(np.argmin(losses))])


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int = 3000, longest: int = 20_000) -> tuple[list[str], np.ndarray]:
    """Up to ``most`` labelled texts of each label, none longer than ``longest``
    characters: the bound of what the driver holds. ``labels`` has the rows that
    may teach (doc_id and label).

    A document is an id: repeated labels count once, an id with both labels
    teaches nothing, and of several texts under an id the one with the smallest
    hash teaches. Which ids: the smallest by a hash of the id. Null ids, and
    labels other than 0 and 1, teach nothing."""
    spread = F.xxhash64("doc_id", F.lit("sample"))
    wanted = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.col(label).cast("int")).alias("_label"), F.max(F.col(label).cast("int")).alias("_other"))
    wanted = wanted.where(F.col("_label") == F.col("_other"))
    picks = [wanted.where(F.col("_label") == y).withColumn("_spread", spread).orderBy("_spread", "doc_id").limit(most) for y in (0, 1)]
    # At most 2 x ``most`` rows of two numbers.
    chosen = F.broadcast(picks[0].unionByName(picks[1]).select(F.col("doc_id").alias("_id"), "_label"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).where(F.length("text") <= longest)
    # One text for each id, chosen before anything leaves the tasks.
    texts = rows.join(chosen, F.col("doc_id") == F.col("_id")).groupBy("doc_id", "_label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    found = texts.toArrow().to_pylist()
    found.sort(key=lambda r: (r["doc_id"], r["_label"], r["text"]))
    return [r["text"] for r in found], np.array([r["_label"] for r in found], np.int64)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1), threshold_language, one row per input row.

    Null and empty texts get the score of a text without words; a null doc_id
    stays null; repeated rows score alike; other columns are ignored."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, limit=1 << 20):
            scores, langs = shared.value.scores(texts)
            yield with_columns(batch, {"text"}, score=pa.array(scores.astype(np.float64)), threshold_language=pa.array([LANGUAGES[k] for k in langs], pa.string()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, threshold_language string")


def teaching(labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    return labels.where(crc_fold(F.col("doc_id"), folds) != held_out)


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return crc_fold(doc_id, folds) == fold
