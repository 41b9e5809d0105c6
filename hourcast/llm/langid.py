"""Language identification of texts that may mix languages.

Training counts the character n-grams (one to four, with word ends) of every
training document per language, in hashed slots, and how often each language's
words stand in which script. A word's score per language is the log-probability
of its n-grams. Scripts narrow the candidates: a language that does not use the
word's script is all but excluded. A Viterbi path over a text's words, with a
penalty for each switch of language, labels spans; the language of most letters
is the text's. Paths are exact: where no stretch of words can pay for a switch,
the path is known to be constant and isn't computed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_of, text_slices, with_columns

WORD = re.compile(r"[^\W\d_]+")
SLOTS = 1 << 14
LONGEST = 4
_TIMES = np.random.default_rng(11).integers(1, 1 << 62, LONGEST + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# First code points of the Unicode ranges that tell scripts apart.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "asian"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "african"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"),
    (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS])
_NUMBERS = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def scripts_of(words: list[str]) -> np.ndarray:
    """Script number of each word's first letter."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _NUMBERS[np.searchsorted(_STARTS, first, side="right") - 1]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, index of the word) of all n-grams of the words, ends marked."""
    flat = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), "<u4").astype(np.uint64)
    blank = flat == 32
    before = np.concatenate([[0], np.cumsum(blank)])
    owner = before[1:] - 1
    slots, owners = [], []
    for n in range(1, LONGEST + 1):
        size = len(flat) - n + 1
        if size <= 0:
            break
        h = np.full(size, _TIMES[0] * np.uint64(n), np.uint64)
        for j in range(n):
            h += flat[j : j + size] * _TIMES[j + 1]
        h ^= h >> np.uint64(29)
        h *= _TIMES[0]
        inside = before[n - 1 : n - 1 + size] - before[1 : 1 + size] if n > 1 else blank[:size].astype(int)
        good = inside <= 0
        slots.append((h[good] >> np.uint64(50)).astype(np.int64) % SLOTS)
        owners.append(owner[:size][good])
    return np.concatenate(slots), np.concatenate(owners)


@dataclass
class LanguageModel:
    """Languages, log-probability by (language, slot) and by (language, script)."""

    langs: list[str]
    logp: np.ndarray
    scripts: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Score of each word in each language."""
        out = np.zeros((len(words), len(self.langs)))
        if words:
            slots, owner = grams(words)
            for k in range(len(self.langs)):
                out[:, k] = np.bincount(owner, self.logp[k, slots], len(words))
            out += self.scripts[:, scripts_of(words)].T
        return out


def train(docs: DataFrame, smooth: float = 0.5, least_share: float = 0.005) -> LanguageModel:
    """Count over all rows (text, lang); rows with a null text or lang teach
    nothing. The model has ``SLOTS`` numbers a language."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch, texts in text_slices(batches):
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), texts):
                words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            for lang, counter in words.items():
                if counter:
                    distinct = list(counter)
                    times = np.fromiter(counter.values(), np.float64, len(distinct))
                    slots, owner = grams(distinct)
                    sums = np.concatenate([np.bincount(slots, times[owner], SLOTS), np.bincount(scripts_of(distinct), times, len(SCRIPT_NAMES))])
                    found[lang] = found[lang] + sums if lang in found else sums
        for lang, sums in found.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "slot": pa.array(at, pa.int32()), "n": pa.array(sums[at].astype(np.int64))})

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = counted.column("lang").to_pylist()
    langs = sorted(set(names))
    sums = np.zeros((len(langs), SLOTS + len(SCRIPT_NAMES)))
    at = {lang: k for k, lang in enumerate(langs)}
    if langs:
        sums[[at[x] for x in names], counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    by_slot, by_script = sums[:, :SLOTS] + smooth, sums[:, SLOTS:]
    logp = np.log(by_slot / by_slot.sum(axis=1, keepdims=True))
    used = by_script / np.maximum(by_script.sum(axis=1, keepdims=True), 1) >= least_share
    excluded = np.where(used | ~used.any(axis=0, keepdims=True), 0.0, -40.0)
    return LanguageModel(langs, logp.astype(np.float32), excluded)


def path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word, a switch between words costing ``penalty``."""
    best = int(scores.sum(axis=0).argmax())
    lead = scores - scores[:, best : best + 1]
    gain = np.cumsum(lead, axis=0)
    lowest = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gain[:-1]]), axis=0)
    # A path that holds ``best`` somewhere pays one switch or more for each stretch
    # in another language; one that never holds it wins at most the sum of leads.
    lead[:, best] = -np.inf
    if (gain - lowest).max() <= penalty and lead.max(axis=1).sum() <= 0:
        return np.full(len(scores), best)
    steps = scores.tolist()
    now, came = steps[0], []
    for step in steps[1:]:
        top = max(now)
        leader, floor = now.index(top), top - penalty
        came.append([k if v >= floor else leader for k, v in enumerate(now)])
        now = [(v if v >= floor else floor) + s for v, s in zip(now, step)]
    at = now.index(max(now))
    out = [at]
    for back in reversed(came):
        at = back[at]
        out.append(at)
    return np.array(out[::-1])


SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",), penalty: float = 16.0, temper: float = 0.15) -> DataFrame:
    """Language of every whole text.

    Returns the columns ``keep``, lang_pred, score (share of the letters in spans
    of that language times the tempered probability of the language against the
    next on them) and spans (code points, in order; more than one if the text
    mixes languages), one row per input row. Null texts, texts without a letter,
    and all texts if nothing was learned, are ``und`` with score 0 and no spans.
    Ties go to the first language in code-point order; other columns are ignored."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # languages x SLOTS numbers

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
        for batch, texts in text_slices(batches, "_text"):
            ids: dict[str, int] = {}
            rows = [[ids.setdefault(w, len(ids)) for w in WORD.findall(t.lower())] for t in texts]
            distinct = list(ids)
            table = model.scores(distinct)
            sizes = np.fromiter(map(len, distinct), np.float64, len(distinct))
            preds, scores, spans = [], [], []
            for text, row in zip(texts, rows):
                if not row or not model.langs:
                    preds.append("und")
                    scores.append(0.0)
                    spans.append([])
                    continue
                at = np.array(row)
                steps = table[at]
                labels = path(steps, penalty)
                letters = np.bincount(labels, sizes[at], len(model.langs))
                top = int(letters.argmax())
                mine = labels == top
                totals = steps[mine].sum(axis=0)
                margin = totals[top] - np.delete(totals, top).max() if len(totals) > 1 else 100.0
                preds.append(model.langs[top])
                scores.append(float(letters[top] / letters.sum() / (1 + np.exp(-np.clip(margin * temper, -50, 50)))))
                spans.append([{"start": 0, "end": len(text), "lang": model.langs[top]}] if mine.all() else list(_spans(text, labels, model.langs)))
            yield with_columns(batch, {"_text"}, lang_pred=pa.array(preds, pa.string()), score=pa.array(scores, pa.float64()), spans=pa.array(spans, pa.list_(span)))

    rows = docs.select(*keep, text_of(F.col("text")).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema.fields)
    return rows.mapInArrow(label, f"{kept}, lang_pred string, score double, spans {SPANS}")


def _spans(text: str, labels: np.ndarray, langs: list[str]) -> Iterator[dict]:
    lower = text.lower()
    places = [m.start() for m in WORD.finditer(lower if len(lower) == len(text) else text)][: len(labels)]
    cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist()]
    cuts = [c for c in cuts if c < len(places)]
    starts = [0, *(places[c] for c in cuts[1:])]
    for c, a, b in zip(cuts, starts, [*starts[1:], len(text)]):
        yield {"start": a, "end": b, "lang": langs[labels[c]]}

