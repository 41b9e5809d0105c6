"""Removal of passages that repeat, by sliding runs of consecutive sentences.

A text is cut into sentences. Every sentence starts one run and ends one run of
consecutive sentences that is just long enough to hold ``least_words`` words.
Runs are hashed (a polynomial over the hashes of their sentences) and met
globally by hash: the first run of each hash, in the order of doc_id and place,
stays; sentences covered by any other run of that hash go.

The first runs are minima under partial aggregation, so a run that a third of all
documents share is reduced before it is shuffled; the join back to the runs is an
ordinary join that Spark may split where it is skewed.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_hash, text_slices, with_columns, written

# Kinds of characters, as bits, by code point up to 0xFFFF (none above counts).
BLANK, BREAK, FINAL, WIDE_FINAL, UPPER, AFTER_UPPER = (1 << i for i in range(6))


def _kinds() -> np.ndarray:
    out = np.zeros(1 << 16, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        kind = unicodedata.category(c)
        out[i] |= BLANK * c.isspace() | BREAK * (c == "\n") | FINAL * (c in ".!?…") | WIDE_FINAL * (c in "。！？") | UPPER * (kind == "Lu")
        out[i] |= AFTER_UPPER * (kind == "Ll" or kind[0] == "P" or c.isspace())
    return out


KINDS = _kinds()
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def sentences(text: str) -> list[int]:
    """Start of each sentence, and the end of the text.

    A new sentence begins after white space that follows a final mark, holds a
    line break, or stands before a capitalised word (where a passage was put in
    without a final mark before it); and after a wide final mark."""
    if not text:
        return [0]
    kind = KINDS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 0xFFFF)]
    blank = (kind & BLANK) > 0
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    runs = np.concatenate([[0], edges]) if blank[0] else edges
    runs = runs[: len(runs) // 2 * 2].reshape(-1, 2)  # without a run at the end
    first, end = runs[:, 0], runs[:, 1]
    breaks = np.concatenate([[0], np.cumsum((kind & BREAK) > 0)])
    after = np.append(kind, 0)[end + 1]
    new = (breaks[end] > breaks[first]) | ((first > 0) & (kind[first - 1] & FINAL > 0)) | ((kind[end] & UPPER > 0) & (after & AFTER_UPPER > 0))
    wide = np.flatnonzero(((kind[:-1] & WIDE_FINAL) > 0) & ~blank[1:]) + 1
    starts = end[new]
    if len(wide):
        starts = np.union1d(starts, wide)
    return [0, *starts.tolist(), len(text)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


class Runs:
    """Runs of a text's sentences: hashes, first sentence, end."""

    def __init__(self, text: str, least_words: int):
        starts = sentences(text)
        parts = [text[a:b].lower().split() for a, b in zip(starts, starts[1:])]
        n = len(parts)
        words = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64) if n else np.zeros(1, np.int64)
        if words[-1] < least_words:
            self.first = self.end = np.empty(0, np.int64)
            self.hash = np.empty(0, np.uint64)
            return
        h = np.fromiter((xxhash.xxh64_intdigest(" ".join(p)) if p else 0 for p in parts), np.uint64, n)
        end = np.searchsorted(words, words[:-1] + least_words)
        forward = np.flatnonzero((end <= n) & (np.diff(words) > 0))
        first = np.searchsorted(words, words[1:] - least_words, side="right") - 1
        covered = np.zeros(n + 1, bool)
        covered[end[forward]] = True
        backward = np.flatnonzero((words[1:] >= least_words) & ~covered[1:] & (np.diff(words) > 0))
        self.first = np.concatenate([forward, first[backward]])
        self.end = np.concatenate([end[forward], backward + 1])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(BASE, n), dtype=np.uint64)])
        run = (sums[self.end] - sums[self.first]) * _powers(INVERSE, n + 1)[self.first] + (words[self.end] - words[self.first]).astype(np.uint64) * _STEP
        run ^= run >> np.uint64(31)
        run *= _STEP
        self.hash = run ^ (run >> np.uint64(29))


def document_key(doc_id: Column, text: Column) -> Column:
    """Order and name of a document: its id; rows without an id come after all
    others, by the hash of their text."""
    return F.coalesce(doc_id.cast("long"), F.lit(1 << 62) + F.pmod(text_hash(text), F.lit(1 << 61)))


def repeated_runs(docs: DataFrame, least_words: int) -> DataFrame:
    """(doc, hash, place) of every run that isn't the first of its hash. ``doc``
    and ``hash`` (of the text) name a document; ``place`` packs the run's first
    sentence and its length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            hashes, docs_of, texts_of, places = [], [], [], []
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                r = Runs(text, least_words)
                if len(r.hash):
                    hashes.append(r.hash.view(np.int64))
                    docs_of.append(np.full(len(r.hash), doc, np.int64))
                    texts_of.append(np.full(len(r.hash), key, np.int64))
                    places.append((r.first << 16) | np.minimum(r.end - r.first, 0xFFFF))
            if hashes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hashes, docs_of, texts_of, places)], names=["run", "doc", "hash", "place"])

    rows = docs.select(document_key(F.col("doc_id"), F.col("text")).alias("doc"), text_hash(F.col("text")).alias("hash"), F.col("text").cast("string").alias("text"))
    runs = rows.where(F.col("text").isNotNull()).mapInArrow(cut, "run long, doc long, hash long, place long")
    firsts = runs.groupBy("run").agg(F.count("*").alias("n"), F.min(F.struct("doc", "hash", "place")).alias("first")).where(F.col("n") > 1)
    again = runs.join(written(firsts.select("run", "first")), "run")
    return again.where(F.struct("doc", "hash", "place") != F.col("first")).select("doc", "hash", "place")


REMOVED = "array<struct<start:int,end:int>>"


def remove_repeats(docs: DataFrame, least_words: int = 30, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Whole texts without the sentences that repeat earlier ones in runs.

    A run is the shortest stretch of consecutive sentences with ``least_words``
    words or more (one long sentence may be a run). Words are compared without
    case. Returns the columns ``keep``, text (cleaned; null stays null),
    n_sentences, n_removed and removed (code-point ranges of the input text), one
    row per input row. The earliest place, by doc_id and then by position, keeps
    its text, also within one document. Repeated rows (same id and text) are one
    document and clean alike. Empty and short texts stay as they are."""
    ship(docs.sparkSession)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for batch, texts in text_slices(batches, "_text"):
            names = batch.schema.names
            raw = batch.column(names.index("_text")).to_pylist()
            out, n, gone, spans = [], [], [], []
            for was, text, places in zip(raw, texts, batch.column(names.index("_places")).to_pylist()):
                starts = sentences(text)
                drop = np.zeros(len(starts), bool)
                for p in places or ():
                    first, length = p >> 16, p & 0xFFFF
                    drop[first : first + length] = True
                n.append(len(starts) - 1)
                gone.append(int(drop.sum()))
                if not gone[-1]:
                    out.append(was)
                    spans.append([])
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[False], drop[:-1], [False]]).astype(np.int8)))
                cuts = [(starts[a], starts[b]) for a, b in zip(edges[::2], edges[1::2])]
                spans.append([{"start": a, "end": b} for a, b in cuts])
                bounds = [0, *(x for c in cuts for x in c), len(text)]
                out.append("".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            yield with_columns(batch, {"_text", "_places"}, _out=pa.array(out, pa.string()), n_sentences=pa.array(n, pa.int32()), n_removed=pa.array(gone, pa.int32()), removed=pa.array(spans, pa.list_(span)))

    again = repeated_runs(docs, least_words)
    places = written(again.groupBy(F.col("doc").alias("_of"), F.col("hash").alias("_of_text")).agg(F.collect_set("place").alias("_places")))
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"), text_hash(F.col("text")).alias("_hash"), document_key(F.col("doc_id"), F.col("text")).alias("_doc"))
    joined = rows.join(places, (F.col("_doc") == F.col("_of")) & (F.col("_hash") == F.col("_of_text")), "left").select(*keep, "_text", "_places")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return joined.mapInArrow(clean, f"{kept}, _out string, n_sentences int, n_removed int, removed {REMOVED}").withColumnRenamed("_out", "text")
