"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes cuts a text where it meets a value that depends
on the block size, so cuts move with the text around them. Each piece gives one
character of a signature. The block size is the smallest of 3 x 2^k for which 64
pieces are expected to do, halved while too few cuts are found. A fingerprint
has the signature at its block size and at twice that, so that fingerprints of
equal or neighbouring block sizes can be compared, by edit distance (insertions
and deletions).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_hash, text_of, text_slices

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WINDOW, LEAST_BLOCK, LONGEST, SCAN, COMMON = 7, 3, 64, 1 << 20, 4


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes that end at each byte (zeros before the text)."""
    wide = data.astype(np.uint32)
    h = np.zeros(len(data), np.uint32)
    times = 1
    for k in range(min(WINDOW, len(data))):
        h[k:] += wide[: len(wide) - k] * np.uint32(times)
        times = times * 0x01000193 & 0xFFFFFFFF
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return h


def _cuts(data: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(rolling hash, sum of all hashes so far) at each cut of ``block``, and the
    sum over the whole text. Long texts are gone through part by part."""
    hashes, sums, total = [], [], 0
    for a in range(0, len(data), SCAN):
        lead = min(a, WINDOW - 1)
        h = _rolling(data[a - lead : a + SCAN])[lead:]
        mixed = h * np.uint32(0xC2B2AE35)
        mixed ^= mixed >> np.uint32(16)
        running = np.cumsum(mixed, dtype=np.uint64)
        at = np.flatnonzero(h % np.uint32(block) == block - 1)
        hashes.append(h[at])
        sums.append(running[at] + np.uint64(total))
        total = (total + int(running[-1])) & 0xFFFFFFFFFFFFFFFF
    return (np.concatenate(hashes), np.concatenate(sums), total) if hashes else (np.empty(0, np.uint32), np.empty(0, np.uint64), 0)


def _signature(hashes: np.ndarray, sums: np.ndarray, total: int, block: int, longest: int) -> str:
    ends = sums[hashes % np.uint32(block) == block - 1][: longest - 1]
    ends = np.append(ends, np.uint64(total))
    pieces = np.diff(ends, prepend=np.uint64(0))
    if len(pieces) > 1 and pieces[-1] == 0:
        pieces = pieces[:-1]
    pieces = (pieces * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
    return "".join(map(LETTERS.__getitem__, pieces.tolist()))


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block``; equal texts agree."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{LEAST_BLOCK}::"
    block = LEAST_BLOCK
    while block * LONGEST < len(data):
        block *= 2
    # Cuts of a block size are cuts of its half too: one scan serves four sizes.
    low = max(LEAST_BLOCK, block // 8)
    hashes, sums, total = _cuts(data, low)
    while block > LEAST_BLOCK:
        if block < low:
            low = block
            hashes, sums, total = _cuts(data, low)
        if np.count_nonzero(hashes % np.uint32(block) == block - 1) >= LONGEST // 2:
            break
        block //= 2
    if block < low:
        hashes, sums, total = _cuts(data, block)
    return f"{block}:{_signature(hashes, sums, total, block, LONGEST)}:{_signature(hashes, sums, total, 2 * block, LONGEST // 2)}"


def _short_runs(s: str) -> str:
    """Runs of more than three equal characters say little: cut to three."""
    return "".join(c for i, c in enumerate(s) if i < 3 or not c == s[i - 1] == s[i - 2] == s[i - 3])


def edit_likeness(a: str, b: str) -> float:
    """1 - (insertions and deletions) / (both lengths); 0 unless the signatures
    share a stretch of COMMON characters (or of the shorter's length)."""
    a, b = _short_runs(a), _short_runs(b)
    if not a or not b:
        return 0.0
    n = min(COMMON, len(a), len(b))
    if not {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)}:
        return 0.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full  # zero bits: the longest common subsequence so far
    for c in b:
        u = row & places.get(c, 0)
        row = ((row + u) | (row - u)) & full
    common = len(a) - row.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(f: str, g: str) -> float:
    """Likeness of two fingerprints, 0 to 1; 0 if their block sizes are neither
    equal nor neighbours."""
    if f == g:
        return 1.0
    (p, a, a2), (q, b, b2) = f.split(":"), g.split(":")
    p, q = int(p), int(q)
    if p == q:
        return max(edit_likeness(a, b), edit_likeness(a2, b2))
    if p == 2 * q:
        return edit_likeness(a, b2)
    if q == 2 * p:
        return edit_likeness(a2, b)
    return 0.0


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, guest, doc_id, text), sorted so that in each part every document
    is followed by the next one of the whole table (order: doc_id, nulls last,
    then text hash). The first document of a part also stands, as a guest, at
    the end of the part before it; the table's first at the end of the last."""
    spark = docs.sparkSession
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    cuts = rows.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("double").alias("x")).approxQuantile("x", [i / parts for i in range(1, parts)], 0.2 / parts)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    place = rows.withColumn("_x", F.col("doc_id").cast("double"))
    if len(splits) > 2:
        place = Bucketizer(splits=splits, inputCol="_x", outputCol="_part", handleInvalid="keep").transform(place)
    else:
        place = place.withColumn("_part", F.lit(0.0))
    last = len(splits) - 1  # rows without an id come after all others
    placed = place.withColumn("part", F.when(F.col("doc_id").isNull(), last).otherwise(F.col("_part")).cast("int")).withColumn("text_hash", text_hash(F.col("text"))).drop("_x", "_part")
    firsts = placed.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("f")).orderBy("part").collect()
    guests = [(r["f"]["doc_id"], r["f"]["text_hash"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    # One row per part: at most ``parts`` + 1 rows, whatever the table's size.
    guests = F.broadcast(spark.createDataFrame(guests, "_id long, _hash long, to int"))
    sent = placed.join(guests, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    copies = F.array_compact(F.array(F.struct(F.col("part"), F.lit(False).alias("guest")), F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("part"), F.lit(True).alias("guest")))))
    dealt = sent.select(F.explode(copies).alias("c"), "doc_id", "text_hash", "text").select("c.part", "c.guest", "doc_id", "text_hash", "text")
    return dealt.repartitionById(last + 1, "part").sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_last(), "text_hash")


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint of every whole text and of its edited text (the last
    floor(n/4) code points replaced by as many first ones of the next document).

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next, one row per input row. Null texts count as empty.
    Rows follow each other by doc_id, nulls last, equal ids by the hash of their
    text; after the last comes the first (itself in a table of one row). Other
    columns are ignored. The texts are shuffled once, by ranges of the id."""
    ship(docs.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
        before = None  # the row that waits for the next one: part, doc_id, text, fingerprint
        for batch, texts in text_slices(batches):
            out = []
            for part, guest, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), texts):
                if guest and (before is None or before[0] != part):
                    continue  # further copies of the guest
                own = fingerprint(text)
                if before is not None and before[0] == part:
                    _, doc_id, old, f = before
                    n = len(old)
                    edited = old[: n - n // 4] + text[: n // 4]
                    e = fingerprint(edited)
                    out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), f, e, likeness(f, e), likeness(f, own)))
                before = None if guest else (part, doc, text, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return with_next(docs, parts).select("part", "guest", "doc_id", "text").mapInArrow(walk, FIELDS)
