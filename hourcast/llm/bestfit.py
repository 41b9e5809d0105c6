"""Best-fit decreasing packing of all documents at once.

Sizes are whole numbers up to the limit, so documents of equal size can change
places and the corpus matters only through the count of pieces of each size: at
most ``limit`` numbers. Best-fit decreasing runs over those counts. A segment
tree over remaining capacities gives the tightest open sequence in logarithmic
time; since a sequence that has just taken a piece is the tightest one for the
next piece of that size, all sequences of one capacity are filled in one step.
The result is the placing that one document at a time would give, as *runs*:
consecutive ranks of one size go to consecutive sequences.

Spark does the rest. Tasks cut and number their pieces of each size and write
them; a piece's rank is its number plus the count of that size in earlier tasks;
its run then gives sequence and offset.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.common import runs, ship, text_of, text_slices, written

LIMIT = 2048
END_ID = 0


class CapacityTree:
    """Open sequences counted by remaining capacity."""

    def __init__(self, limit: int):
        self.leaves = 1 << limit.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        k = capacity + self.leaves
        while k:
            self.open[k] += n
            k >>= 1

    def tightest(self, size: int) -> int | None:
        """The least capacity of ``size`` or more that an open sequence has."""
        k = size + self.leaves
        if not self.open[k]:
            while k and (k & 1 or not self.open[k + 1]):  # up, until something lies to the right
                k >>= 1
            if not k:
                return None
            k += 1
            while k < self.leaves:  # down, to the leftmost
                k = 2 * k if self.open[2 * k] else 2 * k + 1
        return k - self.leaves


def best_fit_decreasing(counts: Mapping[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Runs (size, first rank, first sequence, pieces a sequence, offset) that
    place ``counts[size]`` pieces of each size (1 to ``limit``): the piece of
    rank r goes to sequence first + (r - first rank) // pieces, behind the
    offset and the run's earlier pieces there."""
    tree, free, used, out = CapacityTree(limit), {}, 0, []

    def leave(first: int, n: int, capacity: int) -> None:
        if n and capacity:
            free.setdefault(capacity, []).append((first, n))
            tree.add(capacity, n)

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            capacity = tree.tightest(size)
            if capacity is None:
                n = -(-left // (limit // size))
                leave(used, n, limit)
                used += n
                capacity = limit
            first, n = free[capacity].pop()
            tree.add(capacity, -n)
            each = capacity // size
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            out.append((size, rank, first, each, limit - capacity))
            leave(first, full, capacity - each * size)
            if 0 < rest < each:  # the last sequence takes what is left
                leave(first + full, 1, capacity - rest * size)
                leave(first + full + 1, n - full - 1, capacity)
            else:
                rest = 0
                leave(first + full, n - full, capacity)
            rank, left = rank + full * each + rest, left - full * each - rest
    return out


class WordPieces:
    """Ids of texts by the ``tokenizers`` file of the word vocabulary, as
    little-endian 32-bit bytes.

    Its normalizer and splitter never look across white space, and every word's
    last id is one that ends a word. So a text of plain characters (ASCII and
    Latin-1 letters) is cut into words here, by the file's own pattern; words
    that aren't known yet go through the library as one text, cut again at the
    ids that end words. Of other texts, the parts between ASCII white space that
    aren't plain go through the library whole. The last ``most`` words are
    remembered, and at most as many before them."""

    PLAIN = re.compile(r"[\t-\r -~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*")
    LETTERS, DIGITS = "a-z\u00DF-\u00F6\u00F8-\u00FF", "0-9"  # of plain lower-case text
    ODD = "\0"  # marks a part that isn't plain; no plain text holds it

    def __init__(self, path: str | None = None, most: int = 1 << 19):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = path or public_tokenizers.path("word_bpe_49k.json")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        pattern = rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_of = re.compile(pattern.replace(r"\p{L}", self.LETTERS).replace(r"\p{N}", self.DIGITS)).findall
        self.ends = np.zeros(self.library.get_vocab_size(), dtype=bool)
        self.ends[[i for t, i in rules["model"]["vocab"].items() if t.endswith(rules["model"]["end_of_word_suffix"])]] = True
        self.most, self.known, self.older = most, {}, {}

    def _library_ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _plain(self, text: str) -> bool:
        return "<|" not in text and self.PLAIN.fullmatch(text) is not None

    def _words(self, text: str) -> list[str]:
        if self._plain(text):
            return self.words_of(text.lower())
        parts = [p.decode() for p in text.encode().split()]
        return [w for p in parts for w in (self.words_of(p.lower()) if self._plain(p) else (self.ODD + p,))]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that the memory doesn't hold."""
        found = {w: ids for w in words if (ids := self.older.get(w)) is not None}
        new = [w for w in words if w not in found]
        for w in new:
            if w.startswith(self.ODD):
                found[w] = self._library_ids(w[1:]).tobytes()
        new = [w for w in new if w not in found]
        for a, b in runs([len(w) for w in new], 1 << 16):
            ids = self._library_ids(" ".join(new[a:b]))
            at = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            found.update((w, ids[i:j].tobytes()) for w, i, j in zip(new[a:b], [0, *at[:-1]], at, strict=True))
        return found

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        words = [self._words(t) for t in texts]
        if len(self.known) >= self.most:
            self.known, self.older = {}, self.known
        found = self._learn(set().union(*words).difference(self.known))
        self.known.update(found)
        for ws in words:
            yield b"".join(map(self.known.__getitem__, ws))
        for w in found:
            if len(w) > 64:  # not worth its memory
                del self.known[w]


@lru_cache(maxsize=1)
def word_pieces(path: str | None = None) -> WordPieces:
    return WordPieces(path)


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, number long"


def cut_documents(docs: DataFrame, limit: int, encode: Callable[[], WordPieces]) -> DataFrame:
    """All pieces of ``docs``, each with the task that cut it and its number
    among that task's pieces of its length; written as a table."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = encode(), np.array([END_ID], "<u4").tobytes()
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        numbers = [0] * (limit + 1)
        for batch, texts in text_slices(batches):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), tokenizer.ids(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    piece = ids[at : at + 4 * limit]
                    length = len(piece) // 4
                    rows.append((doc, k, at // 4, length, zlib.crc32(piece), part, numbers[length]))
                    numbers[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"])

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(cut, PIECES))


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack_best_fit(docs: DataFrame, limit: int = LIMIT, tokenizer_path: str | None = None) -> DataFrame:
    """Pack whole documents (doc_id, text) into as few sequences of at most
    ``limit`` ids as best-fit decreasing finds for the whole corpus.

    A document's ids are those of its text, then ``END_ID``. Only longer
    documents are cut, into pieces of ``limit`` ids and a rest. Returns one row
    per piece: doc_id, piece (from 0), start (ids of its document before it),
    length, ids_crc32, sequence_id, offset. Null and empty texts have the end id
    only; a null doc_id stays null; repeated rows are packed as often as they
    occur; an empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    ship(spark)
    pieces = cut_documents(docs, limit, lambda: word_pieces(tokenizer_path))
    # One row for each task and length: the pieces of that length in earlier tasks.
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = written(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    # At most ``limit`` counts reach the driver, whatever the corpus.
    total = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = np.array(best_fit_decreasing(total, limit), dtype=np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast(rows[np.lexsort((rows[:, 1], rows[:, 0]))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rank, first, each, offset = plan.value.T
        # One rising key for (size, rank): sizes apart by more than any rank.
        apart = int(max(rank.max(initial=0), max(total.values(), default=0))) + 1
        keys = size * apart + rank
        for batch in batches:
            length, number = batch.column(3).to_numpy().astype(np.int64), batch.column(5).to_numpy()
            k = np.searchsorted(keys, length * apart + number, side="right") - 1
            nth = number - rank[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(length), batch.column(4), pa.array(first[k] + nth // each[k]), pa.array(offset[k] + nth % each[k] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(before.select("length", "part", "before"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("number"))
    return ranked.mapInArrow(place, PLACED)
