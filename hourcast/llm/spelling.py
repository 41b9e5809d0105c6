"""Grouping of spelling variants by permuterm rotations.

Words are marked with a terminator and turned at every place. A word ``acb``
(parts a and b around a letter c) has the rotation ``b$ac``; all words that
differ from it by that letter alone share the rotation's first characters
``b$a``, whatever the letter, and the word ``ab`` without the letter has ``b$a``
as a whole rotation. So a group of equal ``b$a`` holds, as members that skipped a
letter, words that are one replacement apart, and as a whole member the word that
is one deletion away from them. Of a run of equal letters, all deletions give
the same word: only the first counts for it, so no pair is met twice.

Rotations are sorted by these characters and a scan over the sorted rows takes
the groups. A group holds one member for each letter at most (the alphabet is
fixed), and the scan emits, for each member, the number of its neighbours there
and the best of them, not the pairs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_of, text_slices, written

RUN = "A-Za-zÀ-ÿ"
END = "$"  # not a letter
LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10  # how much more frequent a form is
EDITED = 31
PLAIN_KEY = 65  # longer keys travel as two hashes of their characters
PRIMES = ((1 << 61) - 1, (1 << 89) - 1)
BASES = (1_000_003, 998_244_353)


# ---------------------------------------------------------------- words


def doc_words(doc_id: int | None, text: str, pattern: re.Pattern, least: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text: runs of letters with A-Z lower-cased; one
    letter of a run goes if the crc32 of id and run says so."""
    runs = Counter(pattern.findall(text.encode().lower().decode()))
    mark = f"{'' if doc_id is None else doc_id}:"
    for run, n in runs.items():
        h = zlib.crc32(f"{mark}{run}".encode())
        if h % EDITED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least:
            yield run, n


def words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, most: int = 1 << 17) -> DataFrame:
    """(no, word, n): the distinct words of the whole corpus and their counts,
    numbered in code-point order; written as a table. Tasks count what they read
    in tables of at most ``most`` words before Spark adds the counts up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, seen = re.compile(f"[{RUN}]{{{least_letters},}}"), {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

        for batch, texts in text_slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), texts):
                for word, n in doc_words(doc, text, pattern, least_letters):
                    seen[word] = seen.get(word, 0) + n
                    if len(seen) >= most:
                        yield out()
                        seen = {}
        yield out()

    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(count, "word string, n long")
    counted = written(pairs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counted.repartitionByRange(n, "word").sortWithinPartitions("word")
    return written(ranged.select(F.monotonically_increasing_id().alias("no"), "word", "n"))


# ---------------------------------------------------------------- rotations


class Hashes:
    """Hashes of any rotation of a marked word, each in constant time, so that a
    word of a million letters costs a million steps and not their square."""

    def __init__(self, marked: str):
        self.sums, self.powers = [], []
        for prime, base in zip(PRIMES, BASES):
            total, power, sums, powers = 0, 1, [0], [1]
            for c in marked * 2:
                total = (total * base + ord(c)) % prime
                power = power * base % prime
                sums.append(total)
                powers.append(power)
            self.sums.append(sums)
            self.powers.append(powers)

    def key(self, start: int, length: int) -> str:
        parts = [(s[start + length] - s[start] * p[length]) % prime for s, p, prime in zip(self.sums, self.powers, PRIMES)]
        return f"{END}{length}:{parts[0]:x}:{parts[1]:x}"


def rotations(word: str) -> Iterator[tuple[str, int]]:
    """(key, kind) of a word: kind 0 for a whole rotation, 1 for a rotation whose
    last letter is skipped, 2 if that letter also starts a run of equal ones."""
    size = len(word)
    marked = word + END
    twice = marked * 2
    hashes = Hashes(marked) if size + 1 > PLAIN_KEY else None

    def key(start: int, length: int) -> str:
        return twice[start : start + length] if length <= PLAIN_KEY else hashes.key(start, length)

    for i in range(size):
        yield key(i + 1, size), 2 if i == 0 or word[i - 1] != word[i] else 1
    for i in range(size + 1):
        yield key(i, size + 1), 0


NEAR = "no long, n_near long, best_n long, best_no long"


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours from rows (key, kind, no, n) sorted by key."""

    def take(group: list[tuple], out: list[tuple]) -> None:
        # Greatest n first, then smallest word; the best other one is among two.
        group.sort(key=lambda m: (-m[2], m[1]))
        whole = [m for m in group if m[0] == 0]
        skipped, first = [m for m in group if m[0]], [m for m in group if m[0] == 2]
        for m in skipped:
            near = [x for x in skipped[:2] if x is not m][:1] + (whole if m[0] == 2 else [])
            if near:
                best = min(near, key=lambda x: (-x[2], x[1]))
                out.append((m[1], len(skipped) - 1 + len(whole) * (m[0] == 2), best[2], best[1]))
        for m in whole:
            if first:
                out.append((m[1], len(first), first[0][2], first[0][1]))

    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0)
        change = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False).nonzero()[0] + 1
        starts, ends = [0, *change.tolist()], [*change.tolist(), len(keys)]
        kinds, nos, ns = (batch.column(k).to_pylist() for k in (1, 2, 3))
        out: list[tuple] = []
        for k, (a, b) in enumerate(zip(starts, ends)):
            edge = k == 0 or k == len(starts) - 1
            if b - a < 2 and not edge:
                continue
            members = [(kinds[i], nos[i], ns[i]) for i in range(a, b)]
            if edge:  # a group may go on over batches
                key = keys[a].as_py()
                if key != held_key:
                    take(held, out)
                    held, held_key = [], key
                held += members
            else:
                take(members, out)
        yield from _near(out)
    out = []
    take(held, out)
    yield from _near(out)


def _near(out: list[tuple]) -> Iterator[pa.RecordBatch]:
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["no", "n_near", "best_n", "best_no"])


def near_words(numbered: DataFrame) -> DataFrame:
    """(no, n_near, best_n, best_no) of every word that has a near word: one
    inserted, deleted or replaced letter away."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for no, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for key, kind in rotations(word):
                    rows.append((key, kind, no, n))
                    if len(rows) >= 1 << 16:
                        yield _rotated(rows)
                        rows = []
            if rows:
                yield _rotated(rows)

    turned = numbered.select("no", "word", "n").mapInArrow(turn, "key string, kind int, no long, n long")
    n = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = turned.repartition(n, "key").sortWithinPartitions("key").mapInArrow(scan, NEAR)
    best = F.max(F.struct("best_n", (-F.col("best_no")).alias("back")))
    return found.groupBy("no").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "no", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.back")).alias("best_no"))


def _rotated(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["key", "kind", "no", "n"])


def spelling_variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """The words of ``docs`` (doc_id, text) with the form each one is a variant of.

    Words are maximal runs of letters (A-Z lower-cased, then one letter deleted
    where the crc32 of document and run is a multiple of 31) of at least
    ``least_letters`` letters that occur ``least_count`` times or more in all.
    Returns one row per word: word, form (its most frequent near word, ties to
    the smallest, if ``times`` as frequent), root (the last of the chain of
    forms, the word itself without one), n, n_near, form_n.

    Null and empty texts have no words; a null doc_id counts as empty text in
    the crc32; repeated rows count as often as they occur; an empty table gives
    no rows; other columns are ignored. Words of any length take part: rotations
    of over 65 characters are compared by two hashes (150 bits)."""
    ship(docs.sparkSession)
    numbered = words(docs, least_letters, least_count)
    near = numbered.join(near_words(numbered), "no", "left")
    is_form = F.col("best_n") >= F.lit(times) * F.col("n")
    chosen = written(near.select("no", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                 F.when(is_form, F.col("best_no")).alias("form_no"), F.when(is_form, F.col("best_n")).alias("form_n")))
    most = chosen.agg(F.max("n")).first()[0] or 1
    # A form is ``times`` as frequent, which bounds the chain; each join doubles its reach.
    links = chosen.where("form_no is not null").select("no", F.col("form_no").alias("root_no"))
    hops = 1 + int(math.log(max(most, 2)) / math.log(times)) if times > 1 else 64
    for _ in range(max(1, math.ceil(math.log2(hops)))):
        further = links.select(F.col("no").alias("root_no"), F.col("root_no").alias("next_no"))
        links = written(links.join(further, "root_no", "left").select("no", F.coalesce("next_no", "root_no").alias("root_no")))
    name = lambda k: numbered.select(F.col("no").alias(f"{k}_no"), F.col("word").alias(k))
    out = chosen.join(links, "no", "left").join(name("form"), "form_no", "left").join(name("root"), "root_no", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
