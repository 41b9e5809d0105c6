"""Packing of examples into sequences by vector bin packing.

Each example has three sizes: tokens, segments (one per piece) and loss-bearing
tokens. A sequence has a limit on each. Pieces are placed one after another,
largest first, into the open sequence whose *remaining* room points most in the
direction of the piece: the largest dot product of the piece's sizes and the
room left, both in shares of the limits. Examples longer than a sequence are cut
into whole sequences and a rest. When no open sequence has room for a piece, a
new one opens; when too many are open, the fullest one is closed by cutting a
waiting piece to its exact room.

A task packs the rows it has read, in blocks, and carries open sequences from
block to block; nothing is shuffled, and a lost task is packed again from the
same input split. At the end of a task's rows the open sequences are merged and
the last ones are closed at power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_of, text_slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segments int, loss_tokens long"
END_ID = 1


@dataclass(frozen=True)
class Limits:
    """Limits of one sequence. ``segments`` counts pieces, ``loss`` the tokens
    that bear loss (for plain documents all of them)."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class Piece:
    doc: object
    start: int
    ids: np.ndarray
    loss: np.ndarray  # running count of loss-bearing tokens, one longer than ids
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:n], self.loss[: n + 1], self.doc_tokens),
                Piece(self.doc, self.start + n, self.ids[n:], self.loss[n:], self.doc_tokens))

    @property
    def loss_tokens(self) -> int:
        return int(self.loss[-1] - self.loss[0])


class Packer:
    """Vector bin packing of pieces that arrive in blocks."""

    def __init__(self, limits: Limits, first_id: int, open_limit: int = 64):
        self.limits, self.next_id, self.open_limit = limits, first_id, open_limit
        self.size = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
        self.room = np.empty((0, 3))
        self.bins: list[list[Piece]] = []
        self.done: list[tuple[int, list[Piece]]] = []

    def _close(self, k: int) -> None:
        self.done.append((self.next_id, self.bins.pop(k)))
        self.room = np.delete(self.room, k, axis=0)
        self.next_id += 1

    def _put(self, k: int, piece: Piece) -> None:
        self.bins[k].append(piece)
        self.room[k] -= (len(piece.ids), 1, piece.loss_tokens)
        if self.room[k, 0] < 1 or self.room[k, 1] < 1:
            self._close(k)

    def _fit(self, piece: Piece, k: int) -> int:
        """The most leading tokens of ``piece`` that sequence ``k`` can take."""
        n = int(min(len(piece.ids), self.room[k, 0]))
        return min(n, int(np.searchsorted(piece.loss, piece.loss[0] + self.room[k, 2], side="right")) - 1)

    def _place(self, piece: Piece) -> None:
        """Put the whole piece where the dot product is largest; cut it into the
        fullest sequence first if none has room and no more may open."""
        while True:
            need = np.array([len(piece.ids), 1, piece.loss_tokens], dtype=np.float64)
            fits = (self.room >= need).all(axis=1)
            if fits.any():
                score = np.where(fits, (self.room / self.size) @ (need / self.size), -1.0)
                self._put(int(score.argmax()), piece)
                return
            if len(self.bins) < self.open_limit and (need <= self.size).all():
                self.bins.append([])
                self.room = np.vstack([self.room, self.size])
                self._put(len(self.bins) - 1, piece)
                return
            if not self.bins:
                self.bins.append([])
                self.room = np.vstack([self.room, self.size])
            k = int(self.room[:, 0].argmin())
            n = self._fit(piece, k)
            if n <= 0:  # its loss-bearing limit is used up
                self._close(k)
                continue
            if n >= len(piece.ids):
                self._put(k, piece)
                return
            head, piece = piece.cut(n)
            self._put(k, head)
            if k < len(self.bins) and self.bins[k] and self.bins[k][-1] is head:
                self._close(k)

    def add(self, pieces: list[Piece]) -> None:
        rest = []
        for p in pieces:
            while len(p.ids) >= self.limits.tokens:
                n = min(self.limits.tokens, int(np.searchsorted(p.loss, p.loss[0] + self.limits.loss, side="right")) - 1)
                head, p = p.cut(n)
                self.done.append((self.next_id, [head]))
                self.next_id += 1
            if len(p.ids):
                rest.append(p)
        for p in sorted(rest, key=lambda p: -len(p.ids)):
            self._place(p)

    def finish(self) -> None:
        """Merge what is open into full sequences and cut the last ones at
        powers of two, so that they need no padding."""
        left = sorted((p for b in self.bins for p in b), key=lambda p: -len(p.ids))
        self.bins, self.room = [], np.empty((0, 3))
        current: list[Piece] = []
        room = [self.limits.tokens, self.limits.segments, self.limits.loss]
        total = sum(len(p.ids) for p in left)
        while left:
            if not current:
                cap = min(self.limits.tokens, total)
                if cap < self.limits.tokens:
                    cap = 1 << (cap.bit_length() - 1)
                room = [cap, self.limits.segments, self.limits.loss]
            p = left.pop()
            n = min(len(p.ids), room[0], int(np.searchsorted(p.loss, p.loss[0] + room[2], side="right")) - 1)
            if n < len(p.ids):
                head, tail = p.cut(n)
                left.append(tail)
                p = head
            if n:
                current.append(p)
                room = [room[0] - n, room[1] - 1, room[2] - p.loss_tokens]
                total -= n
            if not left or room[0] <= 0 or room[1] <= 0 or room[2] <= 0:
                self.done.append((self.next_id, current))
                self.next_id += 1
                current = []

    def take(self) -> Iterator[tuple]:
        for seq, pieces in self.done:
            offset = 0
            for p in pieces:
                yield (p.doc, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.doc_tokens, seq, offset, len(pieces), p.loss_tokens)
                offset += len(p.ids)
        self.done = []


@lru_cache(maxsize=1)
def byte_bpe(path: str | None = None) -> Callable[[str], np.ndarray]:
    """Encoder of the byte-level BPE vocabulary: the same ids as
    ``tokenizers`` gives for byte_bpe_50k.json, by the same vocabulary as ranks
    (about four times as fast). Its special string inside a text is one id, as
    that library's default has it."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {"<|endoftext|>": len(ranks)}
    enc = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: enc.encode_to_numpy(text, allowed_special="all")


def pack_documents(docs: DataFrame, limits: Limits = Limits(), block_tokens: int = 1 << 19, tokenizer_path: str | None = None) -> DataFrame:
    """Pack whole documents (doc_id, text) into sequences.

    A document's ids are those of its text, then ``END_ID``. Returns one row per
    piece: doc_id, start (ids of its document before it), length, ids_crc32,
    doc_tokens, sequence_id, offset, and the segments of its sequence and the
    piece's loss-bearing tokens. Null and empty texts have the end id only; a
    null doc_id stays null; repeated rows are packed as often as they occur; an
    empty table gives no rows; other columns are ignored."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer_path)
        context = TaskContext.get()
        packer = Packer(limits, (context.partitionId() if context else 0) << 40)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                            ("sequence_id", pa.int64()), ("offset", pa.int64()), ("segments", pa.int32()), ("loss_tokens", pa.int64())])

        def out():
            rows = list(packer.take())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        waiting, n = [], 0
        for batch, texts in text_slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), texts):
                ids = np.append(encode(text), np.uint32(END_ID))
                waiting.append(Piece(doc, 0, ids, np.arange(len(ids) + 1), len(ids)))
                n += len(ids)
                if n >= block_tokens:
                    packer.add(waiting)
                    waiting, n = [], 0
                    yield from out()
        packer.add(waiting)
        packer.finish()
        yield from out()

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(pack, PIECES)
