"""Token counts of a BPE vocabulary by a deterministic finite-state transducer.

The vocabulary is compiled into a transducer over characters whose transitions
carry the change of the token count. It rests on two facts about BPE: the tokens
of a text's prefix end in exactly one token, and a token may follow another
exactly if their joined text encodes to just these two. A state therefore holds,
for each place where a longer token may still begin, the node reached in the
vocabulary's trie, the longer tokens that the token before that place admits, and
the count there relative to the count now. Only states and transitions that texts reach are built, and the
set of built states is emptied when it passes a fixed number.

A blank after another character begins a new token in every state, so it
synchronises the transducer. The state map of a chunk of text is then small: the
text before the first such place (its effect depends on the state the chunk is
entered in), the count between the first and the last, and the text after the
last. Maps compose associatively, so the chunks of a long text are counted apart,
in different tasks, and composed in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_hash, text_of, text_slices, with_columns

BLANK = " "
SYNC = re.compile("(?<=[^ ]) ")
NEVER = float("inf")


class State(dict):
    """Transitions built so far: character -> (change of the count, next state)."""

    __slots__ = ("key", "machine")

    def __missing__(self, char: str):
        made = self[char] = self.machine.transition(self.key, char)
        return made


class Words(dict):
    """Counts of whole paths from the start state back to it, by their text."""

    __slots__ = ("machine",)

    def __missing__(self, word: str) -> int:
        n = self.machine.walk(word)
        if len(word) <= 40:
            if len(self) >= self.machine.max_words:
                self.clear()
            self[word] = n
        return n


class TokenCounter:
    """Transducer of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str, max_states: int = 60_000, max_words: int = 300_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.max_states, self.states = max_states, {}
        self.max_words, self.words = max_words, Words()
        self.words.machine = self
        pieces = [(sp.id_to_piece(i).replace("▁", BLANK), sp.get_score(i)) for i in range(len(sp))
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(BLANK in p.lstrip(BLANK) for p, _ in pieces):
            raise ValueError("a piece holds a blank after another character: blanks don't synchronise this vocabulary")
        self.rank = {p: -score for p, score in pieces}
        self.edge: dict = {}
        self.joins = {c for p, _ in pieces if len(p) > 1 for c in p} | {BLANK}
        self.children: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        for p, _ in pieces:
            node = 0
            for c in p:
                if c not in self.children[node]:
                    self.children.append({})
                    self.token.append(None)
                    self.children[node][c] = len(self.token) - 1
                node = self.children[node][c]
            self.token[node] = p
        below: list[set[str]] = [set() for _ in self.token]
        for p, _ in pieces:
            node = 0
            for i, c in enumerate(p[:-1]):
                node = self.children[node][c]
                if i:
                    below[node].add(p)
        self.below = [frozenset(x) for x in below]
        self.sets: dict = {}
        self.same: dict = {}
        self.start_key = ((0, None, 0),)
        # Paths that begin in the start state and end where any next one does.
        self.paths = re.compile(" *[^ \n]+| +|\n" if "\n" not in self.joins else " *[^ ]+| +")

    def edges(self, token: str) -> tuple | None:
        """How BPE builds ``token`` at its two ends: from the first and from the
        last character up to the token, each part with the rank of the merge that
        takes it in. None if BPE doesn't build the token from its own text."""
        if token in self.edge:
            return self.edge[token]
        parts = [(c, (), ()) for c in token]  # text, left half, right half
        while len(parts) > 1:
            ranks = [self.rank.get(a[0] + b[0], NEVER) for a, b in zip(parts, parts[1:])]
            i = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[i] == NEVER:
                break
            a, b = parts[i : i + 2]
            parts[i : i + 2] = [(a[0] + b[0], a, b)]
        found = None
        if len(parts) == 1:
            found = ([], [])
            for side, out in zip((1, 2), found):
                part, taken = parts[0], NEVER
                while part:
                    out.append((part[0], taken))
                    part, taken = part[side], self.rank.get(part[0], NEVER)
                out.reverse()
        self.edge[token] = found
        return found

    def follows(self, left: str | None, token: str) -> bool:
        """Whether BPE of the joined text gives just these two tokens: no merge
        across their border comes before the merges that build them. Walks up
        both sides of the border in the order of their merges."""
        right = self.edges(token)
        if right is None or left is None:
            return right is not None
        left_edge = self.edges(left)
        if left_edge is None:
            return len(left) == 1 and left not in self.rank
        ups, downs, i, j = left_edge[1], right[0], 0, 0
        while True:
            (a, a_taken), (b, b_taken) = ups[i], downs[j]
            across = self.rank.get(a + b, NEVER)
            if across < a_taken and across <= b_taken and across != NEVER:
                return False
            if a_taken == b_taken == NEVER:
                return True
            if a_taken <= b_taken:
                i += 1
            else:
                j += 1

    def start(self) -> State:
        return self.state(self.start_key)

    def state(self, key: tuple) -> State:
        found = self.states.get(key)
        if found is None:
            if len(self.states) >= self.max_states:
                for s in self.states.values():
                    s.clear()
                self.states.clear()
            found = self.states[key] = State()
            found.key, found.machine = key, self
        return found

    def transition(self, key: tuple, char: str) -> tuple[int, State]:
        if char not in self.joins:  # joins with nothing: one token, or its bytes
            return (1 if char in self.rank else len(char.encode())), self.start()
        ended, change, grown = None, 0, []
        for node, left, count in key:
            child = self.children[node].get(char)
            if child is None:
                continue
            if node == 0 and char == BLANK and left is not None and left[-1] != BLANK:
                left = None  # every token may stand before this blank
            token = self.token[child]
            if token is not None and ended is None and (token in left if type(left) is frozenset else self.follows(left, token)):
                ended, change = token, count + 1
            if node:
                left = self.longer(child, left)
                if not left:
                    continue
            if self.children[child]:
                grown.append((child, left, count))
        if ended is None:  # a character that occurs only inside longer pieces
            ended, change = char, len(char.encode())
        return change, self.state((*((n, left, c - change) for n, left, c in grown), (0, ended, 0)))

    def longer(self, node: int, left) -> frozenset:
        """The tokens beyond ``node`` that may follow ``left`` (a token, or such
        a set from a node before). All that the state has to know about the past
        here, so that most texts share their states."""
        known = self.sets.get((node, left))
        if known is None:
            if len(self.sets) > 5 * self.max_states:
                self.sets.clear()
            if type(left) is frozenset:
                known = left & self.below[node]
            else:
                known = frozenset(t for t in self.below[node] if self.follows(left, t))
            known = self.sets[node, left] = self.same.setdefault(known, known)
        return known

    def walk(self, text: str) -> int:
        """Count of a text from the start state, one transition a character."""
        state, total = self.start(), 0
        for char in text:
            change, state = state[char]
            total += change
        return total

    def run(self, text: str) -> int:
        """Count of a text from the start state, path by path."""
        return sum(map(self.words.__getitem__, self.paths.findall(text)))

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(text before the first synchronising place, count between the first
        and the last, text after the last or None if there is no such place)."""
        first = SYNC.search(chunk)
        if first is None:
            return chunk, 0, None
        last = chunk.rfind(BLANK)
        while chunk[last - 1] == BLANK:
            last -= 1
        return chunk[: first.start()], self.run(chunk[first.start() : last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks (associative)."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        if b[2] is None:
            return self.joined(a[0], a[1], a[2] + b[0])
        between = a[2] + b[0]
        inner = self.joined("", 0, between)
        # a blank may begin b: then the text between the chunks holds a new place
        return a[0], a[1] + inner[1] + self.run(inner[2]) + b[1], b[2]

    def joined(self, head: str, body: int, rest: str) -> tuple:
        """A map whose text after the last place is ``rest``, brought up to date
        if ``rest`` itself holds a synchronising place."""
        last = None
        for last in SYNC.finditer(rest):
            pass
        return (head, body, rest) if last is None else (head, body + self.run(rest[: last.start()]), rest[last.start() :])

    def finish(self, m: tuple) -> int:
        return self.run(m[0]) + m[1] + self.run(m[2] or "")


def normal(text: str) -> str:
    """The vocabulary's own preparation: a blank goes before a non-empty text."""
    return BLANK + text.replace("▁", BLANK) if text else ""


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str | None) -> TokenCounter:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = 4096, chunk_chars: int = 1 << 15) -> DataFrame:
    """Tokens of every whole text of (doc_id, text).

    Returns doc_id, n_bytes (UTF-8), n_tokens and over_limit, one row per input
    row. Null and empty texts have no tokens; a null doc_id stays null; repeated
    rows give repeated results; other columns are ignored. Texts of more than
    ``chunk_chars`` characters are cut into chunks that are dealt over the
    cluster; only their maps, which are short, are gathered by document."""
    ship(docs.sparkSession)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(model_path)
        for batch, texts in text_slices(batches):
            yield with_columns(batch, {"text"}, n_tokens=pa.array([machine.run(normal(t)) for t in texts], pa.int64()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, limit=1):
            text = normal(texts[0])
            for k in range(0, len(text), 32 * chunk_chars):
                chunks = [text[i : i + chunk_chars] for i in range(k, min(len(text), k + 32 * chunk_chars), chunk_chars)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(batch.column(0).to_pylist() * len(chunks), pa.int64()), "text_hash": pa.array(batch.column(1).to_pylist() * len(chunks), pa.int64()),
                                                  "place": pa.array(range(k // chunk_chars, k // chunk_chars + len(chunks)), pa.int64()), "text": chunks})

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(model_path)
        for batch, texts in text_slices(batches):
            head, body, tail = zip(*map(machine.chunk_map, texts))
            yield with_columns(batch, {"text"}, head=pa.array(head, pa.string()), body=pa.array(body, pa.int64()), tail=pa.array(tail, pa.string()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(model_path)
        for batch in batches:
            rows = [[(m["head"], m["body"], m["tail"]) for m in ms] for ms in batch.column(2).to_pylist()]
            counts = [machine.finish(reduce(machine.compose, r)) for r in rows]
            yield with_columns(batch, {"maps"}, n_tokens=pa.array(counts, pa.int64()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = rows.where(F.length("text") <= chunk_chars).mapInArrow(whole, "doc_id long, n_bytes long, n_tokens long")
    long = rows.where(F.length("text") > chunk_chars).select("doc_id", text_hash(F.col("text")).alias("text_hash"), "n_bytes", "text")
    chunks = long.select("doc_id", "text_hash", "text").mapInArrow(cut, "doc_id long, text_hash long, place long, text string")
    mapped = chunks.repartition("doc_id", "text_hash", "place").mapInArrow(maps, "doc_id long, text_hash long, place long, head string, body long, tail string")
    once = mapped.groupBy("doc_id", "text_hash", "place").agg(F.max(F.struct("place", "head", "body", "tail")).alias("m"))
    gathered = once.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("m")).alias("maps"))
    counted = gathered.mapInArrow(scan, "key_id long, key_hash long, n_tokens long")
    joined = long.drop("text").join(counted, F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("text_hash") == F.col("key_hash")))
    both = short.unionByName(joined.select("doc_id", "n_bytes", "n_tokens"))
    return both.withColumn("over_limit", F.col("n_tokens") > limit)
