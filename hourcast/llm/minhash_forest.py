"""Near-duplicate documents by a MinHash LSH forest.

A document is the set of its distinct word shingles. Documents of equal sets are
one class, found by grouping on a 128-bit hash of the set; from there on only
class representatives are compared, each a node with a number of its own (texts
under one doc_id are nodes of their own, linked at once). A representative has
one MinHash signature;
each tree of the forest is an order of the signature's values, in which
representatives are sorted. A region of a tree is a common prefix of
LEAST_DEPTH values; its order goes on by the values after them.

Candidates are the longest-common-prefix neighbours in the sorted order of every
tree, and each member with its region's hub (the representative of most copies).
Each representative first confirms its likeliest candidates on full sets, then
those that would join two components. Regions that still hold several components
are gone through completely, block against block: every pair of two components
whose signatures agree enough is checked on full sets. Components come from
confirmed links alone. No group is gathered in one task; the block pass takes
members outside a region's largest component times all its members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import ship, text_hash, text_of, text_slices, with_columns, written
from hourcast.llm.components import connected_components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
VALUES, TREES, LEAST_DEPTH = 64, 16, 4
NEIGHBOURS = 2
_rng = np.random.default_rng(20240501)
TIMES = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)
PLACES = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hashes of words, kept up to a fixed number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


WORDS = WordHash()


def shingles(text: str, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles; of the
    whole sequence if it has fewer words; empty without words."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    if len(w) < k:
        return mixed(np.array([(w * PLACES[: len(w)]).sum() + np.uint64(len(w))], np.uint64))
    h = w[: len(w) - k + 1] * PLACES[0]
    for i in range(1, k):
        h += w[i : len(w) - k + 1 + i] * PLACES[i]
    return np.unique(mixed(h))


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty shingle set, 16 bits of each."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 2048):
        least = np.minimum(least, (s[i : i + 2048, None] * TIMES + PLUS).min(axis=0))
    return (mixed(least) & np.uint64(0xFFFF)).astype("<u2")


def set_hash(s: np.ndarray) -> tuple[int, int]:
    return int(mixed(s).sum().view(np.int64)), int(np.bitwise_xor.reduce(mixed(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64))


def digests(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_shingles, h1, h2, sig) of every document."""
    ship(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            sets = [shingles(t, k) for t in texts]
            keys = [set_hash(s) if len(s) else (0, 0) for s in sets]
            yield with_columns(batch, {"text"}, n_shingles=pa.array([len(s) for s in sets], pa.int64()), h1=pa.array([a for a, _ in keys], pa.int64()),
                               h2=pa.array([b for _, b in keys], pa.int64()), sig=pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), text_of(F.col("text")).alias("text"))
    return rows.mapInArrow(digest, "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, sig binary")


def _turned(tree: int, start: int, n: int):
    """``n`` signature values from ``start`` on in the order of a tree: the
    signature turned by LEAST_DEPTH values per tree."""
    at = 2 * ((tree * LEAST_DEPTH + start) % VALUES)
    return F.substring(F.concat("sig", "sig"), at + 1, 2 * n)


def regions(nodes: DataFrame) -> DataFrame:
    """(tree, region, order, node, copies, members) of the members of regions of
    two or more, whatever their number. The trees' prefixes are disjoint values of
    the signature; a longer prefix would lose pairs of every tree at once, so
    large regions are cut by salt (``cross_pairs``), not by depth."""
    trees = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), _turned(t, 0, LEAST_DEPTH).alias("prefix"), _turned(t, LEAST_DEPTH, 12).alias("order")) for t in range(TREES)]))
    rows = nodes.select("node", "copies", trees.alias("t")).select("node", "copies", "t.tree", F.xxhash64("t.tree", "t.prefix").alias("region"), "t.order")
    sizes = rows.groupBy("tree", "region").agg(F.count("*").alias("members"))
    return rows.join(sizes.where(F.col("members") > 1), ["tree", "region"])


def neighbour_pairs(members: DataFrame, each: int = NEIGHBOURS) -> DataFrame:
    """(a, b): all pairs of regions of up to ``each`` + 1 members; in others, every
    member with its ``each`` next members in the region's sorted order, and with
    the region's hub. Sorted ranges cut regions of any size."""
    parts = max(8, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))

    def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple] = []
        for batch in batches:
            rows = last + list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            pairs = [(p[2], q[2]) for j in range(1, each + 1) for p, q in zip(rows, rows[j:]) if p[0] == q[0] and p[1] == q[1]]
            last = rows[-each:]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["a", "b"])

    few = members.where(F.col("members") <= each + 1).groupBy("tree", "region").agg(F.sort_array(F.collect_list("node")).alias("all"))
    whole = few.select("all", F.explode("all").alias("a")).select("a", F.explode("all").alias("b"))
    members = members.where(F.col("members") > each + 1)
    ordered = members.repartitionByRange(parts, "tree", "region", "order", "node").sortWithinPartitions("tree", "region", "order", "node")
    chain = ordered.select("tree", "region", "node").mapInArrow(adjacent, "a long, b long")
    hubs = members.groupBy("tree", "region").agg(F.max_by("node", F.struct("copies", -F.col("node"))).alias("hub"))
    stars = members.join(hubs, ["tree", "region"]).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return _distinct_pairs(chain.unionByName(stars).unionByName(whole))


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def likeness(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs with the share of signature values that agree."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, VALUES) for i in (2, 3))
                yield with_columns(batch, {"sa", "sb"}, likely=pa.array((x == y).mean(axis=1)))

    with_a = pairs.join(nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
    with_b = with_a.join(nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    return with_b.select("a", "b", "sa", "sb").mapInArrow(agree, "a long, b long, likely double")


def shingle_sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, k: int = 5) -> DataFrame:
    """(node, items) of the nodes in ``wanted``: their full shingle sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            yield with_columns(batch, {"text"}, items=pa.array([shingles(t, k).tobytes() for t in texts], pa.binary()))

    ends = nodes.select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).join(wanted.select("node").distinct(), "node")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), text_of(F.col("text")).alias("text"))
    # Repeated rows of a representative have one text: any of them serves.
    texts = rows.join(ends, (F.col("doc_id") == F.col("_id")) & (F.col("text_hash") == F.col("_h"))).select("node", "text")
    return written(texts.mapInArrow(sets, "node long, items binary").dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, k: int = 5) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    items = shingle_sets(ends, docs, nodes, k)
    with_b = pairs.select("a", "b").join(items.withColumnsRenamed({"node": "b", "items": "ib"}), "b")
    with_a = with_b.join(items.withColumnsRenamed({"node": "a", "items": "ia"}), "a")
    return with_a.select("a", "b", "ia", "ib").mapInArrow(keep, "a long, b long").distinct()


def open_matrix(x: pd.DataFrame, y: pd.DataFrame, tree: int, likely: float) -> np.ndarray:
    """Which pairs of two blocks are of different components and agree in a share
    of ``likely`` or more, and meet in no tree before this one."""
    p, q = (np.frombuffer(b"".join(d["sig"]), "<u2").reshape(-1, VALUES) for d in (x, y))
    xn, yn, xc, yc = x["node"].to_numpy(), y["node"].to_numpy(), x["component"].to_numpy(), y["component"].to_numpy()
    # Both ways round only where the other one is of the main component.
    free = (xc[:, None] != yc[None, :]) & (y["main"].to_numpy()[None, :] | (xn[:, None] < yn[None, :]))
    same = np.zeros(free.shape, np.int16)
    for t in range(TREES):
        here = np.zeros(free.shape, np.int16)
        for i in range(t * LEAST_DEPTH, (t + 1) * LEAST_DEPTH):
            here += p[:, i, None] == q[None, :, i]
        if t < tree:
            free &= here < LEAST_DEPTH
        same += here
    return free & (same >= likely * VALUES)


def linked(x: pd.DataFrame, y: pd.DataFrame, todo: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links among the pairs ``todo`` of two blocks, by their full sets. A pair
    that the links found before it join already needs no check."""
    sets = [np.frombuffer(s, np.uint64) for s in (*x["items"], *y["items"])]
    size = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    places = np.concatenate([[0], np.cumsum(size)])
    mine, theirs, xn, yn = x["component"].to_numpy().copy(), y["component"].to_numpy().copy(), x["node"].to_numpy(), y["node"].to_numpy()
    mark, out = np.zeros(len(ids), bool), []
    for i in range(len(x)):
        items = ids[places[i] : places[i + 1]]
        mark[items] = True
        for js in np.array_split(np.flatnonzero(todo[i]), 1 + int(size[len(x) :][todo[i]].sum()) // (1 << 21)):
            js = js[theirs[js] != mine[i]]
            if not len(js):
                continue
            both = np.array([np.count_nonzero(mark[ids[places[j] : places[j + 1]]]) for j in js + len(x)])
            for j in js[100 * both >= percent * (size[i] + size[js + len(x)] - both)]:
                if theirs[j] != mine[i]:
                    out.append((xn[i], yn[j]))
                    old, new = theirs[j], mine[i]
                    mine[mine == old], theirs[theirs == old] = new, new
        mark[items] = False
    return out


def cross_links(members: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, percent: int, likely: float, k: int = 5, block: int = 1024) -> DataFrame:
    """(a, b): links between the components of one region. Every member outside
    the region's largest component meets all members of other components, block
    by block; each pair that agrees in a share of ``likely`` or more is checked on
    full sets, in the first tree that holds it, unless its components are joined
    by then."""
    placed = members.drop("members").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = placed.join(nodes.select("node", "sig"), "node")
    parts = placed.join(nodes.select("node", "n_shingles"), "node").groupBy("tree", "region", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    most = F.max(F.struct("n", (-F.col("component")).alias("c"), "s"))
    regions = parts.groupBy("tree", "region").agg(most.alias("m"), F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    # Regions of up to three members have had all their pairs as neighbours.
    regions = regions.where((F.col("parts") > 1) & (F.col("n") > NEIGHBOURS + 1))
    blocks = lambda n, s: F.ceil(F.greatest(n / block, s / (1 << 20))).cast("int")
    regions = regions.select("tree", "region", (-F.col("m.c")).alias("largest"), blocks(F.col("n"), F.col("s")).alias("rights"),
                             blocks(F.col("n") - F.col("m.n"), F.col("s") - F.col("m.s")).alias("lefts"))
    rows = rows.join(regions, ["tree", "region"]).withColumn("main", F.col("component") == F.col("largest"))
    salt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    fields = ["node", "component", "main", "sig"]
    left = rows.where(~F.col("main")).select("tree", "region", salt("lefts").alias("left"), every("rights").alias("right"), F.lit(True).alias("side"), *fields)
    right = rows.select("tree", "region", every("lefts").alias("left"), salt("rights").alias("right"), F.lit(False).alias("side"), *fields)
    keys = ["tree", "region", "left", "right"]

    def sides(group: pd.DataFrame):
        x, y = (group[group["side"] == s].sort_values("node") for s in (True, False))
        return x, y, open_matrix(x, y, int(group["tree"].iloc[0]), likely) if len(x) and len(y) else np.zeros((len(x), len(y)), bool)

    def still_open(group: pd.DataFrame) -> pd.DataFrame:
        x, y, todo = sides(group)
        return pd.concat([x[todo.any(axis=1)], y[todo.any(axis=0)]])

    def check(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(linked(*sides(group), percent), columns=["a", "b"], dtype="int64")

    both = left.unionByName(right)
    held = written(both.groupBy(*keys).applyInPandas(still_open, both.schema))
    if held.isEmpty():
        return labels.sparkSession.createDataFrame([], "a long, b long")
    full = held.join(shingle_sets(held, docs, nodes, k), "node")
    return _distinct_pairs(full.groupBy(*keys).applyInPandas(check, "a long, b long"))


def number_classes(full: DataFrame) -> DataFrame:
    """(n_shingles, h1, h2, node, doc_id, text_hash, sig, copies): the classes of
    equal sets, each with a number and its smallest document; written as a table,
    so that the numbers stay."""
    classes = full.groupBy("n_shingles", "h1", "h2").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"), F.max("sig").alias("sig"), F.count("*").alias("copies"))
    return written(classes.select("n_shingles", "h1", "h2", F.monotonically_increasing_id().alias("node"), F.col("r.doc_id").alias("doc_id"),
                                  F.col("r.text_hash").alias("text_hash"), "sig", "copies"))


def own_links(full: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between the classes that meet under one doc_id, which are one
    document; each with the first of them. Only ids of several sets are joined."""
    sets = F.struct("n_shingles", "h1", "h2")
    several = full.groupBy("doc_id").agg(F.min(sets).alias("x"), F.max(sets).alias("y")).where(F.col("x") != F.col("y")).select("doc_id")
    met = full.join(several, "doc_id", "left_semi").select("doc_id", "n_shingles", "h1", "h2").distinct()
    met = written(met.join(classes.select("n_shingles", "h1", "h2", "node"), ["n_shingles", "h1", "h2"]).select("doc_id", "node"))
    return _distinct_pairs(met.join(met.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b")))


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """Component of every document under near-duplicate links.

    Two documents are linked if 100 times the size of their sets' intersection
    is at least ``percent`` times that of their union. Returns doc_id, text_hash,
    n_shingles, component_id (the smallest doc_id reachable) and kept, one row
    per input row. Texts without words (null, empty) are linked with nothing. A
    null doc_id takes no part: its component is null and it is kept. All texts
    under one doc_id are one document: a link of any of them is the document's.
    Repeated rows give repeated results; other columns are ignored."""
    spark = docs.sparkSession
    # Room below the threshold for the error of 64 values: over four deviations.
    likely = max(0.0, percent / 100 - 4.2 * (percent / 100 * (1 - percent / 100) / VALUES) ** 0.5)
    rows = written(digests(docs, k))
    full = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = number_classes(full)
    nodes = classes.select("node", "doc_id", "text_hash", "sig", "copies", "n_shingles")
    own = written(own_links(full, classes))
    members = written(regions(nodes))
    pairs = written(likeness(neighbour_pairs(members), nodes).where(F.col("likely") >= likely))
    # First the likeliest candidate of each, then whatever still joins two components.
    ends = pairs.select(F.col("a").alias("node"), "a", "b", "likely").unionByName(pairs.select(F.col("b").alias("node"), "a", "b", "likely"))
    chosen = ends.groupBy("node").agg(F.max(F.struct("likely", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"))).alias("m"))
    first = written(chosen.select((-F.col("m.x")).alias("a"), (-F.col("m.y")).alias("b")).distinct())
    links = written(confirmed(first, docs, nodes, percent, k).unionByName(own))
    labels = written(connected_components(links))
    la, lb = (labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    open_pairs = pairs.select("a", "b").join(first, ["a", "b"], "left_anti").join(la, "a", "left").join(lb, "b", "left")
    open_pairs = written(open_pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    if not open_pairs.isEmpty():
        links = written(links.unionByName(confirmed(open_pairs, docs, nodes, percent, k)))
        labels = written(connected_components(links))
    links = written(links.unionByName(cross_links(members, nodes, labels, docs, percent, likely, k)))
    labels = connected_components(links)
    labelled = written(classes.select("n_shingles", "h1", "h2", "node", "doc_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    # A component is named by its smallest document, which represents its class.
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("least"))
    found = rows.join(labelled.join(least, "component").select("n_shingles", "h1", "h2", "least"), ["n_shingles", "h1", "h2"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("least")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
