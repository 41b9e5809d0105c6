"""Whitening, best-fit packing and spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hourcast.llm import queries as Q
from hourcast.llm.bestfit import CapacityTree, WordPieces, best_fit_decreasing, pack_best_fit
from hourcast.llm.spelling import Hashes, rotations, spelling_variants
from hourcast.llm.whitening import digits, exact_products, jacobi, limbs, pivoted_cholesky, whiten, whole
from tests.llm.conftest import DATA, frame

VECTORS = "vec_id long, embedding array<double>, n string, size int, x string"


def vectors(spark, rows, parts=2):
    return spark.createDataFrame([(i, v, "n", 3, "x") for i, v in rows], VECTORS).repartition(parts)


# whitening


def expected_whitening(rows, scale=256):
    """(n, deviations, eigenvalue shares, whitened up to sign) by a plain eigensolver."""
    x = np.array([np.floor(np.array(v, float) * scale) for _, v in rows])
    fit = np.unique(x, axis=0)
    values, parts = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, parts = values[::-1][:4], parts[:, ::-1][:, :4]
    far = [sum((len(fit) * int(a) - int(s)) ** 2 for a, s in zip(r, fit.sum(axis=0))) for r in x]
    return len(fit), far, values / np.trace(np.cov(fit.T, bias=True)), (x - fit.mean(axis=0)) @ parts / np.sqrt(values)


def test_whitening_of_the_table(spark):
    table = pd.read_parquet(f"{DATA}/embeddings.parquet").sort_values("vec_id")
    got = Q.op11_embedding_whitening(spark, DATA).toPandas().sort_values(["vec_id", "component"])
    n, far, shares, white = expected_whitening(list(zip(table.vec_id, table.embedding)))
    assert got.vec_id.tolist() == np.repeat(table.vec_id, 4).tolist() and set(got.n) == {n}
    assert got.deviation.tolist() == np.repeat(far, 4).tolist()
    assert np.allclose(got.explained.to_numpy().reshape(-1, 4), shares, rtol=1e-10)
    assert np.allclose(np.abs(got.whitened.to_numpy().reshape(-1, 4)), np.abs(white), atol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    good = [(i, [float(a) for a in rng.normal(size=3) * (5, 1, 0.2)]) for i in range(40)]
    rows = good + [(0, good[0][1]), (None, good[1][1]), (90, None), (91, [nan, 1.0, 1.0]), (92, [1.0, inf, 1.0]), (93, [1.0, None, 1.0]), (94, good[2][1])]
    got = whiten(vectors(spark, rows)).toPandas()
    kept = good + [rows[40], rows[41], rows[46]]
    n, far, shares, white = expected_whitening(kept)
    assert len(got) == 3 * len(kept) and set(got.component) == {1, 2, 3} and set(got.n) == {n} and n == 40
    assert got.vec_id.isna().sum() == 3 and set(got.vec_id.dropna()) == set(range(40)) | {94}
    want = {i: (f, np.abs(w)) for (i, _), f, w in zip(kept, far, white) if i is not None}
    for (i, k), rows_of in got.dropna(subset="vec_id").groupby(["vec_id", "component"]):
        assert set(rows_of.deviation) == {want[i][0]} and len(rows_of) == (2 if i == 0 else 1)
        assert np.allclose(np.abs(rows_of.whitened), want[i][1][k - 1], atol=1e-9)
    assert np.allclose(got.groupby("component").explained.first(), shares[:3])


def test_whitening_without_rank(spark):
    one = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    line = [(i, [i / 4, i / 2]) for i in range(9)]
    assert whiten(vectors(spark, one)).count() == 0
    assert whiten(vectors(spark, [])).count() == 0 and whiten(vectors(spark, [(1, None)])).count() == 0
    assert whiten(vectors(spark, [(1, []), (2, [])])).count() == 0
    got = whiten(vectors(spark, line)).toPandas()
    assert set(got.component) == {1} and np.allclose(got.explained, 1) and len(got) == 9
    with pytest.raises(ValueError, match="several lengths"):
        whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_whitening_of_large_entries(spark):
    rows = [(i, [3.0e14 * (i - 3), float(i * i), 1e300 if i == 5 else -float(i)]) for i in range(7)]
    got = whiten(vectors(spark, rows)).toPandas()
    assert got.deviation.isna().all() and got.identity_error.iloc[0] < 1e-9 and set(got.n) == {7}
    assert whole(np.array([1e300, -1e300, -0.0, 0.999, -0.001]), 256).tolist() == [2**63 - 1, -(2**63), 0, 255, -1]


def test_exact_sums():
    rng = np.random.default_rng(1)
    for most in (3, 1 << 21, 1 << 45, 1 << 62):
        y = rng.integers(-most, most, size=(50, 4))
        assert sum(d.astype(np.int64).astype(object) * 2 ** (20 * k) for k, d in enumerate(digits(y))).tolist() == y.tolist()
        assert exact_products(y).tolist() == (y.T.astype(object) @ y.astype(object)).tolist()
    place, limb, part = limbs([0, -7, 5 << 80, 1 - (1 << 64)])
    back = [0] * 4
    for p, k, v in zip(place.tolist(), limb.tolist(), part.tolist()):
        back[p] += v << (32 * k)
    assert back == [0, -7, 5 << 80, 1 - (1 << 64)]


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 2), (7, 7), (8, 5), (33, 33)])
def test_cholesky_and_jacobi(d, rank):
    a = np.random.default_rng(d).normal(size=(d, rank)) * 10.0 ** -np.arange(rank).clip(max=6)
    v = a @ a.T
    factor = pivoted_cholesky(v)
    assert factor.shape == (d, rank) and np.allclose(factor @ factor.T, v, atol=1e-12 * v.max())
    assert any((np.triu(factor[list(p)], 1) == 0).all() for p in [np.argsort([-(r != 0).sum() for r in factor])[::-1]])
    values, parts = jacobi(factor)
    assert np.allclose(parts.T @ parts, np.eye(rank), atol=1e-10)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-6, atol=1e-13 * v.max())
    assert np.allclose(v @ parts, parts * values, atol=1e-11 * v.max())


# best-fit packing


def one_at_a_time(sizes, limit):
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = [(c, i) for i, c in enumerate(bins) if c >= s]
        if fit:
            bins[min(fit)[1]] -= s
        else:
            bins.append(limit - s)
    return Counter(bins)


def test_counts_pack_as_one_document_at_a_time():
    rng = Random(1)
    for _ in range(150):
        limit = rng.choice([1, 7, 16, 50, 100])
        sizes = [rng.randint(1, rng.choice([limit, max(1, limit // 3)])) for _ in range(rng.randint(0, 200))]
        counts, bins = Counter(sizes), defaultdict(list)
        runs = best_fit_decreasing(counts, limit)
        for size, rank, first, each, offset in runs:
            end = min([r for s, r, *_ in runs if s == size and r > rank], default=counts[size])
            for r in range(rank, end):
                bins[first + (r - rank) // each].append((offset + (r - rank) % each * size, size))
        room = Counter()
        for placed in bins.values():
            at = 0
            for offset, size in sorted(placed):
                assert offset == at
                at += size
            room[limit - at] += 1
        assert room == one_at_a_time(sizes, limit)


def test_capacity_tree():
    tree, rng, held = CapacityTree(40), Random(2), Counter()
    for _ in range(500):
        c = rng.randint(1, 40)
        n = rng.randint(-held[c], 3)
        held[c] += n
        tree.add(c, n)
        for size in (1, 13, 40):
            assert tree.tightest(size) == min((k for k, v in held.items() if v and k >= size), default=None)


def test_word_ids_are_the_library_s(docs_pd):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t or "" for t in docs_pd.text] + [
        "", " \t\n", "It's WE'LL 'SAM \"'s x'd 12³ ½ a b c\x1cd\x85e", "<|endoftext|> a<|startoftext|>b <|", "é ́a É × ÷ ß ÿ Ÿ İ ſ ǆ",
        "中文 テスト 한국어 🙂🙂 \x00\x01", "Straße" * 400, "a" * 5000, "Ω ﬁ ²‍İx" * 30, "ª º µ ­ßẞ",
    ]
    pieces = WordPieces(most=50)  # forgets all the time
    for a in range(0, len(texts), 7):
        some = texts[a : a + 7]
        want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in pieces.ids(some)] == want


def check_pieces(rows: pd.DataFrame, texts, limit=2048):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((i, k // limit, k, len(ids[k : k + limit]), zlib.crc32(ids[k : k + limit].tobytes())) for k in range(0, len(ids), limit))
    cols = rows[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert Counter((None if pd.isna(r[0]) else int(r[0]), *map(int, r[1:])) for r in cols.itertuples(index=False, name=None)) == want
    placed = rows.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= limit
    assert rows.sequence_id.nunique() == sum(one_at_a_time(rows.length.tolist(), limit).values())


def test_best_fit_packing_of_the_table(spark, docs_pd):
    check_pieces(Q.op12_best_fit_packing(spark, DATA).toPandas(), zip(docs_pd.doc_id, docs_pd.text))


def test_best_fit_packing_of_odd_rows(spark, odd, empty):
    rows = pack_best_fit(odd).toPandas()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()])
    assert rows[rows.doc_id == 1].length.tolist() == [1] and (rows.doc_id == 4).sum() == 2
    assert pack_best_fit(empty).count() == 0
    small = pack_best_fit(odd.where("doc_id < 7"), limit=4).toPandas()
    assert small.groupby("sequence_id").length.sum().max() <= 4


# spelling variants


def brute_variants(rows, least=7, least_n=2, times=10):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = "".join(c for k, c in enumerate(run) if k != h % len(run))
            if len(run) >= least:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= least_n}
    letters, near = sorted({c for w in count for c in w}), defaultdict(set)
    for w in count:
        for i in range(len(w)):
            if (v := w[:i] + w[i + 1 :]) in count:
                near[w].add(v)
                near[v].add(w)
            near[w] |= {v for c in letters if c != w[i] and (v := w[:i] + c + w[i + 1 :]) in count}
    form, out = {}, {}
    for w, n in count.items():
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= times * n else None
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), count[form[w]] if form[w] else None)
    return out


def variants(df, **how):
    got = spelling_variants(df, **how).collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


def test_variants_of_the_table(spark, docs_pd):
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in Q.op13_spelling_variants(spark, DATA).collect()}
    assert got == brute_variants(zip(docs_pd.doc_id, docs_pd.text)) and any(v[0] for v in got.values())


def test_variants_in_chains_and_ties(spark, empty):
    words = {"abcdefgh": 1500, "abcdefg": 75, "abcdefgx": 75, "bbcdefgx": 4, "xabcdefgx": 4, "aabcdefgx": 4, "aaaaaaaa": 300, "aaaaaaa": 30, "aaaaaab": 3,
             "ÀÉabcdef": 20, "àÉabcdef": 2, "Zyxwvut": 2, "lonesome": 1, "short": 90}
    tokens = [w for w, n in words.items() for _ in range(n)]
    Random(5).shuffle(tokens)
    rows = [(i // 2 if i else None, " ".join(tokens[a : a + 90]), "en", "s") for i, a in enumerate(range(0, len(tokens), 90))]
    rows += [(7, None, None, None), (8, "", "en", "a"), (None, "12 ... ", "en", "a"), rows[3], rows[3]]
    want = brute_variants([(i, t) for i, t, *_ in rows])
    assert variants(frame(spark, rows).repartition(5)) == want
    assert max(v[3] for v in want.values()) >= 3 and any(v[0] and v[0] != v[1] for v in want.values())
    assert spelling_variants(empty).count() == 0


def test_variants_of_random_words(spark):
    rng = Random(9)
    bag = ["".join(rng.choice("abé") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    text = " ".join(w for w in bag for _ in range(rng.choice([1, 1, 2, 30, 400])))
    rows = [(i, text[a : a + 900], "en", "s") for i, a in enumerate(range(0, len(text), 900))]
    assert variants(frame(spark, rows).repartition(4), least_letters=2) == brute_variants([(i, t) for i, t, *_ in rows], least=2)


def test_variants_of_very_long_words(spark):
    rng = Random(4)
    for size in (63, 64, 65, 66, 3000):
        base = "".join(rng.choice("abc") for _ in range(size))
        near = [base, base[:9] + "z" + base[9:], base[:-1] + "y", base[:20] + base[21:], base[:5] + "zz" + base[5:]]
        rows = [(i, " ".join([w] * n), "en", "s") for i, (w, n) in enumerate(zip(near, (40, 2, 3, 2, 2)))]
        assert variants(frame(spark, rows)) == brute_variants([(i, t) for i, t, *_ in rows])


def test_hashed_rotations_tell_as_plain_ones():
    word = "abcaabbccabc" * 8
    marked = word + "$"
    keys = {(marked * 2)[s : s + n]: Hashes(marked).key(s, n) for s in range(len(marked)) for n in (70, 71, len(marked))}
    assert len(set(keys.values())) == len(keys)
    long, kinds = list(rotations("ab" * 600_000)), Counter()
    for _, kind in long:
        kinds[kind] += 1
    assert kinds == {2: 1_200_000, 0: 1_200_001} and max(len(k) for k, _ in long[:1000]) < 70
