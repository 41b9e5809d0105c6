"""Every operator on odd rows and on empty tables."""

from collections import Counter

import numpy as np
import pytest

from hourcast.llm import quality, toxicity
from hourcast.llm.ann_forest import search
from hourcast.llm.ctph import fingerprint, fingerprints, likeness
from hourcast.llm.langid import identify, train
from hourcast.llm.minhash_forest import near_duplicates
from hourcast.llm.mixing import mix_sources
from hourcast.llm.packing import pack_documents
from hourcast.llm.substring import remove_repeats
from hourcast.llm.token_fst import count_tokens
from tests.llm.conftest import frame


def toxic(docs):
    return toxicity.score_toxicity(docs, toxicity.fit([], np.array([])))


def good(docs):
    return quality.score_quality(docs, quality.fit([], np.array([]), quality.word_vectors(docs)))


OPERATORS = {
    "toxicity": toxic, "quality": good, "fingerprints": fingerprints, "tokens": count_tokens, "mix": mix_sources,
    "near": near_duplicates, "language": lambda d: identify(d, train(d)), "repeats": remove_repeats,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_input_row(name, odd, empty):
    assert OPERATORS[name](odd).count() == odd.count()
    assert OPERATORS[name](empty).count() == 0


def test_repeated_rows_agree(odd):
    for name in ("tokens", "near", "language", "repeats"):
        rows = [r.asDict() for r in OPERATORS[name](odd).where("doc_id = 4").collect()]
        assert len(rows) == 2 and rows[0] == rows[1], name


def test_near_duplicates_of_odd_rows(odd):
    got = {(r["doc_id"], r["n_shingles"]): r for r in near_duplicates(odd).collect()}
    assert got[5, 3]["component_id"] == 4 and not got[5, 3]["kept"] and got[4, 3]["kept"]
    assert got[1, 0]["component_id"] == 1 and got[2, 0]["component_id"] == 2  # empty: linked with nothing
    assert got[None, 3]["component_id"] is None and got[None, 3]["kept"]


def test_language_of_odd_rows(odd):
    got = {}
    for r in OPERATORS["language"](odd).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for doc in (1, 2, 3, 6):
        assert got[doc][0]["lang_pred"] == "und" and got[doc][0]["score"] == 0 and got[doc][0]["spans"] == []
    assert got[8][0]["lang_pred"] == "zh"  # the only language of its scripts
    assert all(0 <= r["score"] <= 1 for rs in got.values() for r in rs)


def test_nothing_learned_is_undetermined(odd):
    assert {r[0] for r in identify(odd, train(odd.where("false"))).select("lang_pred").distinct().collect()} == {"und"}


def test_mix_of_odd_rows(odd):
    rows = mix_sources(odd).toPandas()
    assert (rows.taken <= 3 * rows["size"]).all() and rows.source.isna().sum() == 3
    assert rows[["source", "source_size"]].drop_duplicates().source_size.sum() == rows["size"].sum()


def test_packing_of_odd_rows(odd, empty):
    rows = pack_documents(odd).toPandas()
    assert pack_documents(empty).count() == 0
    assert rows.groupby("sequence_id").length.sum().max() <= 2048
    one = rows[rows.doc_id == 1]
    assert one.length.tolist() == [1] and one.doc_tokens.tolist() == [1]


def test_fingerprints_of_odd_rows(odd):
    rows = fingerprints(odd).toPandas()
    by_text = rows.groupby("doc_id", dropna=False).fingerprint.nunique()
    assert by_text[4] == 1 and rows[rows.doc_id == 1].fingerprint.iloc[0] == fingerprint("")
    assert likeness(fingerprint("a b c"), fingerprint("a b c")) == 1.0
    assert rows.near_edited.between(0, 1).all() and rows.near_next.between(0, 1).all()


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (6, [1.0]),
            (7, [0.5, 0.5]), (8, [0.5, 0.5]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (40, [nan, 0.0])]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in search(df, lambda v: v % 20 == 0, k=3, trees=4).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 0.5), (0, 2, 8, 0.5), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 7, 0.5), (20, 3, 8, 0.5)]
    assert search(df.where("false"), lambda v: v % 20 == 0).count() == 0


def test_classifiers_of_one_label():
    for y in (0, 1):
        model = toxicity.fit(["a b", "c d"], np.array([y, y]))
        assert ((model.scores(["a", ""])[0] >= 0.5) == bool(y)).all()


def test_links_of_every_text_under_an_id(spark):
    """One id with two unlike texts, and near copies of each of them."""
    words = [[f"{c}{i}" for i in range(60)] for c in "xy"]
    rows = []
    for c, base in enumerate(words):
        rows.append((1, " ".join(base), "en", "s"))
        for k in range(3):
            rows.append((10 * (c + 1) + k, " ".join([*base[: 57 - k], *[f"z{c}{k}{i}" for i in range(3 + k)]]), "en", "s"))
    rows += [(50, "alone " * 9, "en", "s"), (1, " ".join(words[0]), "en", "s"), (2, " ".join(words[1]) + " more", "en", "s")]
    got = near_duplicates(frame(spark, rows).repartition(4), percent=80).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == (50 if r["doc_id"] == 50 else 1) and r["kept"] == (r["doc_id"] in (1, 50))


def test_training_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(4, 0)] * 30 + [(6, 1), (6, 0), (None, 1), (8, None), (90, 7), (91, 1)], "doc_id long, toxic int")
    rows = [(i, f"text {i}", "en", "s") for i in range(40)] + [(4, f"version {k}", "en", "s") for k in range(300)] + [(6, "conflict", "en", "s"), (None, "none", "en", "s"), (91, "x" * 30_000, "en", "s"), (1, None, "en", "s")]
    texts, ys = toxicity.training_sample(frame(spark, rows).repartition(3), labels, "toxic", most=15)
    assert all(13 <= n <= 15 for n in Counter(ys.tolist()).values()) and len(set(texts)) == len(texts)
    texts, ys = toxicity.training_sample(frame(spark, rows).repartition(3), labels, "toxic", most=100)
    # 6 has both labels, 91 is too long, 1 has two texts and teaches with one.
    assert Counter(ys.tolist()) == {0: 19, 1: 20}
    assert sum(t.startswith("version") or t == "text 4" for t in texts) == 1 and "conflict" not in texts and "none" not in texts
    assert ys[texts.index("text 3")] == 1
    again = toxicity.training_sample(frame(spark, rows[::-1]).repartition(5), labels, "toxic", most=100)
    assert again[0] == texts and again[1].tolist() == ys.tolist()
    assert toxicity.training_sample(frame(spark, []), labels, "toxic")[0] == [] == toxicity.training_sample(frame(spark, rows), labels.where("false"), "toxic")[0]
