"""The pipeline's stages: on odd rows, on empty tables, and one by one."""

from collections import Counter

import pytest

import corpus_pipeline as P
from tests.llm.conftest import DATA, frame
from tests.llm.test_results import brute_components


@pytest.mark.parametrize("name, stage", P.STAGES, ids=[n for n, _ in P.STAGES])
def test_odd_and_empty(spark, odd, empty, name, stage):
    out, none = stage(spark, odd, DATA), stage(spark, empty, DATA)
    assert none.count() == 0 and out.count() > 0
    if name != "packed":
        assert out.schema.names == odd.schema.names and none.schema.names == odd.schema.names
        assert [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]


def test_language_keeps_clean_documents(spark, docs, docs_pd):
    kept = {r["doc_id"] for r in P.language(spark, docs, DATA).select("doc_id").collect()}
    letters = {i for i, t in zip(docs_pd.doc_id, docs_pd.text) if any(c.isalpha() for c in t or "")}
    assert kept <= letters and len(kept) >= 0.99 * len(letters)


def test_near_duplicate_keeps_one_of_each_group(spark, docs, docs_pd):
    kept = {r["doc_id"] for r in P.near_duplicate(spark, docs, DATA).select("doc_id").collect()}
    assert kept == set(brute_components(dict(zip(docs_pd.doc_id, docs_pd.text)), 80).values())


def test_mix_repeats_and_cuts(spark):
    rows = [(i, f"w{i} " * 10, "en", "big") for i in range(30)] + [(100, "a b  c\nd", "en", "small")]
    out = P.source_mix(spark, frame(spark, rows), DATA).toPandas()
    small = out[out.source == "small"]  # three times its size at most
    assert small.text.tolist() == ["a b  c\nd"] * 3 and small.n_chars.tolist() == [8] * 3
    assert out[out.source == "big"].text.str.split().str.len().sum() == 304 - 12
    assert (out.n_chars == out.text.str.len()).all()


def test_mix_of_repeated_rows(spark):
    """Repeated rows are cut one at a time: the budgets are met, one text is cut."""
    rows = [(5, "a b c d e f g h i j", "en", "big")] * 30 + [(i, "k " * 10, "en", "other") for i in range(100, 130)]
    out = P.source_mix(spark, frame(spark, rows), DATA).toPandas()
    words = out.text.str.split().str.len()
    assert words.groupby(out.source).sum().to_dict() == {"big": 200, "other": 400}
    assert (words == 10).all()


def test_whole_run(spark, docs_pd):
    pieces = P.run(spark, DATA).toPandas()
    assert pieces.groupby("sequence_id").length.sum().max() <= 2048
    assert set(pieces.doc_id) <= set(docs_pd.doc_id) and Counter(pieces.doc_id)
