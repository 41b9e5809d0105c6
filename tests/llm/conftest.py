import pyarrow.parquet as pq
import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_pd():
    return pq.read_table(f"{DATA}/documents.parquet").to_pandas()


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, text_hash int, component_id string, spans string, _doc int, taken int, `odd name` string"


def frame(spark, rows):
    """Documents with further columns whose names clash with the operators'."""
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), 1.0, "s", 7, "c", "x", 3, 4, "o") for i, t, lang, src in rows], SCHEMA)


LONG = " ".join(f"word{i % 977} the{i % 13}." for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (4, "Hello there my friend of the people.", "en", None),
        (4, "Hello there my friend of the people.", "en", None), (5, "Hello there my friend of the people.", "en", "b"), (None, "Ein Text ohne Nummer und mit Worten.", "de", "b"),
        (None, None, None, None), (6, "1234 5678 !!! ???", "en", "c"), (7, LONG, "en", "c"), (8, "中文字符 テスト", "zh", "d"), (9, "x", None, "d"),
        (9, "y two texts under one id", "en", "d"), (-3, "negative id \x00 and <s> special <|endoftext|> strings", "en", "e"),
    ]
    return frame(spark, rows).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
