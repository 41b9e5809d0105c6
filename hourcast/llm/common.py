"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.session import materialize

TABLES = ("documents", "embeddings", "labels")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole driver table, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this library's source, as ``--py-files`` would, once
    for each Spark context. Spark serves the archive to them from the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_hourcast_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    with tempfile.NamedTemporaryFile(prefix="hourcast-", suffix=".zip", delete=False) as f:
        f.write(data.getvalue())
    sc.addPyFile(f.name)
    sc._hourcast_shipped = True


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder of the session."""
    return materialize(df)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id has fold -1)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(-1))


def text_of(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def text_hash(text: Column) -> Column:
    """64-bit hash of a text. Together with doc_id it names a document: rows
    equal in both are one document and get the same result."""
    return F.xxhash64(text_of(text))


def runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Half-open index ranges whose sizes sum to at most ``limit`` (one item at
    least), so that a task holds a bounded amount of decoded text at a time."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20):
    """(slice of the batch, its texts with null as empty) of bounded size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
        for a, b in runs([len(t) for t in texts], limit):
            yield batch.slice(a, b - a), texts[a:b]


def with_columns(batch: pa.RecordBatch, drop: set[str], **columns) -> pa.RecordBatch:
    """``batch`` without ``drop`` and with more columns."""
    names = [n for n in batch.schema.names if n not in drop]
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(v) if not isinstance(v, pa.Array) else v for v in columns.values()], names=names + list(columns))
