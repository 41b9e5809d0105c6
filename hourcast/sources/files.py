"""File sources and sinks: CSV and Parquet scans with declared schemas, writes,
a source audit, and literal dimension tables.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.conform import CORRUPT_COL
from ..schemas import COUNTY_NAMES, SCHEMAS

# Source file of each table in a raw data folder.
RAW_FILES = {
    "power": "train.csv",
    "client": "client.csv",
    "electricity": "electricity_prices.csv",
    "gas": "gas_prices.csv",
    "forecast_weather": "forecast_weather.csv",
    "historical_weather": "historical_weather.csv",
    "mapping": "weather_station_to_county_mapping.csv",
}


def text_schema(schema: StructType) -> StructType:
    """The same columns, all read as text; conform() parses and casts them."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, **options) -> DataFrame:
    """Headered CSV with a declared schema (no inference pass over the data)."""
    reader = spark.read.option("header", "true").options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_to_judge(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Headered CSV with every column as text, and the whole line in
    ``CORRUPT_COL`` where its number of fields is wrong: the input of
    :func:`hourcast.operators.conform.conform_or_reject`."""
    wide = text_schema(schema).add(StructField(CORRUPT_COL, StringType(), True))
    return read_csv(spark, path, wide, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT_COL, **options)


def load_raw_tables(
    spark: SparkSession, data_dir: str, as_text: bool = True, files: Mapping[str, str] = RAW_FILES
) -> dict[str, DataFrame]:
    """The seven raw CSVs; read as text so that conform() owns parsing and casts."""
    out = {}
    for name, file in files.items():
        schema = SCHEMAS[name]
        out[name] = read_csv(spark, os.path.join(data_dir, file), text_schema(schema) if as_text else schema)
    return out


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Iterable[str], order: Iterable[str], buckets: int
) -> DataFrame:
    """Write ``df`` as the table ``table``, bucketed by ``keys`` and sorted by
    ``order`` inside the buckets, under ``path`` (a shared folder), and read it.

    Windows and aggregates over the keys, or over more columns than the keys,
    then need no exchange: rows of a series lie in one bucket. Each bucket is
    written by one task, so there is one file per bucket."""
    keys = list(keys)
    # The hash and the number are those of the buckets: one file each.
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys, *order)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*order).saveAsTable(table)
    return df.sparkSession.table(table)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def write_json_record(spark: SparkSession, record: Mapping[str, object], path: str) -> None:
    """One small record (run summary, model metadata) as a JSON file set."""
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(record, default=str)], 1))
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json_record(spark: SparkSession, path: str) -> dict:
    rows = spark.read.json(path).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one record at {path}, found {len(rows)}")
    return rows[0].asDict(recursive=True)


def folder_manifest(spark: SparkSession, folder: str, expected: Iterable[str]) -> DataFrame:
    """One row per expected or found name in ``folder``: files, bytes, presence.

    A name is a file or a folder of files (``client.csv``, ``orders.parquet``).
    Only the file listing is read, by Spark, on any file system; an absent file
    or an empty folder is a row with ``present = false``, not an error."""
    names = spark.createDataFrame([(n,) for n in expected], "name string")
    empty = spark.createDataFrame([], "name string, n_files long, n_bytes long")
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    except AnalysisException:  # no such folder
        files = None
    if files is not None:
        # The part of the path after the folder, up to the next slash.
        last = folder.rstrip("/").rsplit("/", 1)[-1]
        inside = F.substring_index(F.substring_index("path", f"/{last}/", -1), "/", 1)
        empty = files.groupBy(inside.alias("name")).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    return names.join(empty, "name", "full").withColumn("present", F.col("n_files").isNotNull())


def source_audit(
    spark: SparkSession, tables: Mapping[str, DataFrame], expected: Iterable[str] = ()
) -> DataFrame:
    """One row per expected or found table: rows, files, bytes and presence.

    Counts come from one aggregate per table over no columns (the scan reads
    only row-group metadata); files and bytes from the hidden ``_metadata``
    column of file sources.
    """
    found = []
    for name, df in tables.items():
        agg = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
        part = agg.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s")).agg(
            F.sum("n").cast("long").alias("n_rows"),
            F.count(F.lit(1)).cast("long").alias("n_files"),
            F.sum("s").cast("long").alias("n_bytes"),
        )
        found.append(part.select(F.lit(name).alias("table_name"), "n_rows", "n_files", "n_bytes"))
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    exp = list(expected)
    if exp:
        names = spark.createDataFrame([(n,) for n in exp], "table_name string")
        result = names.join(result, "table_name", "full")
    return result.withColumn("present", F.col("n_rows").isNotNull())


def county_names(spark: SparkSession) -> DataFrame:
    """County code -> name dimension (16 rows)."""
    rows = [(int(k), v) for k, v in sorted(COUNTY_NAMES.items())]
    return spark.createDataFrame(rows, "county tinyint, county_name string")


def hours_of_day(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(F.col("id").cast("int").alias("hour"))
