"""Schema conformance: required columns, text parsing, projection, strict casts.

Strictness comes from ANSI mode: a value that does not fit the declared type
(text ``xx`` as a timestamp, county 300 as a byte) raises at run time instead
of turning into null. ``lenient=True`` uses ``try_cast`` / ``try_to_timestamp``
and keeps bad values as null. :func:`conform_or_reject` sets whole rows aside,
with the reasons.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampNTZType

from ..schemas import DATE_FORMAT, TIMESTAMP_FORMAT
from ..session import materialize

# Columns whose text holds a date although the declared type is a timestamp.
DATE_TEXT_COLUMNS: dict[str, dict[str, str]] = {"gas": {"forecast_date": DATE_FORMAT}}


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Raise ``ValueError`` naming every missing column (checked at analysis time)."""
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"Missing columns: {', '.join(missing)}")
    return df


def parse_timestamp(col: Column, fmt: str = TIMESTAMP_FORMAT, lenient: bool = False) -> Column:
    """Text to ``TIMESTAMP_NTZ`` in local wall-clock time (no zone shift)."""
    if lenient:
        # As instants in UTC whatever the session zone, then the same wall clock
        # without a zone: no hour is shifted.
        stamp = F.try_to_timestamp(F.concat(col, F.lit(" +0000")), F.lit(f"{fmt} xx"))
        return F.timestamp_add("MICROSECOND", F.unix_micros(stamp), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.to_timestamp_ntz(col, F.lit(fmt))


def parse_date(col: Column, fmt: str = DATE_FORMAT, lenient: bool = False) -> Column:
    if lenient:
        return F.try_to_date(col, fmt) if hasattr(F, "try_to_date") else F.to_date(col.try_cast("string"), fmt)
    return F.to_date(col, fmt)


def _conform_column(
    source, name: str, target, formats: Mapping[str, str], lenient: bool
) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(source, StringType) and not isinstance(target, StringType):
        col = F.nullif(col, F.lit(""))  # an empty field is a missing value, as in CSV
    if isinstance(source, StringType) and isinstance(target, TimestampNTZType):
        fmt = formats.get(name, TIMESTAMP_FORMAT)
        if fmt == DATE_FORMAT:
            return parse_date(col, fmt, lenient).cast("timestamp_ntz")
        return parse_timestamp(col, fmt, lenient)
    if isinstance(source, StringType) and isinstance(target, DateType):
        return parse_date(col, formats.get(name, DATE_FORMAT), lenient)
    if lenient:
        return col.try_cast(target)
    return col.cast(target)


def conform(
    df: DataFrame,
    schema: StructType,
    formats: Mapping[str, str] | None = None,
    renames: Mapping[str, str] | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Rename -> check required columns -> parse text -> project in schema order -> cast.

    Everything happens in one projection, so Catalyst prunes every other
    column from the scan.
    """
    if renames:
        df = df.withColumnsRenamed(dict(renames))
    require_columns(df, schema.names)
    formats = dict(formats or {})
    source = {f.name: f.dataType for f in df.schema.fields}  # one schema round trip
    return df.select(
        *[_conform_column(source[f.name], f.name, f.dataType, formats, lenient).alias(f.name)
          for f in schema.fields]
    )


CORRUPT_COL = "_corrupt_record"
MALFORMED = "malformed record"
REASONS_COL = "_reasons"


def reject_reasons(
    df: DataFrame, schema: StructType, formats: Mapping[str, str] | None = None, required: Iterable[str] = (),
) -> Column:
    """Why a row can't be conformed, as an array of texts in schema order (empty
    for a good row): a malformed record (``CORRUPT_COL`` of the reader, the only
    reason then), a value that doesn't fit its declared type, a missing value in
    a ``required`` column."""
    formats, required = dict(formats or {}), set(required)
    source = {f.name: f.dataType for f in df.schema.fields}
    reasons = []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`")
        if isinstance(source[f.name], StringType):
            raw = F.nullif(raw, F.lit(""))
        fitted = _conform_column(source[f.name], f.name, f.dataType, formats, True)
        reasons.append(F.when(raw.isNotNull() & fitted.isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
        if f.name in required:
            reasons.append(F.when(raw.isNull(), F.lit(f"{f.name}: missing")))
    found = F.array_compact(F.array(*reasons))
    if CORRUPT_COL in source:
        found = F.when(F.col(CORRUPT_COL).isNotNull(), F.array(F.lit(MALFORMED))).otherwise(found)
    return found


def conform_or_reject(
    df: DataFrame,
    schema: StructType,
    formats: Mapping[str, str] | None = None,
    renames: Mapping[str, str] | None = None,
    required: Iterable[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): every row of ``df`` is in one of the two.

    Good rows are conformed as :func:`conform` would; rejected rows keep their raw
    columns and have ``REASONS_COL``. The source is read once: rows, cast values
    and reasons are written as a table partitioned by the verdict, and each side
    reads its own partition.
    """
    if renames:
        df = df.withColumnsRenamed(dict(renames))
    require_columns(df, schema.names)
    source = {f.name: f.dataType for f in df.schema.fields}
    cast = F.struct(*[_conform_column(source[f.name], f.name, f.dataType, dict(formats or {}), True).alias(f.name) for f in schema.fields])
    judged = df.withColumns({"_cast": cast, REASONS_COL: reject_reasons(df, schema, formats, required)})
    judged = materialize(judged.withColumn("_good", F.size(REASONS_COL) == 0), partition_by=["_good"])
    good = judged.filter(F.col("_good")).select("_cast.*")
    return good, judged.filter(~F.col("_good")).drop("_cast", "_good")


def conform_table(df: DataFrame, table: str, schema: StructType, lenient: bool = False) -> DataFrame:
    return conform(df, schema, formats=DATE_TEXT_COLUMNS.get(table), lenient=lenient)


def with_null_column(df: DataFrame, name: str, dtype: str = "double") -> DataFrame:
    """A typed null column (e.g. the unknown target of rows to predict)."""
    return df.withColumn(name, F.lit(None).cast(dtype))


def align_to(df: DataFrame, template: StructType) -> DataFrame:
    """Project onto a template schema: missing columns become typed nulls,
    extra columns are dropped, order follows the template."""
    cols = []
    present = set(df.columns)
    for f in template.fields:
        if f.name in present:
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_aligned(frames: Iterable[DataFrame], template: StructType | None = None) -> DataFrame:
    """Vertical concat by name; frames are aligned to ``template`` (or the first frame)."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    tmpl = template or frames[0].schema
    out = align_to(frames[0], tmpl)
    for f in frames[1:]:
        out = out.unionByName(align_to(f, tmpl))
    return out


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; absent names are ignored."""
    present = set(df.columns)
    return df.drop(*[c for c in cols if c in present])
