"""The driver contract: a stable flagship schema and one oracle per SQL-backed query."""

import __spark_entry__ as entry
from hourcast.schemas import feature_columns


def test_entry_schema_is_stable_and_declared(spark):
    first = entry.entry(spark)
    second = entry.entry(spark)
    assert first.schema == second.schema
    assert first.columns == feature_columns(entry.SMOKE_LAGS)


def test_oracle_names_are_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(sql.strip() for sql in entry.oracle_sql().values())
