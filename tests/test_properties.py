"""Property tests (hypothesis) against pure-Python references."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourcast.operators.series import forward_fill, forward_fill_by_slices, keep_last

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

series_rows = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 60), st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]),
)


def _frame(spark, rows):
    data = [(i, unit, True, h, v) for i, (unit, h, v) in enumerate(rows)]
    return spark.createDataFrame(data, "row_id long, prediction_unit_id int, is_consumption boolean, h int, v double") \
        .withColumn("datetime", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01").cast("timestamp_ntz")))


def _python_ffill(rows):
    out, last = {}, {}
    for i, (unit, h, v) in sorted(enumerate(rows), key=lambda x: (x[1][0], x[1][1])):
        if v is not None:
            last[unit] = v
        out[i] = last.get(unit)
    return out


@SETTINGS
@given(rows=series_rows)
def test_forward_fill_matches_python_and_keeps_values(spark, rows):
    df = _frame(spark, rows)
    want = _python_ffill(rows)
    got = {r["row_id"]: r["v"] for r in forward_fill(df, ["v"]).collect()}
    sliced = {r["row_id"]: r["v"] for r in forward_fill_by_slices(df, ["v"], num_partitions=3).collect()}
    assert got == want and sliced == want
    for i, (_, _, v) in enumerate(rows):
        if v is not None:
            assert got[i] == v  # a fill never changes a present value


versions = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 9))),
                    min_size=1, max_size=40)


@SETTINGS
@given(rows=versions)
def test_keep_last_is_newest_version(spark, rows):
    data = [(k, src, seq, v) for seq, (k, src, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, src int, seq int, v int")
    want = {}
    for k, src, seq, v in sorted(data, key=lambda r: (r[1], r[2])):
        want[k] = (src, seq, v)
    got = {r["k"]: (r["src"], r["seq"], r["v"]) for r in keep_last(df, ["k"], ["src", "seq"]).collect()}
    assert got == want
