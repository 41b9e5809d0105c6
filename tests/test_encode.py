"""Ordered target means against a window, and what a row may not see."""

from pyspark.sql import functions as F

from hourcast.operators.encode import apply_target_means, category_sums, ordered_target_means, running_before

ROWS = [("a", "x", 1, 2.0), ("a", "x", 1, 4.0), ("a", "y", 2, None), ("a", None, 3, 8.0), (None, "x", 2, 1.0), (None, None, 5, float("nan")),
        (None, "x", 9, 3.0), ("b", "y", None, 5.0), ("a", "y", 3, 6.0), ("c", "x", 4, None), ("c", "x", 5, 7.0), ("c", "x", 6, 1.0)]


def brute(rows, by, own):
    """The mean of earlier rows of the category ``own`` (and ``by``), with the prior."""
    out = []
    for r in rows:
        seen = [q[3] for q in rows if r[2] is not None and q[2] is not None and q[2] < r[2] and q[own] == r[own]
                and (by is None or q[by] == r[by]) and q[3] is not None and q[3] == q[3]]
        out.append((sum(seen) + 0.5) / (len(seen) + 1))
    return out


def test_means_of_earlier_rows(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "id int, u string, v string, at int, label double").repartition(3)
    for parts in (1, 4):
        got = ordered_target_means(df, ["u", "v"], "label", "at", num_partitions=parts).orderBy("id").collect()
        assert [r["u_mean"] for r in got] == brute(ROWS, None, 0) and [r["v_mean"] for r in got] == brute(ROWS, None, 1)
    got = ordered_target_means(df, ["v"], "label", "at", by=["u"]).orderBy("id").collect()
    assert [r["v_mean"] for r in got] == brute(ROWS, 0, 1)
    assert ordered_target_means(df.where("false"), ["u"], "label", "at").count() == 0


def test_no_row_sees_its_own_label(spark):
    df = spark.range(400).select("id", (F.col("id") % 7).alias("u"), F.floor(F.col("id") / 5).alias("at"), F.rand(3).alias("label"))
    plain = {r["id"]: r["u_mean"] for r in ordered_target_means(df, ["u"], "label", "at").collect()}
    for changed in (0, 200, 399):
        other = df.withColumn("label", F.when(F.col("id") == changed, 99.0).otherwise(F.col("label")))
        got = {r["id"]: r["u_mean"] for r in ordered_target_means(other, ["u"], "label", "at").collect()}
        assert all(got[i] == plain[i] for i in range(400) if i // 5 <= changed // 5)
        assert any(got[i] != plain[i] for i in range(400)) == (changed < 390)


def test_sums_of_training_rows(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "id int, u string, v string, at int, label double")
    state = category_sums(df, ["u"], "label")
    new = spark.createDataFrame([("a",), (None,), ("new",)], "u string")
    got = {r["u"]: r["u_mean"] for r in apply_target_means(new, state, ["u"]).collect()}
    assert got == {"a": 20.5 / 5, None: 4.5 / 3, "new": 0.5}


def test_running_sums_of_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("g"), F.col("id").alias("at"), F.lit(1).alias("n"))
    got = running_before(df, ["n"], ["g"], ["at"], num_partitions=16)
    hot = {r["at"]: r["_before_n"] for r in got.where("g = 0").collect()}
    order = sorted(hot)
    assert [hot[a] for a in order] == [None, *range(1, len(order))]
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.where("g > 0 and _before_n is not null").count() == 0 and sum(sizes) == 3000
