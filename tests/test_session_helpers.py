import pytest
from pyspark.sql import functions as F

from hourcast.operators.enrich import star_merge
from hourcast.session import ensure_checkpoint_dir, materialize
from hourcast.sources import analog
from tests.conftest import SF_SMALL


def test_materialize_prunes_and_pushes_down(spark):
    stored = materialize(spark.range(100).withColumn("x", F.col("id") * 2))
    assert stored.count() == 100
    plan = stored.filter("id > 90").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,90)" in plan


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: {})
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_star_merge_refuses_repeated_dimension_keys(spark):
    tables = dict(analog.source_tables(spark, SF_SMALL))
    tables["client"] = tables["client"].unionByName(tables["client"])
    with pytest.raises(ValueError, match="duplicate key"):
        star_merge(tables, check_unique=True)
