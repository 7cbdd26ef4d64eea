import types

import pytest

from rowloom.session import materialize, scratch_path, scratch_root


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def _session(**conf):
    return types.SimpleNamespace(conf=Conf(conf), sparkContext=types.SimpleNamespace(applicationId=f"app-{id(conf)}"))


def test_the_shared_folder_comes_from_the_session():
    spark = _session(**{"spark.checkpoint.dir": "hdfs://name/shared/", "spark.master": "yarn"})
    assert scratch_root(spark) == "hdfs://name/shared"
    assert scratch_path(spark, "x").startswith("hdfs://name/shared/rowloom/x-")


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_session(**{"spark.master": "spark://host:7077"}))


def test_a_local_session_gets_one_folder():
    spark = _session(**{"spark.master": "local[2]"})
    assert scratch_root(spark) == scratch_root(spark)


def test_materialized_rows_and_types(spark, rows):
    df = spark.range(10).selectExpr("id", "cast(id as decimal(10,2)) as d", "array(id) as a")
    kept = materialize(df)
    assert kept.schema["d"].dataType == df.schema["d"].dataType
    assert kept.agg({"id": "sum"}).first()[0] == 45
    assert materialize(df.filter("id < 0")).count() == 0
