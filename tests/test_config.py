"""S4: table paths come from a mandatory base directory setting."""

import pytest

from tessera import IndexSpec, table_path


def test_missing_base_dir_is_an_error(spark):
    old = spark.conf.get("spark.tessera.base.dir")
    spark.conf.unset("spark.tessera.base.dir")
    try:
        with pytest.raises(ValueError):
            table_path(spark, "t")
    finally:
        spark.conf.set("spark.tessera.base.dir", old)


def test_table_path_under_base(spark):
    base = spark.conf.get("spark.tessera.base.dir")
    assert table_path(spark, "t1") == base.rstrip("/") + "/t1"
    with pytest.raises(ValueError):
        table_path(spark, "a/b")


def test_spec_validation(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, s string, x double")
    with pytest.raises(ValueError):
        IndexSpec(text=["s"], keyword=["s"])
    with pytest.raises(ValueError):
        IndexSpec(stored=["doc"])
    with pytest.raises(ValueError):
        IndexSpec(text=["nope"]).validate(df.schema)
    with pytest.raises(TypeError):
        IndexSpec(text=["id"]).validate(df.schema)
    with pytest.raises(TypeError):
        IndexSpec(numeric=["s"]).validate(df.schema)
    IndexSpec(text=["s"], numeric=["x", "id"], stored=["id"]).validate(df.schema)
