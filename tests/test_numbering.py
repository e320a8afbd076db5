"""Balanced dense numbering equals row_number, also with a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.numbering import number_within


def test_matches_row_number_with_hot_group(spark):
    # group 0 holds a third of the rows
    df = spark.range(0, 3000).select(F.col("id").alias("k"),
                                     F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 50).alias("g"))
    got = number_within(df, "g", ["k"], "n", num_partitions=16)
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    bad = got.join(ref, ["k", "g"]).where(F.col("n") != F.col("r")).count()
    assert bad == 0
    assert got.count() == 3000
    # the hot group is spread over many slices
    slices = got.where("g = 0").select((F.col("k") / 100).cast("int")).distinct().count()
    assert slices > 1


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "k long, g int")
    assert number_within(empty, "g", ["k"], "n").count() == 0
    one = spark.createDataFrame([(5, 1)], "k long, g int")
    assert number_within(one, "g", ["k"], "n").first()["n"] == 0


def test_one_exchange_carries_the_rows(spark):
    """Wide columns are shuffled once, into sorted slices; numbering what was written moves none of them."""
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), F.repeat(F.lit("x"), 100).alias("text"))
    plan = number_within(df, "g", ["k"], "n", num_partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "text#" in plan and "Window" not in plan
    moved = plan.split("Exchange hashpartitioning")
    assert len(moved) == 1, plan


def test_slices_read_in_several_splits(spark):
    """A slice's file is read by many tasks; places are those in the file."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = spark.range(0, 20000).select(F.xxhash64("id").alias("k"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).alias("g"))
        got = number_within(df, "g", ["k"], "n", num_partitions=3)
        ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
        assert got.join(ref, ["k", "g"]).where(F.col("n") == F.col("r")).count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
