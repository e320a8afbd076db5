"""Session settings read by the library."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_DIR_KEY = "spark.tessera.base.dir"
CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"


def base_dir(spark: SparkSession) -> str:
    """Directory (any Hadoop URI) holding every table; required."""
    value = spark.conf.get(BASE_DIR_KEY, None)
    if not value:
        raise ValueError(f"set {BASE_DIR_KEY} to the directory that holds the index tables")
    return value.rstrip("/")


def table_path(spark: SparkSession, table: str) -> str:
    if not table or "/" in table:
        raise ValueError(f"invalid table name: {table!r}")
    return f"{base_dir(spark)}/{table}"


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder, if one is named."""
    value = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def staging_dir(spark: SparkSession) -> str:
    """Shared folder for rows that are fixed once and read again: the
    checkpoint folder, else the base directory.  Only a local session, whose
    executors share the driver's disk, may fall back to a temporary folder."""
    named = checkpoint_dir(spark) or spark.conf.get(BASE_DIR_KEY, None)
    if named:
        return f"{named.rstrip('/')}/tessera-staging"
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError(f"set {CHECKPOINT_DIR_KEY} or {BASE_DIR_KEY} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-cp-"))
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-staging"


def stage(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once in the staging folder and read it back: from then on
    every plan branch and every retry sees the same rows."""
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_local_dirs(spark: SparkSession) -> None:
    """Give the session a base directory when none is set: below the shared
    checkpoint folder, or (local sessions only) below a temporary folder."""
    if not spark.conf.get(BASE_DIR_KEY, None):
        spark.conf.set(BASE_DIR_KEY, f"{staging_dir(spark).rsplit('/', 1)[0]}/tessera-tables")
    staging_dir(spark)
