"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a temporary one only for local sessions that set none."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="alinea-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def folder(spark: SparkSession) -> str:
    """This application's folder in the shared one."""
    return f"{checkpoint_dir(spark)}/alinea/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and return a scan of it.

    This cuts lineage and survives the loss of executors. Unlike ``checkpoint()`` the plan runs once
    and the result is columnar, compressed and sized, so that later joins are planned by real sizes.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when all results have been written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
