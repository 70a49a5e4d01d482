"""Lineage cuts: tables written to the folder that the driver and all executors share, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only local mode may make a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="contrata-cut-")
    return f"file://{_own_folder[app]}"


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and written as Parquet; what is read again survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes cuts that no result reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._cut)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
