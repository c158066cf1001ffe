"""The folder that all executors see, for tables that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; on one machine, where that is unset, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="excursio-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_place(spark: SparkSession, label: str) -> str:
    """A new place in that folder."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: worked out once, without lineage."""
    place = scratch_place(df.sparkSession, label)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def exists(spark: SparkSession, location: str) -> bool:
    """Whether there is something at a place of any file system that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def names_in(spark: SparkSession, location: str) -> list[str]:
    """Names of the files and folders in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
