"""Tables written between the steps of one operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; only a local master may leave it unset and gets one that goes at exit."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="steps-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read back: later passes read the columns they need, and lineage ends there."""
    path = f"{folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def memoised(spark: SparkSession, path: str, build) -> DataFrame:
    """The table at ``path``; the first call builds and writes it, later ones (and later sessions) only read it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
