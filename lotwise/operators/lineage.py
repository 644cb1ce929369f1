"""Tables in the folder that driver and executors share, for frames that several plans or branches read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = tempfile.mkdtemp(prefix="shared-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted with what is there when the application ends."""
    place = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return place


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it from there.

    Cuts the lineage: a lost executor costs the running stage only.
    """
    place = shared_path(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
