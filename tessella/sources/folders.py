"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []
#: Bytes of a row group of tables that are cut: what a task holds before it writes.
ROW_GROUP = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a local master (tests on one machine) gets a temporary folder;
    on a cluster each host would have its own, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    _made.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def release(spark: SparkSession) -> None:
    """Remove the folders made so far; DataFrames that read them can't be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    while _made:
        folder = path(_made.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: later steps survive lost executors without a recomputation, and
    several readers share one computation.
    """
    where = new_folder(df.sparkSession, label)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(where, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(where)
