"""The menu of tilesets, kept up as metadata files come and change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.discover import tilesets
from tessella.sources.folders import new_folder


def latest(files: DataFrame) -> DataFrame:
    """Of each folder the content written last: ``folder, content`` from ``folder, content, mtime``."""
    return files.groupBy("folder").agg(F.max_by("content", F.struct("mtime", "content")).alias("content"))


def rescanned(spark: SparkSession, files: DataFrame, batches: int = 3) -> DataFrame:
    """Run a table of metadata files through the stream in several batches; the menu after the last."""
    source, sink, log = (new_folder(spark, f"rescans-{n}") for n in ("in", "out", "log"))
    files.repartition(batches, "folder", "mtime").write.parquet(source)
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 1).parquet(source)

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    running = latest(stream).writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", log).trigger(availableNow=True).start()
    running.awaitTermination()
    return tilesets(spark.read.parquet(sink))
