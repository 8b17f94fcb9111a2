"""Running totals of tile requests: the batch aggregates over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import account
from tessella.sources.folders import new_folder


def totals(requests: DataFrame, prefix: str = "") -> DataFrame:
    """A stream of requests to running totals by level."""
    return account.totals(account.classified(requests, prefix), ["z"])


def windowed(requests: DataFrame, prefix: str = "", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Totals by level and window of time, final once the watermark has passed."""
    rows = account.classified(requests.withWatermark("ts", late), prefix)
    return account.totals(rows.withColumn("window", F.window("ts", width)), ["window", "z"])


def counted(spark: SparkSession, requests: DataFrame, prefix: str = "", batches: int = 3) -> DataFrame:
    """Run a table of requests through the stream in several batches; the totals after the last."""
    source, sink, log = (new_folder(spark, f"traffic-{n}") for n in ("in", "out", "log"))
    requests.repartition(batches, "event_id").write.parquet(source)
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(source)

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    running = totals(stream, prefix).writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", log).trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(sink)
