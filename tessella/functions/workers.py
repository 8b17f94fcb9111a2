"""Python workers that can import this package wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_shipped: set[str] = set()
#: Rows of an Arrow batch, and the session's setting for it with its default.
BATCH_ROWS, BATCH_SETTING, BATCH_DEFAULT = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Send the package's code to the workers, once for each application.

    Rows hold whole texts, tiles or files here, so batches are made smaller, unless the session asks
    for another size than the default.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    where = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(where, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(where)
    _shipped.add(context.applicationId)


def arrow_map(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
