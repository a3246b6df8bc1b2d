"""Session helpers of the operators: Arrow batch bounds, and lineage cut at written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.session import SCRATCH_WRITE_OPTIONS, remove_folder, scratch_path

# Rows handed to a Python task at once. Texts may be very long, so batches are small; shuffle
# files of a finished write are dropped at once instead of at the driver's next collection.
CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> None:
    for key, value in CONF.items():
        spark.conf.set(key, value)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Later steps start from files every executor can read, so a lost executor never repeats the
    steps before, and the shuffle files of those steps can go.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**SCRATCH_WRITE_OPTIONS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written steps of one operator, each removed once no later step reads it."""

    def __init__(self) -> None:
        self._folders: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, label: str) -> DataFrame:
        """As :func:`written`."""
        spark = df.sparkSession
        path = scratch_path(spark, label)
        df.write.options(**SCRATCH_WRITE_OPTIONS).parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        self._folders[id(out)] = (out, path)
        return out

    def free(self, *frames: DataFrame) -> None:
        """Removes the folders of written steps; nothing lazy may read them any more."""
        for df in frames:
            _, path = self._folders.pop(id(df), (None, None))
            if path:
                remove_folder(df.sparkSession, path)


def remainder(column: str, divisor: int):
    """crc32 of an id as text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string")) % divisor
