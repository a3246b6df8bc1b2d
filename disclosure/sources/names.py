"""One text of all names of a DataFrame, put together on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1000  # names joined in one row


def joined_names(names: DataFrame, column: str, separator: str = ", ") -> str:
    """All values of a column (nulls left out), sorted, as one text; ``""`` if there are none.

    A sort spreads the names, also repeated ones, over tasks; every task joins runs of
    :data:`CHUNK` names, and the runs are what the driver gets, in order. No task holds them all.
    """
    tied = names.select(F.col(column).cast("string").alias("name"), F.monotonically_increasing_id().alias("tie")).filter("name IS NOT NULL")
    ordered = tied.orderBy("name", "tie").select("name", F.monotonically_increasing_id().alias("at"))
    runs = ordered.groupBy(F.floor(F.col("at") / CHUNK).alias("run")).agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("held"))
    texts = runs.select("run", F.array_join(F.transform("held", lambda x: x["name"]), separator).alias("text"))
    return separator.join(r["text"] for r in texts.orderBy("run").collect())
