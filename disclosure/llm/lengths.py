"""Exact token-length histogram of a corpus, with suffix sums for every context limit.

Documents are encoded once and counted by encoded length; everything else works on that
histogram, which has one row per distinct length and group however many documents there are.
The sums read the histogram twice: write it first (``stage.written``) to encode only once.

A null text counts as a document of 0 tokens, repeated rows count each time, and an empty table
has an empty histogram. Other columns of the documents are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disclosure.llm import bpe

# Lengths summed together before the sums run over buckets, so that no task orders all lengths.
BUCKET = 1024


def length_histogram(docs: DataFrame, path: str, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, ``n_tokens`` and ``n_docs``: documents of each encoded length."""
    counted = bpe.count_tokens(docs.select(*by, text), path, text)
    return counted.groupBy(*by, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The histogram with, for each length taken as a context limit:

    ``docs_at_least`` and ``tokens_at_least`` (documents of that length or more, and their
    tokens), ``truncated_tokens`` (tokens left if every document is cut to that length),
    ``total_docs``, ``total_tokens``, and ``quantile`` (share of documents no longer than it).
    """
    by = list(by)
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = histogram.withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET))
    later = Window.partitionBy(*by).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    key = F.struct(*by, "bucket")  # equal structs join null groups, too
    buckets = (
        rows.groupBy(*by, "bucket")
        .agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
        .select(
            key.alias("bucket_key"),
            F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
            F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
            F.sum("d").over(whole).alias("total_docs"),
            F.sum("t").over(whole).alias("total_tokens"),
        )
    )
    down = Window.partitionBy(*by, "bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.withColumn("row_key", key).join(buckets, F.col("row_key").eqNullSafe(F.col("bucket_key")))
    at_least = joined.withColumns(
        {
            "docs_at_least": F.col("docs_after") + F.sum("n_docs").over(down),
            "tokens_at_least": F.col("tokens_after") + F.sum(tokens).over(down),
        }
    )
    cut = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    shorter = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    return at_least.select(
        *by,
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        cut.alias("truncated_tokens"),
        "total_docs",
        "total_tokens",
        (shorter / F.col("total_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit``, ``docs_at_least``, ``tokens_at_least``, ``truncated_tokens`` of a whole corpus.

    Any limit is answered by the sums of the next length at or above it.
    """
    spark = sums.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context_limit long")
    found = (
        sums.withColumn("context_limit", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])))
        .groupBy("context_limit")
        .agg(
            F.max(F.when(F.col("n_tokens") >= F.col("context_limit"), F.col("docs_at_least"))).alias("d"),
            F.max(F.when(F.col("n_tokens") >= F.col("context_limit"), F.col("tokens_at_least"))).alias("t"),
            F.max("total_tokens").alias("total"),
        )
    )
    docs, tokens = F.coalesce("d", F.lit(0)), F.coalesce("t", F.lit(0))
    return wanted.join(found, "context_limit", "left").select(
        "context_limit",
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.coalesce("total", F.lit(0)) - tokens + F.col("context_limit") * docs).alias("truncated_tokens"),
    )


def length_at(sums: DataFrame, quantile: float) -> DataFrame:
    """``n_tokens``: the smallest length that ``quantile`` of the documents do not exceed."""
    return sums.filter(F.col("quantile") >= quantile).agg(F.min("n_tokens").alias("n_tokens"))
