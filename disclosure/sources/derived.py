"""Source-shaped inputs derived from the test tables, so every operator's work grows with them.

* :func:`event_inventory` - a file listing ``(path, length, modificationTime)`` under
  :data:`LANDING`: one file per event, in a subfolder per event day, some directly in the base
  folder, with mixed-case ``.csv`` and other suffixes.
* :func:`document_resources` / :func:`catalog_from_documents` - catalog resources (one per
  document) and the catalog JSON documents listing them, one per block of 64 document ids.
* :func:`document_inventory` - the files already in the download folder for those resources
  (some unfinished ``.part`` files, some with a different size).
* :func:`label_outcomes` - one fetch outcome per labelled document, failed when toxic.

Nulls, blanks and odd values are injected by ``id % n`` rules, as the tables hold none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.functions.display import base_name
from disclosure.sources.manifest import catalog_documents
from disclosure.sources.star import read_table

LANDING = "file:/landing"
DOWNLOADS = "file:/downloads"
CATALOG_BLOCK = 64


def _suffix(key: Column) -> Column:
    return (
        F.when(key % 4 == 0, F.lit(".csv"))
        .when(key % 4 == 1, F.lit(".CSV"))
        .when(key % 4 == 2, F.lit(".json"))
        .otherwise(F.lit(".Csv"))
    )


def event_inventory(spark: SparkSession, sf_dir: str, with_direct: bool = True, read=read_table) -> DataFrame:
    """Listing of one file per event under :data:`LANDING`.

    Files sit in a subfolder named after the event day (``yyyyMMdd``); with ``with_direct``,
    events of every tenth user sit directly in the base folder instead.
    """
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    name = F.concat(F.lit("events_"), F.col("event_id").cast("string"), _suffix(F.col("event_id")))
    nested = F.concat(F.lit(LANDING + "/"), F.date_format("ts", "yyyyMMdd"), F.lit("/"), name)
    path = F.when(F.col("user_id") % 10 == 0, F.concat(F.lit(LANDING + "/"), name)) if with_direct else None
    return ev.select(
        (path.otherwise(nested) if path is not None else nested).alias("path"),
        F.floor(F.col("value") * F.lit(100.0)).cast("bigint").alias("length"),
        F.col("ts").alias("modificationTime"),
    )


def document_resources(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    """One catalog resource per document: ``(doc_id, block, id, name, url, size, format)``."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    k = F.col("doc_id")
    return d.select(
        k.alias("doc_id"),
        F.floor(k / F.lit(CATALOG_BLOCK)).alias("block"),
        F.concat(F.lit("doc-"), k.cast("string")).alias("id"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 1, F.lit(""))
        .otherwise(F.concat_ws("", F.col("source"), F.lit("/"), F.col("lang"), F.lit("_"), k.cast("string"), F.lit(".csv")))
        .alias("name"),
        F.concat(F.lit("https://data.example.org/"), F.col("source"), F.lit("/"), k.cast("string")).alias("url"),
        F.when(k % 6 == 0, F.lit(None).cast("bigint")).when(k % 6 == 1, F.lit(0).cast("bigint")).otherwise(F.col("n_chars")).alias("size"),
        F.when(k % 4 == 0, F.lit("CSV"))
        .when(k % 4 == 1, F.lit("csv"))
        .when(k % 4 == 2, F.lit(None).cast("string"))
        .otherwise(F.lit("XLSX"))
        .alias("format"),
    )


def catalog_from_documents(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    """Catalog JSON documents ``(dataset, doc)``, one per block of 64 document ids.

    The block bounds each document (and each ``collect_list`` group) to 64 entries.
    """
    res = document_resources(spark, sf_dir, read)
    docs = catalog_documents(res, ["block"], "doc_id")
    return docs.select(F.concat(F.lit("catalog-"), F.col("block").cast("string")).alias("dataset"), "doc")


def document_inventory(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    """One file in :data:`DOWNLOADS` per document: every third is an unfinished ``.part``
    download (so its entry has no file of its name), some are one byte off."""
    res = document_resources(spark, sf_dir, read)
    k = F.col("doc_id")
    file_name = base_name(F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id")))
    unfinished = F.when(k % 3 == 0, F.lit(".part")).otherwise(F.lit(""))
    length = F.coalesce(F.col("size"), F.lit(0)) + F.when(k % 5 == 2, F.lit(1)).otherwise(F.lit(0))
    return res.select(
        F.concat(F.lit(DOWNLOADS + "/"), file_name, unfinished).alias("path"),
        length.cast("bigint").alias("length"),
    )


def label_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetch outcome ``(name, error)`` per labelled document; toxic ones failed."""
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return lab.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("name"),
        F.when(F.col("toxic") == 1, F.lit("HTTP Error 500: Internal Server Error")).alias("error"),
    )
