"""A trigram index for the search box: a selective search reads only files that can match.

The index is a Parquet table beside the published rows (in a hidden folder of the table's current
version, so it goes with that version): one row per trigram of ``searchtext`` and data file that
has it, and one with an empty trigram for every indexed file. A search takes the trigrams of the
needle's literal runs, keeps the files that have all of them, and runs the plain predicate over
just those. The result is the same as without the index:

* files without index rows (appended after it was built) are always read;
* a needle without a run of three characters reads all files, as does a table without an index.

Building is one pass over ``searchtext``: trigrams are reduced to distinct ones per file with map-side
aggregation, and sorted by trigram so that a lookup skips the other row groups.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.operators.search import literal_runs, match, normalize_query
from disclosure.session import folder_exists, path_part
from disclosure.sinks.tables import FILE_FORMATS, table_details
from disclosure.sources.listing import _glob_escape

INDEX_FOLDER = "_trigrams"
LENGTH = 3
_GRAM = rf"(?s)(?=(.{{{LENGTH}}}))."  # at every character, the characters from it on


def _place(spark: SparkSession, table: str) -> tuple[str, str]:
    details = table_details(spark, table)
    provider = details["Provider"].lower()
    if provider not in FILE_FORMATS:
        raise ValueError(f"{table} is a {provider} table; a trigram index needs data files")
    return provider, details["Location"].rstrip("/")


def file_grams(rows: DataFrame) -> DataFrame:
    """``hash, gram``: the trigrams of the texts ``t`` of every ``file``, and an empty one.

    Paths are long, so they are hashed before the texts are taken apart. Should two have one hash,
    each gets the trigrams of both, and a search reads a file too many.
    """
    grams = F.coalesce(F.regexp_extract_all("t", F.lit(_GRAM), 1), F.array().cast("array<string>"))
    held = F.concat(F.array(F.lit("")), grams)
    return rows.select(F.xxhash64("file").alias("hash"), F.explode(held).alias("gram")).distinct()


def build_index(spark: SparkSession, table: str, column: str = "searchtext") -> None:
    """Indexes all data files of the table's current version (again, if there was an index)."""
    _, location = _place(spark, table)
    rows = spark.table(table).select(F.col(column).alias("t"), F.col("_metadata.file_path").alias("file"))
    files = rows.select(F.xxhash64("file").alias("hash"), "file").distinct()
    pairs = file_grams(rows).join(files, "hash").select("file", "gram")
    pairs.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{location}/{INDEX_FOLDER}")


def trigrams(q: str | None) -> list[str]:
    """The trigrams that every matching text has."""
    found = {run[i : i + LENGTH] for run in literal_runs(q) for i in range(len(run) - LENGTH + 1)}
    return sorted(found)


def candidate_files(spark: SparkSession, table: str, q: str | None) -> list[str] | None:
    """Data files that may hold matches; None: all of them."""
    _, location = _place(spark, table)
    path, grams = f"{location}/{INDEX_FOLDER}", trigrams(q)
    if not grams or not folder_exists(spark, path):
        return None
    index = spark.read.schema("file string, gram string").parquet(path)
    here = index.filter(F.col("gram").isin("", *grams)).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    left_out = here.filter(F.col("n") <= len(grams)).select("file").collect()  # at most one row per data file
    known = {_plain(r["file"]) for r in left_out}
    return [f for f in spark.table(table).inputFiles() if _plain(f) not in known]


def _plain(path: str) -> str:
    return re.sub("/+", "/", path_part(path))


def search_table(spark: SparkSession, table: str, q: str | None, column: str = "searchtext") -> DataFrame:
    """Rows of the published table that match the search box value, reading only candidate files."""
    rows = spark.table(table)
    if normalize_query(q) == "":
        return rows
    files = candidate_files(spark, table, q)
    if files is not None:
        provider, _ = _place(spark, table)
        if not files:
            return rows.limit(0)
        rows = spark.read.format(provider).schema(rows.schema).load([_glob_escape(unquote(f)) for f in files])
    return rows.filter(match(column, q))
