"""File listings and snapshot choice, as DataFrame work.

A *listing* (or inventory) is a DataFrame ``(path, length, modificationTime)``. The real one
comes from Spark's ``binaryFile`` source with ``content`` never selected, so no file body is
read and listing a large tree is done by Spark's parallel file index. Every operator below
takes a listing DataFrame, so the same logic serves real folders and derived inventories.

Snapshot rules of the source layout (a folder of CSVs, or a base folder of dated subfolders):

* ``direct_csv_files``: files directly in the base folder whose name ends with ``.csv`` in any
  case, sorted by path.
* ``latest_subfolder``: the first-level subfolder holding the newest file (greatest
  modification time among all files below it; ties go to the greatest name).
* ``resolve`` / ``snapshot_glob``: a path ending in ``.csv`` is that file; else the base's own
  CSV files if it has any (even when newer subfolders exist); else the CSV files directly in
  the latest subfolder. Nothing found raises ``ValueError``. The job reads the snapshot through
  ``snapshot_glob``, a glob that Spark's file index expands.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.functions.display import has_csv_suffix
from disclosure.session import file_names, folder_times, remove_folder, subfolders

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?"


CSV_GLOB = "*.[cC][sS][vV]"


def _glob_escape(text: str) -> str:
    """``text`` with glob characters escaped, so Spark reads it as a literal path."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", text)


def path_only(path: Column | str) -> Column:
    """The path part of a URI column (scheme and authority removed)."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(c, _SCHEME, "")


def _base_path(base: str) -> str:
    parsed = urlparse(base)
    p = parsed.path if parsed.scheme else base
    return p.rstrip("/") or "/"


def list_tree(spark: SparkSession, base: str) -> DataFrame:
    """Every file below ``base`` (recursive) as ``(path, length, modificationTime)``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(_glob_escape(base))
        .select("path", "length", "modificationTime")
    )


def with_relative(listing: DataFrame, base: str) -> DataFrame:
    """Adds ``rel`` (path below ``base``), ``folder`` (first segment or null) and ``depth``.

    Entries outside ``base`` are dropped. One anchored regex both checks the prefix (with any
    scheme/authority) and extracts the relative part.
    """
    pattern = f"^(?:{_SCHEME[1:]})?" + re.escape(_base_path(base).rstrip("/")) + "/(.+)$"
    rel = F.regexp_extract(F.col("path"), pattern, 1)
    slashes = F.length(F.col("rel")) - F.length(F.regexp_replace(F.col("rel"), "/", ""))
    return (
        listing.withColumn("rel", rel)
        .filter(F.col("rel") != "")
        .withColumn("depth", slashes)
        .withColumn("folder", F.when(F.col("depth") > 0, F.substring_index(F.col("rel"), "/", 1)))
    )


def _direct_csv(listing: DataFrame, base: str) -> DataFrame:
    rel = with_relative(listing, base)
    return rel.filter((F.col("depth") == 0) & has_csv_suffix("rel")).select("path", "length", "modificationTime")


def direct_csv_files(listing: DataFrame, base: str) -> DataFrame:
    """CSV files directly in ``base`` (not in its subfolders), sorted by path."""
    return _direct_csv(listing, base).orderBy("path")


def subfolder_times(listing: DataFrame, base: str) -> DataFrame:
    """One row per first-level subfolder: ``folder``, ``newest`` file time, ``files``."""
    return (
        with_relative(listing, base)
        .filter(F.col("folder").isNotNull())
        .groupBy("folder")
        .agg(F.max("modificationTime").alias("newest"), F.count(F.lit(1)).alias("files"))
    )


def latest_subfolder(listing: DataFrame, base: str) -> DataFrame:
    """One row ``(folder, newest)``: the subfolder with the newest file; no row if none."""
    times = subfolder_times(listing, base)
    return times.agg(
        F.max_by(F.col("folder"), F.struct("newest", "folder")).alias("folder"),
        F.max("newest").alias("newest"),
    ).filter(F.col("folder").isNotNull())


def _snapshot_folder(rel: DataFrame) -> DataFrame:
    """One row ``(depth, folder)`` saying where the snapshot's CSV files are; no row if nowhere.

    One aggregation by first-level folder (null: the base itself), then the choice among its
    rows: the base if it holds a CSV file, else the folder with the newest file, which must hold
    CSV files directly.
    """
    here = has_csv_suffix("rel") & (F.col("depth") == F.when(F.col("folder").isNull(), 0).otherwise(1))
    folders = rel.groupBy("folder").agg(F.max("modificationTime").alias("newest"), F.count_if(here).alias("files"))
    return folders.agg(
        F.coalesce(F.max(F.when(F.col("folder").isNull(), F.col("files"))), F.lit(0)).alias("direct"),
        F.max(F.when(F.col("folder").isNotNull(), F.struct("newest", "folder", "files"))).alias("latest"),
    ).select(
        F.when(F.col("direct") > 0, 0).when(F.col("latest.files") > 0, 1).alias("depth"),
        F.when(F.col("direct") == 0, F.col("latest.folder")).alias("folder"),
    )


def _no_files(source: str) -> ValueError:
    return ValueError(f"No .csv files found in {source} or its latest subfolder")


def resolve(listing: DataFrame, base: str) -> DataFrame:
    """Files of the current snapshot under ``base`` as a listing.

    A ``base`` that ends in ``.csv`` is that file. Otherwise the base's own CSV files win, then
    the CSV files directly in the latest subfolder; none at all is a ``ValueError``. One bounded
    action chooses the folder (one row); one filtered pass gives the files, unsorted.
    """
    if base.lower().endswith(".csv"):
        files = listing.filter(path_only("path") == _base_path(base)).select("path", "length", "modificationTime")
        if files.isEmpty():
            raise _no_files(base)
        return files
    rel = with_relative(listing, base)
    chosen = _snapshot_folder(rel).first()
    if chosen is None or chosen["depth"] is None:
        raise _no_files(base)
    files = rel.filter((F.col("depth") == chosen["depth"]) & has_csv_suffix("rel"))
    if chosen["depth"]:
        files = files.filter(F.col("folder") == chosen["folder"])
    return files.select("path", "length", "modificationTime")


def snapshot_glob(spark: SparkSession, source: str, ledger: str | None = None) -> str:
    """The path to hand the CSV reader for ``source``: the file itself, or a glob of the snapshot.

    ``base/*.[cC][sS][vV]`` when the base holds CSV files, else ``base/<latest>/*.[cC][sS][vV]``.
    The base's own level is listed first; only if it has no CSV file are the subfolders looked at,
    and with a ``ledger`` (see :func:`folder_ledger`) only those that changed since it was written.
    Spark expands the glob (skipping hidden files) when it plans the scan; like every file scan,
    that keeps the file statuses on the driver.
    """
    if source.lower().endswith(".csv"):
        return source
    base = source.rstrip("/")
    if any(has_suffix(name) for name in file_names(spark, base)):
        return f"{_glob_escape(base)}/{CSV_GLOB}"
    if ledger is None:
        folders = _folder_facts(with_relative(list_tree(spark, base), base))
    else:
        folders = folder_ledger(spark, base, ledger)
    chosen = folders.agg(F.max(F.struct("newest", "folder", "files")).alias("latest")).first()["latest"]
    if chosen is None or not chosen["files"]:
        raise _no_files(source)
    return f"{_glob_escape(base)}/{_glob_escape(chosen['folder'])}/{CSV_GLOB}"


def has_suffix(name: str) -> bool:
    return name.lower().endswith(".csv") and not name.startswith(("_", "."))


def _folder_facts(rel: DataFrame) -> DataFrame:
    """``folder, newest, files`` (CSV files directly in it) of every first-level folder."""
    here = has_csv_suffix("rel") & (F.col("depth") == 1)
    return (
        rel.filter(F.col("folder").isNotNull())
        .groupBy("folder")
        .agg(F.max("modificationTime").alias("newest"), F.count_if(here).alias("files"))
    )


def folder_ledger(spark: SparkSession, base: str, ledger: str) -> DataFrame:
    """``folder, newest, files, changed`` of the first-level folders, listing only what changed.

    ``ledger`` is a small Parquet folder that keeps these rows between refreshes. One level is
    listed; a folder is listed again when it is not in the ledger or its own modification time
    (``changed``) is another one. A store without folder times (they are 0) is listed whole. A
    file system that doesn't change a folder's time when something deeper inside it changes needs
    the tree without a ledger.
    """
    schema = "folder string, newest timestamp, files long, changed long"
    now = [(p.rstrip("/").rsplit("/", 1)[-1], int(t * 1000)) for p, t in folder_times(spark, base)]
    now = [(name, t) for name, t in now if not name.startswith(("_", "."))]
    level = spark.createDataFrame(now, "folder string, changed long")
    number_of = lambda x: int(x.rstrip("/").rsplit("/listing-", 1)[-1].split("-")[0])
    known = [x for x in subfolders(spark, ledger) if "/listing-" in x and "_SUCCESS" in file_names(spark, x)]
    newest = max(known, key=number_of, default=None)
    before = spark.read.schema(schema).parquet(newest) if newest else spark.createDataFrame([], schema)
    same = before.join(level.filter("changed > 0"), ["folder", "changed"], "left_semi").select("folder", "newest", "files", "changed")
    fresh = level.join(same.select("folder"), "folder", "left_anti").select("folder", "changed")
    names = [r["folder"] for r in fresh.collect()]  # one row per changed folder
    listed = spark.createDataFrame([], "folder string, newest timestamp, files long")
    if names:
        tree = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        tree = tree.load([f"{_glob_escape(base)}/{_glob_escape(n)}" for n in names]).select("path", "length", "modificationTime")
        listed = _folder_facts(with_relative(tree, base))
    rows = same.unionByName(fresh.join(listed, "folder", "left").select("folder", "newest", F.coalesce("files", F.lit(0)).alias("files"), "changed"))
    if names or len(now) != same.count():
        path = f"{ledger.rstrip('/')}/listing-{number_of(newest) + 1 if newest else 0}-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(path)
        for old in known:
            if old != newest:  # the one before stays for a refresh that is reading it
                remove_folder(spark, old)
        return spark.read.schema(schema).parquet(path)
    return rows


# --- Fixed value: the date that the publisher puts at the end of a file's name. ---
GENERATION = r"^(.*?)(?:[_-]?(\d{8}|\d{6}))?\.[^.]*$"


def generations(files: DataFrame) -> DataFrame:
    """``files`` with ``stem`` (folder and name without the date suffix) and ``generation`` (``yyyyMMdd``, null
    for a name without a date). A six-digit date is ``yyMMdd``."""
    name = F.substring_index("path", "/", -1)
    folder = F.expr("substring(path, 1, length(path) - length(substring_index(path, '/', -1)))")
    date = F.nullif(F.regexp_extract(name, GENERATION, 2), F.lit(""))
    return files.withColumn("stem", F.concat(folder, F.lower(F.regexp_extract(name, GENERATION, 1)))).withColumn(
        "generation", F.when(F.length(date) == 6, F.concat(F.lit("20"), date)).otherwise(date)
    )


def newest_generation(files: DataFrame) -> DataFrame:
    """The newest file of every stem: a folder that still holds the files of older publications
    loads every record once.

    The date in the name decides, a name without one is oldest; then the modification time, then
    the greatest path. One aggregation by stem with map-side reduction.
    """
    order = F.struct(F.coalesce("generation", F.lit("")).alias("g"), "modificationTime", "path", "length")
    newest = generations(files).groupBy("stem").agg(F.max(order).alias("f"))
    return newest.select("f.path", "f.length", "f.modificationTime")


def newest_files(spark: SparkSession, source: str) -> list[str]:
    """Paths of the newest file of every stem in the snapshot of ``source``, for the CSV reader."""
    found = newest_generation(list_files(spark, snapshot_glob(spark, source)))
    return [_glob_escape(r["path"]) for r in found.select("path").collect()]


def list_files(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """The files of a glob (or several) as a listing; contents are not read."""
    return spark.read.format("binaryFile").load(glob).select("path", "length", "modificationTime")


def manifest_files(spark: SparkSession, folder: str, entries: DataFrame) -> list[str]:
    """Paths of the files directly in ``folder`` that the manifest ``entries`` name.

    A name that several entries have, or a named file that is not there, raises
    :class:`MissingFiles` with the names as a DataFrame. The paths are what the scan's own file
    index holds on the driver; the names are compared as a join.
    """
    names = entries.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    base = folder.rstrip("/")
    here = with_relative(list_tree(spark, base), base).filter(F.col("depth") == 0).select("path", "rel")
    found = names.join(here, names["name"] == here["rel"], "left")
    wrong = found.filter(F.col("path").isNull() | (F.col("n") > 1)).select("name", "n", "path")
    if not wrong.isEmpty():
        raise MissingFiles(f"Manifest names files that are not in {folder}, or one file twice", wrong)
    paths = [r["path"] for r in found.select("path").collect()]
    if not paths:
        raise ValueError("The manifest names no files")
    return [_glob_escape(p) for p in paths]


class MissingFiles(ValueError):
    """Manifest names without a file, or named twice; ``names`` is the DataFrame of them."""

    def __init__(self, message: str, names: DataFrame):
        super().__init__(message)
        self.names = names
