"""Catalog manifests and fetch planning, as DataFrame work.

The data catalog answers a dataset lookup with a JSON document::

    {"success": true, "result": {"resources": [{"id", "name", "url", "size", "format"}, ...]}}

Here each document is a row (``dataset``, ``doc``), so any number of datasets or catalog
pages are parsed in parallel. Per document, the resource list is parsed and filtered once
inside the row, then exploded; checks and the cap are row filters: no shuffle and no window. Fetch planning is a left-anti equi-join against a file inventory; the outcome roll-up
is an aggregate with map-side partial aggregation.

Rules kept from the reference job:

* a document whose ``success`` is not true, or without a resource list, fails the job; so does
  a kept entry without a ``url``, or without both a name and an ``id``;
* entries are kept when their upper-cased format (null -> ``''``) is in the wanted set; an
  empty or ``None`` set keeps every entry;
* ``name`` is the entry name, or its ``id`` when the name is null or empty; ``format`` is
  reported upper-cased (``''`` for null);
* an entry is skipped by the fetch plan iff not ``overwrite``, its expected size is neither
  null nor 0, and a file of that name with exactly that byte length is in the target folder;
* totals count entries and sum sizes with null as 0.

Entry names are reduced to their last path segment (``a/../b.csv`` -> ``b.csv``) so a hostile
name cannot point outside the download folder; :func:`duplicate_names` reports collisions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from disclosure.functions.display import base_name, human_bytes
from disclosure.sources.listing import with_relative
from disclosure.sources.names import joined_names

RESOURCE_SCHEMA = StructType(
    [
        StructField("id", StringType(), True),
        StructField("name", StringType(), True),
        StructField("url", StringType(), True),
        StructField("size", LongType(), True),
        StructField("format", StringType(), True),
    ]
)
CATALOG_SCHEMA = StructType(
    [
        StructField("success", BooleanType(), True),
        StructField(
            "result",
            StructType([StructField("resources", ArrayType(RESOURCE_SCHEMA, True), True)]),
            True,
        ),
    ]
)

DEFAULT_FORMATS = ("CSV",)


def _format_filter(formats: Iterable[str] | None):
    wanted = sorted({f.upper() for f in formats}) if formats else None
    if wanted is None:
        return None
    return lambda r: F.upper(F.coalesce(r["format"], F.lit(""))).isin(*wanted)


def parse_catalog(documents: DataFrame, doc_column: str = "doc") -> DataFrame:
    """Parses the JSON column once into ``_resources``.

    A document whose ``success`` is not true, or that has no resource list, fails the job.
    """
    parsed = documents.withColumn("_parsed", F.from_json(F.col(doc_column), CATALOG_SCHEMA))
    success, resources = F.col("_parsed.success"), F.col("_parsed.result.resources")
    checked = (
        F.when(
            success.isNull() | ~success,
            F.raise_error(F.lit("Catalog lookup failed: success is not true")),
        )
        .when(resources.isNull(), F.raise_error(F.lit("Catalog document has no resource list")))
        .otherwise(resources)
    )
    return parsed.withColumn("_resources", checked).drop("_parsed")


def _entry_name(r: Column) -> Column:
    return F.coalesce(F.nullif(r["name"], F.lit("")), r["id"])


def manifest(
    documents: DataFrame,
    formats: Iterable[str] | None = DEFAULT_FORMATS,
    limit: int | None = None,
    doc_column: str = "doc",
    keys: Iterable[str] = ("dataset",),
) -> DataFrame:
    """Manifest entries ``(*keys, pos, name, url, size, format)`` from catalog documents.

    ``pos`` is the 1-based position among the kept entries of the document; ``limit`` keeps the
    first ``limit`` of them (the file cap), per document. A kept entry without a url, or without
    both a name and an id, fails the job.
    """
    resources = F.col("_resources")
    keep = _format_filter(formats)
    if keep is not None:
        resources = F.filter(resources, keep)
    key_cols = list(keys)
    exploded = parse_catalog(documents, doc_column).select(
        *key_cols, F.posexplode(resources).alias("_pos", "_r")
    )
    r = F.col("_r")
    incomplete = r["url"].isNull() | _entry_name(r).isNull()
    checked = F.when(incomplete, F.raise_error(F.lit("Catalog entry without url or name/id")).cast("boolean"))
    entries = exploded.filter(checked.otherwise(F.lit(True)))  # a filter, so that no pruning skips it
    if limit is not None:
        entries = entries.filter(F.col("_pos") < max(limit, 0))
    return entries.select(
        *key_cols,
        (F.col("_pos") + 1).alias("pos"),
        base_name(_entry_name(r)).alias("name"),
        r["url"].alias("url"),
        r["size"].alias("size"),
        F.upper(F.coalesce(r["format"], F.lit(""))).alias("format"),
    )


def require_entries(entries: DataFrame) -> DataFrame:
    """Raises ``ValueError`` when the manifest is empty (one bounded action), else returns it."""
    if entries.isEmpty():
        raise ValueError("No matching resources to download (check the wanted formats)")
    return entries


def fetch_plan(entries: DataFrame, inventory: DataFrame, folder: str, overwrite: bool = False) -> DataFrame:
    """Entries that still have to be fetched into ``folder``, given the files already there.

    ``inventory`` is a listing ``(path, length, ...)``. An entry is skipped iff the file of its
    name directly in ``folder`` (not in a subfolder) has exactly its expected size and that size
    is neither null nor 0 (and not ``overwrite``). A left-anti equi-join on ``(name, size)``:
    Spark broadcasts the inventory when its statistics are small and otherwise shuffles both
    sides by the key.
    """
    if overwrite:
        return entries
    here = with_relative(inventory, folder).filter(F.col("depth") == 0)
    present = here.select(F.col("rel").alias("_file"), F.col("length").alias("_length"))
    cond = (
        (entries["name"] == present["_file"])
        & (entries["size"] == present["_length"])
        & (entries["size"] != 0)
    )
    return entries.join(present, cond, "left_anti")


def totals(entries: DataFrame) -> DataFrame:
    """One row: ``n_files``, ``total_bytes`` (null sizes as 0) and ``total_display``."""
    agg = entries.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum(F.coalesce(F.col("size"), F.lit(0))), F.lit(0)).cast("bigint").alias("total_bytes"),
    )
    return agg.withColumn("total_display", human_bytes("total_bytes"))


def failure_summary(outcomes: DataFrame, error_column: str = "error") -> DataFrame:
    """One row: ``n_failed`` (outcomes with an error) and ``n_total``."""
    return outcomes.agg(
        F.count_if(F.col(error_column).isNotNull()).alias("n_failed"),
        F.count(F.lit(1)).alias("n_total"),
    )


def failed_entries(outcomes: DataFrame, error_column: str = "error") -> DataFrame:
    """The failed outcomes ``(name, error)`` (a filter; no shuffle).

    Not sorted: a range-partitioned sort cannot split a name repeated across many outcomes.
    """
    return outcomes.filter(F.col(error_column).isNotNull()).select("name", error_column)


class FetchFailed(RuntimeError):
    """Raised by :func:`raise_on_failures`; ``failures`` is the lazy DataFrame of failed entries."""

    def __init__(self, message: str, failures: DataFrame):
        super().__init__(message)
        self.failures = failures


def raise_on_failures(outcomes: DataFrame, error_column: str = "error", total: int | None = None) -> None:
    """Run all, then fail once: ``Failed to download n of total file(s): name, name, ...``.

    Counting is distributed, and so is putting the names together (sorted; see
    :func:`disclosure.sources.names.joined_names`); the message has all of them, whatever their number.
    ``total`` overrides the outcome count (when skipped entries have no outcome row). The failed
    entries with their errors are the DataFrame ``failures`` of the raised exception.
    """
    summary = failure_summary(outcomes, error_column).first()
    if not summary or summary["n_failed"] == 0:
        return
    n_total = summary["n_total"] if total is None else total
    failures = failed_entries(outcomes, error_column)
    message = f"Failed to download {summary['n_failed']} of {n_total} file(s): {joined_names(failures, 'name')}"
    raise FetchFailed(message, failures)


def duplicate_names(entries: DataFrame) -> DataFrame:
    """Entry names that occur more than once ``(name, n)`` (aggregate, skew-safe)."""
    return entries.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def catalog_documents(
    resources: DataFrame,
    group_cols: list[str],
    order_col: str,
    success: Column | None = None,
) -> DataFrame:
    """Builds catalog JSON documents from resource rows, one per group, entries by ``order_col``.

    Used to derive catalog responses from tables; group sizes must be bounded by the caller.
    """
    entry = F.struct(
        F.col(order_col).alias("_o"),
        F.struct(*[F.col(c) for c in ("id", "name", "url", "size", "format")]).alias("_e"),
    )
    grouped = resources.groupBy(*group_cols).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    ok = success if success is not None else F.lit(True)
    doc = F.to_json(
        F.struct(
            ok.alias("success"),
            F.struct(F.transform("_entries", lambda x: x["_e"]).alias("resources")).alias("result"),
        )
    )
    return grouped.select(*group_cols, doc.alias("doc"))
