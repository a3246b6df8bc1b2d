"""The refresh job: choose the snapshot, read it, build the report, refresh the sinks.

::

    report = run(spark, "s3a://bucket/loans/", sinks=[TableSink("loans_report"), TableSink("loans_store", mode="clear_and_append")])

Plan shape: ``FileScan csv -> Project (report) -> write`` per sink; no shuffle unless a sink
asks for ``partitions``. With two or more sinks the report is computed once (see
:func:`disclosure.sinks.tables.fan_out`). Targets are validated *before* any data is read.
With no sinks nothing runs and the lazy report is returned for inspection.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.operators.report import loan_report
from disclosure.sinks import tables
from disclosure.sources.csv import limit_rows, read_loans, read_loans_with_rejects
from disclosure.sources.listing import list_files, manifest_files, newest_files, snapshot_glob


@dataclass(frozen=True)
class TableSink:
    """A table target: ``mode`` is ``overwrite``, ``append`` or ``clear_and_append``.

    ``fmt`` and ``options`` select and configure the writer (``parquet`` by default; a
    connector's format with its settings for an external store); ``partitions`` asks for a
    round-robin repartition before an append (off by default: it is a full shuffle);
    ``sort_within`` sorts each write task's rows (e.g. by ``LoanNumber`` for detail lookups).
    """

    table: str
    mode: str = "overwrite"
    fmt: str = "parquet"
    path: str | None = None
    partitions: int | None = None
    options: dict | None = None
    sort_within: tuple[str, ...] = ()
    batch: str | None = None  # of an append: see tables.append_table

    def validate(self) -> None:
        tables.validate_table_name(self.table)
        if self.mode not in ("overwrite", "append", "clear_and_append"):
            raise ValueError(f"Unknown sink mode: {self.mode!r}")

    @property
    def replaces_content(self) -> bool:
        """True when, after the write, the table holds exactly the written rows and columns.

        Only ``overwrite``: ``clear_and_append`` keeps an existing table's own columns.
        """
        return self.mode == "overwrite"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def __call__(self, df: DataFrame) -> None:
        common = {"fmt": self.fmt, "path": self.path, "options": self.options}
        if self.mode == "overwrite":
            tables.overwrite_table(df, self.table, sort_within=self.sort_within, **common)
        elif self.mode == "append":
            tables.append_table(df, self.table, partitions=self.partitions, sort_within=self.sort_within, batch=self.batch, **common)
        else:
            tables.clear_and_append(df, self.table, partitions=self.partitions, **common)


@dataclass(frozen=True)
class ConnectorSink:
    """An external store written through its connector's format (``.save()``, no catalog table)."""

    fmt: str
    options: dict
    mode: str = "append"
    partitions: int | None = None

    @property
    def table(self) -> str:
        """A name for duplicate-target checks: the connector's table option, else the format."""
        return str(self.options.get("table") or self.options.get("dbtable") or self.options.get("path") or self.fmt)

    def validate(self) -> None:
        if not self.fmt:
            raise ValueError("A connector sink needs a format")
        if self.mode not in ("append", "overwrite"):
            raise ValueError(f"Unknown connector write mode: {self.mode!r}")

    def __call__(self, df: DataFrame) -> None:
        tables.connector_write(df, self.fmt, self.options, mode=self.mode, partitions=self.partitions)


def _run_name(spark: SparkSession, files: Sequence[str], row_limit: int | None) -> str:
    """A name for what a run reads: a digest over one row per file, summed on the cluster."""
    found = list_files(spark, list(files))
    facts = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("files"),
    ).first()
    return hashlib.sha256(f"{facts['n']} {facts['bytes']} {facts['files']} {row_limit}".encode()).hexdigest()[:24]


def run(
    spark: SparkSession,
    source: str | Sequence[str],
    sinks: Sequence[TableSink | ConnectorSink] = (),
    row_limit: int | None = None,
    strategy: str = "auto",
    rejects: TableSink | None = None,
    reject_cells: TableSink | None = None,
    manifest: DataFrame | None = None,
    newest_only: bool = False,
    ledger: str | None = None,
    journal: str | None = None,
    **reader_options,
) -> DataFrame:
    """Read ``source`` (a ``.csv`` file, a folder snapshot, or explicit files), publish, return.

    With ``manifest`` (catalog entries, e.g. from :func:`disclosure.sources.manifest.manifest`),
    only the files it names are read from the ``source`` folder, so files of an older
    generation left in the folder are not loaded a second time. A named file that is not there
    is an error.

    With ``newest_only``, of files whose names differ only by their date suffix the newest is read
    (see :func:`disclosure.sources.listing.newest_generation`): the same without a manifest. With
    ``ledger``, a folder that keeps the listing of a source's subfolders between refreshes, only
    subfolders that changed are listed again.

    With ``rejects``, malformed source lines (with their raw text) are also written to that
    table; the report has every line, with the bad cells null. The parse then runs once, staged
    (see :func:`disclosure.sources.csv.read_loans_with_rejects`), and the staged copy is removed
    when all sinks have run. ``reject_cells`` gets a row for every failed cell of those lines, with its
    file, place, column and text.

    With ``journal``, a folder, a run that is repeated after a failure goes on where it stopped: its
    rows are staged in a subfolder named after the files it reads (their paths, sizes and times),
    finished sinks are skipped, and an append to a file-format table carries that name as its batch,
    so that it is there once.

    Returns the report: the first sink's table when it is a full refresh, else computed from
    the source when it is read.
    """
    targets = [*sinks, *[t for t in (rejects, reject_cells) if t]]
    for sink in targets:
        sink.validate()
    target_names = [t.table.lower() for t in targets]
    if len(set(target_names)) != len(target_names):
        raise ValueError(f"A table is named by more than one sink: {target_names}")
    if manifest is not None:
        if not isinstance(source, str):
            raise ValueError("A manifest selects files in one source folder")
        files = manifest_files(spark, source, manifest)
    elif isinstance(source, str):
        files = newest_files(spark, source) if newest_only else [snapshot_glob(spark, source, ledger)]
    else:
        files = list(source)
    report = loan_report(read_loans(spark, files, row_limit=row_limit, **reader_options))
    if journal and sinks:
        name = _run_name(spark, files, row_limit)
        journal = f"{journal.rstrip('/')}/{name}"
        sinks = [
            replace(s, batch=s.batch or name) if getattr(s, "mode", "") == "append" and getattr(s, "fmt", "") in tables.FILE_FORMATS and isinstance(s, TableSink) else s
            for s in sinks
        ]
    if rejects is None and reject_cells is None:
        if sinks:
            return tables.fan_out(report, list(sinks), strategy=strategy, journal=journal)
        return report
    parsed = read_loans_with_rejects(spark, files, **reader_options)
    try:
        if rejects:
            rejects(parsed.rejects)
        if reject_cells:
            reject_cells(parsed.cells())
        loans = parsed.loans if row_limit is None else limit_rows(parsed.loans, row_limit)
        tables.fan_out(loan_report(loans), list(sinks), strategy=strategy, journal=journal if sinks else None)
    finally:
        parsed.close()
    published = [s for s in sinks if getattr(s, "replaces_content", False)]
    return published[0].read(spark) if published else report
