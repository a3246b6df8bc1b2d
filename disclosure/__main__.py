"""Command line for the refresh job (``spark-submit``-able).

::

    spark-submit --py-files disclosure.zip -m disclosure \\
        --source s3a://bucket/loans/ --table loans_report --table loans_store:clear_and_append \\
        --rejects loans_rejects

With ``--catalog docs.json`` only the files that the catalog lists are read from the source
folder, all of which must be there. ``--table NAME[:MODE]`` may repeat (modes: overwrite, append, clear_and_append); with no table
the report is computed and counted only. The session is the one ``spark-submit`` configures,
plus :data:`disclosure.session.SESSION_CONF` for keys it leaves unset.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from disclosure.operators.search_index import build_index
from disclosure.plans.job import ConnectorSink, TableSink, run
from disclosure.session import SESSION_CONF
from disclosure.sources import manifest as M


def _sink(spec: str, fmt: str, options: dict) -> TableSink:
    name, _, mode = spec.partition(":")
    return TableSink(name, mode=mode or "overwrite", fmt=fmt, options=options or None)


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="disclosure", description=__doc__.split("\n\n")[0])
    p.add_argument("--source", help="a .csv file, or a folder (snapshot chosen by listing)")
    p.add_argument("--catalog", help="catalog JSON file(s): read only the files they list from the source folder")
    p.add_argument("--file-limit", type=int, help="read only the first N entries per catalog document")
    p.add_argument("--table", action="append", default=[], help="NAME[:MODE] target table, repeatable")
    p.add_argument("--rejects", help="table for malformed source lines")
    p.add_argument("--reject-cells", help="table for the failed cells of those lines: file, place, column, text")
    p.add_argument("--newest-only", action="store_true", help="of files that differ by their date suffix, read the newest")
    p.add_argument("--ledger", help="folder that keeps the listing of subfolders between refreshes")
    p.add_argument("--journal", help="folder that lets a repeated run go on where it stopped")
    p.add_argument("--index", action="store_true", help="build the trigram index of every refreshed report table")
    p.add_argument("--format", default="parquet", help="table format (parquet, delta, a connector)")
    p.add_argument("--option", action="append", default=[], help="KEY=VALUE writer option, repeatable")
    p.add_argument("--connector", help="also append to an external store through this connector format")
    p.add_argument("--connector-option", action="append", default=[], help="KEY=VALUE connector option")
    p.add_argument("--connector-partitions", type=int, help="round-robin into N writer tasks first")
    p.add_argument("--row-limit", type=int, help="sample run: keep the first N rows (unordered)")
    p.add_argument("--escape", default='"', help="CSV escape character (default: doubled quotes)")
    p.add_argument("--explain", action="store_true", help="print the report's physical plan; write nothing")
    args = p.parse_args(argv)

    options = dict(o.split("=", 1) for o in args.option)
    sinks = [_sink(t, args.format, options) for t in args.table]
    rejects = _sink(args.rejects, args.format, options) if args.rejects else None
    cells = _sink(args.reject_cells, args.format, options) if args.reject_cells else None
    if args.connector:
        connector_options = dict(o.split("=", 1) for o in args.connector_option)
        sinks.append(ConnectorSink(args.connector, connector_options, partitions=args.connector_partitions))

    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("disclosure").getOrCreate()
        submitted = spark.sparkContext.getConf()
        for key, value in SESSION_CONF.items():  # runtime SQL settings the submitter left unset
            if key.startswith("spark.sql.") and not submitted.contains(key):
                spark.conf.set(key, value)
    source, listed = args.source, None
    if not source:
        p.error("give --source")
    if args.catalog:
        documents = spark.read.text(args.catalog, wholetext=True)
        documents = documents.select(F.input_file_name().alias("dataset"), F.col("value").alias("doc"))
        listed = M.manifest(documents, limit=args.file_limit)
    chosen = {"manifest": listed, "newest_only": args.newest_only, "ledger": args.ledger, "escape": args.escape}
    if args.explain:
        run(spark, source, row_limit=args.row_limit, **chosen).explain(mode="formatted")
        return 0
    report = run(
        spark, source, sinks=sinks, row_limit=args.row_limit, rejects=rejects, reject_cells=cells, journal=args.journal, **chosen
    )
    if args.index:
        for sink in sinks:
            if isinstance(sink, TableSink) and sink.mode != "append":
                build_index(spark, sink.table)
    if not sinks:
        print(f"{report.count()} report rows (nothing written)")
    return 0


if __name__ == "__main__":
    sys.exit(main())
