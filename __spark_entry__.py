"""

Every query reads the driver's tables under ``sf_dir`` (or files Spark writes from them) in
full, so its work grows with them. Loans come from the star schema (``orders`` x ``customer``
x ``nation`` x ``region`` x ``supplier``); listings, catalog documents and fetch outcomes are
derived from ``events``, ``documents`` and ``labels``. Each ``oracle_sql`` entry computes the
same result in DuckDB straight from the Parquet views.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_sql as O  # noqa: E402
from disclosure.functions import display as D  # noqa: E402
from disclosure.operators.report import loan_report  # noqa: E402
from disclosure.operators.search import detail, search, search_cards  # noqa: E402
from disclosure.operators.search_index import build_index, search_table  # noqa: E402
from disclosure.plans.job import ConnectorSink, TableSink, run  # noqa: E402
from disclosure.schema import DATE_COLUMNS, LOAN_FIELDS, PROCEEDS, SOURCE_DATE_FORMAT  # noqa: E402
from disclosure.session import file_names, move_file, scratch_path  # noqa: E402
from disclosure.sinks import tables  # noqa: E402
from disclosure.sources import derived, listing  # noqa: E402
from disclosure.sources import manifest as M  # noqa: E402
from disclosure.sources.csv import limit_rows, read_loans, read_loans_with_rejects, write_loans_csv  # noqa: E402
from disclosure.sources.names import joined_names  # noqa: E402
from disclosure.sources.star import loans_from_star, read_table  # noqa: E402
from disclosure.streaming import publish_available  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
SEARCH_Q = O.SEARCH_Q
CARDS_Q = "  NATION_2   Asia "
WILDCARD_Q = "supplier#00000000? svc*household"
DETAIL_ID = "10000"
ROW_LIMIT = 1000
TOP_N = 3
FILE_LOANS = 250_000  # loans of a published file, some 70 MB; both publications have the same files


# ---------------------------------------------------------------- helpers


def _spread(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table, round-robined over the cores when its scan has fewer splits than that.

    The driver's small tables are one Parquet row group each, so one task would do all the work.
    Tables with many splits are read as they are; the package itself never does this.
    """
    df = read_table(spark, sf, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _loans(spark: SparkSession, sf: str) -> DataFrame:
    return loans_from_star(spark, sf, read=_spread)


def _events(spark: SparkSession, sf: str, with_direct: bool) -> DataFrame:
    return derived.event_inventory(spark, sf, with_direct=with_direct, read=_spread)


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    return derived.catalog_from_documents(spark, sf, read=_spread)


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return loan_report(_loans(spark, sf))


def _loan_cols(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """``LoanNumber`` plus report columns (the report prunes to what they need)."""
    return _report(spark, sf).select("LoanNumber", *cols)


def _write_loans(spark: SparkSession, sf: str, label: str, where=None) -> str:
    path = scratch_path(spark, label)
    loans = _loans(spark, sf)
    write_loans_csv(loans.filter(where) if where is not None else loans, path)
    return path


def _csv_files(spark: SparkSession, folder: str) -> list[str]:
    """The folder's CSV files as one glob Spark expands (no file list through the driver)."""
    return [listing.snapshot_glob(spark, folder)]


def _table(label: str) -> str:
    return f"disclosure_{label}_{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- report, search


def q_loan_report(spark, sf):
    return _report(spark, sf)


def q_search(spark, sf):
    return search(_report(spark, sf), SEARCH_Q)


def q_search_empty(spark, sf):
    return search_cards(_report(spark, sf), "   ")


def q_search_cards(spark, sf):
    return search_cards(_report(spark, sf), CARDS_Q)


def q_search_wildcard(spark, sf):
    return search(_report(spark, sf), WILDCARD_Q).select("LoanNumber", "searchtext")


def q_search_indexed(spark, sf):
    """The search box over the published report, through its trigram index."""
    t = _table("indexed")
    tables.overwrite_table(_report(spark, sf), t, path=_sink_path(spark, t))
    build_index(spark, t)
    return search_table(spark, t, SEARCH_Q)


def q_loan_detail(spark, sf):
    return detail(_report(spark, sf), DETAIL_ID)


def q_row_count(spark, sf):
    return _report(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


def q_row_limit(spark, sf):
    """Any ``ROW_LIMIT`` rows: how many came, and how many of them are whole rows of the report."""
    sample = loan_report(limit_rows(_loans(spark, sf), ROW_LIMIT))
    whole = _report(spark, sf).withColumn("in_report", F.lit(1))
    same = F.lit(True)
    for c in sample.columns:
        same &= F.col(f"s.{c}").eqNullSafe(F.col(f"w.{c}"))
    return (
        sample.alias("s")
        .join(whole.alias("w"), same, "left")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("in_report").alias("n_in_report"))
    )


# ---------------------------------------------------------------- scalar functions


def _orders(spark, sf):
    return read_table(spark, sf, "orders")


def q_currency(spark, sf):
    o = _orders(spark, sf)
    amount = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    return o.select("o_orderkey", amount.alias("amount")).select("o_orderkey", "amount", D.currency("amount").alias("display"))


def q_currency_negative(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", F.col("c_acctbal").alias("amount"), D.currency("c_acctbal").alias("display"))


def q_currency_half(spark, sf):
    c = read_table(spark, sf, "customer")
    amount = (F.col("c_custkey") - F.lit(700)).cast("double") / F.lit(2.0)
    return c.select("c_custkey", amount.alias("amount"), D.currency(amount).alias("display"))


def q_currency_nullable(spark, sf):
    o = _orders(spark, sf)
    amount = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice"))
    return o.select("o_orderkey", amount.alias("amount"), D.currency_or_null(amount).alias("display"))


def q_proceeds_displays(spark, sf):
    return _loan_cols(spark, sf, *[display for _, display in PROCEEDS])


def _order_day(spark, sf):
    day = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("date"))
    return _orders(spark, sf).select("o_orderkey", day.alias("d"))


def q_ap_month(spark, sf):
    return _order_day(spark, sf).select("o_orderkey", "d", D.ap_month("d").alias("month_display"))


def q_ap_date(spark, sf):
    return _order_day(spark, sf).select("o_orderkey", "d", D.ap_date("d").alias("date_display"))


def q_date_with_round(spark, sf):
    return _loan_cols(spark, sf, "DateApproved", "ProcessingMethod", "DateApproved_Display")


def _location_raw() -> F.Column:
    k = F.col("c_custkey")
    return (
        F.when(k % 8 == 0, F.lit(" n/a "))
        .when(k % 8 == 1, F.lit("Na"))
        .when(k % 8 == 2, F.lit(""))
        .when(k % 8 == 3, F.lit(None).cast("string"))
        .when(k % 8 == 4, F.lit("   "))
        .when(k % 8 == 5, F.lit("N/A"))
        .when(k % 8 == 6, F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
        .otherwise(F.col("c_mktsegment"))
    )


def q_clean_location(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", _location_raw().alias("raw"))
    return c.select("c_custkey", "raw", D.clean_location("raw").alias("cleaned"))


def q_location(spark, sf):
    return _loan_cols(spark, sf, "Location_Display")


def q_zip5(spark, sf):
    loans = _loans(spark, sf)
    return loans.select("LoanNumber", D.zip5("ProjectZip", "BorrowerZip").alias("zip5"))


def q_searchtext(spark, sf):
    return _loan_cols(spark, sf, "searchtext")


def q_status_cascade(spark, sf):
    return _loan_cols(spark, sf, "LoanStatus_Display")


def q_recipient(spark, sf):
    return _loan_cols(spark, sf, "Recipient_Display")


def q_area_type(spark, sf):
    return _loan_cols(spark, sf, "AreaType_Display")


def q_lender(spark, sf):
    return _loan_cols(spark, sf, "Lender_Display")


def q_business_type(spark, sf):
    return _loan_cols(spark, sf, "BusinessType_Display")


def q_business_age(spark, sf):
    return _loan_cols(spark, sf, "BusinessAge_Display")


def q_industry(spark, sf):
    return _loan_cols(spark, sf, "NAICSCode", "Industry_Display")


def q_int_to_text(spark, sf):
    return _loan_cols(spark, sf, "JobsReported", "JobsReported_Display")


def q_human_bytes(spark, sf):
    d = read_table(spark, sf, "documents")
    k = F.col("doc_id")
    n = F.when(k % 7 != 0, F.expr("shiftleft(n_chars, cast(doc_id % 5 * 10 as int))") + k)
    return d.select("doc_id", n.alias("n_bytes")).select("doc_id", "n_bytes", D.human_bytes("n_bytes").alias("display"))


def q_valid_name(spark, sf):
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    name = (
        F.when(k % 5 == 0, F.col("p_name"))
        .when(k % 5 == 1, F.regexp_replace("p_type", " ", "_"))
        .when(k % 5 == 2, F.concat(F.lit("T_"), k.cast("string")))
        .when(k % 5 == 3, F.col("p_brand"))
        .otherwise(F.concat(k.cast("string"), F.lit("_t")))
    )
    return p.select("p_partkey", name.alias("name")).select("p_partkey", "name", D.valid_identifier("name").alias("valid"))


# ---------------------------------------------------------------- CSV sources and the job


def q_csv_scan(spark, sf):
    folder = _write_loans(spark, sf, "csv-scan")
    return read_loans(spark, _csv_files(spark, folder))


def q_csv_multi_scan(spark, sf):
    older = _write_loans(spark, sf, "csv-gen1", where=F.col("ProcessingMethod") == "PPP")
    newer = _write_loans(spark, sf, "csv-gen2")
    return read_loans(spark, _csv_files(spark, older) + _csv_files(spark, newer))


def _malformed_text(loans: DataFrame) -> DataFrame:
    """Loans as text cells; every 23rd approval date in ISO form, every 29th job count as ``n.0``."""
    k = F.col("LoanNumber").cast("bigint")
    cells = []
    for name, dtype in LOAN_FIELDS:
        c = F.col(name)
        if name in DATE_COLUMNS:
            text = F.date_format(c, SOURCE_DATE_FORMAT)
            if name == "DateApproved":
                text = F.when(k % 23 == 0, F.date_format(c, "yyyy-MM-dd")).otherwise(text)
        elif name == "JobsReported":
            text = F.when(k % 29 == 0, F.concat(c.cast("string"), F.lit(".0"))).otherwise(c.cast("string"))
        else:
            text = c.cast("string")
        cells.append(text.alias(name))
    return loans.select(*cells)


def q_csv_rejects(spark, sf):
    path = scratch_path(spark, "csv-rejects")
    write_loans_csv(_malformed_text(_loans(spark, sf)), path)
    parsed = read_loans_with_rejects(spark, _csv_files(spark, path))
    return parsed.rejects.select("LoanNumber", "DateApproved", "JobsReported")


def q_csv_reject_cells(spark, sf):
    """The failed cells of malformed lines, and whether each is located in a file."""
    path = scratch_path(spark, "csv-reject-cells")
    write_loans_csv(_malformed_text(_loans(spark, sf)), path)
    cells = read_loans_with_rejects(spark, _csv_files(spark, path)).cells()
    located = F.col("file").endswith(".csv") & (F.col("row_in_block") > 0) & (F.col("block_start") >= 0)
    return cells.select("LoanNumber", F.col("column").alias("column_name"), "cell", "problem", located.alias("located"))


def q_newest_generation(spark, sf):
    """A folder with two publications of the same files: every loan of the newer one, once."""
    base = scratch_path(spark, "generations")
    loans = _loans(spark, sf)
    files = max(4, -(-read_table(spark, sf, "orders").count() // FILE_LOANS))
    for date, rows in (("240101", loans.filter(F.col("ProcessingMethod") == "PPP")), ("240930", loans)):
        written = scratch_path(spark, "generation")
        write_loans_csv(rows, written, files=files)
        for number, name in enumerate(sorted(n for n in file_names(spark, written) if n.endswith(".csv"))):
            move_file(spark, f"{written}/{name}", f"{base}/public_{number}_{date}.csv")
    return read_loans(spark, listing.newest_files(spark, base))


def q_csv_permissive(spark, sf):
    """Malformed CSV through the plain reader: bad cells are null, every row stays."""
    path = scratch_path(spark, "csv-permissive")
    write_loans_csv(_malformed_text(_loans(spark, sf)), path)
    return read_loans(spark, _csv_files(spark, path))


def q_refresh_job(spark, sf):
    base = scratch_path(spark, "landing")
    loans = _loans(spark, sf)
    write_loans_csv(loans.filter(F.col("ProcessingMethod") == "PPP"), f"{base}/20240101")
    write_loans_csv(loans, f"{base}/20240102")
    return run(spark, base)


def q_refresh_job_rejects(spark, sf):
    """The job over malformed CSV: every line is in the report, the bad lines also in the rejects;
    both tables read back."""
    base = scratch_path(spark, "landing-rejects")
    write_loans_csv(_malformed_text(_loans(spark, sf)), f"{base}/20240102")
    t, r = _table("report"), _table("rejects")
    report = run(
        spark, base, sinks=[TableSink(t, path=_sink_path(spark, t))], rejects=TableSink(r, path=_sink_path(spark, r))
    )
    columns = ["LoanNumber", "DateApproved", "DateApproved_Display", "JobsReported_Display"]
    nothing = F.lit(None).cast("string")
    rejected = spark.table(r).select(
        "LoanNumber", "DateApproved", nothing.alias("DateApproved_Display"), nothing.alias("JobsReported_Display")
    )
    return (
        report.select(F.lit("report").alias("kind"), *columns)
        .unionByName(rejected.select(F.lit("reject").alias("kind"), *columns))
    )


def q_refresh_job_sinks(spark, sf):
    """CSV to the report to two sinks, end to end: a full refresh and a clear-and-append over old
    rows; both tables read back."""
    base = scratch_path(spark, "landing-sinks")
    loans = _loans(spark, sf)
    write_loans_csv(loans.filter(F.col("ProcessingMethod") == "PPP"), f"{base}/20240101")
    a, b = _table("job_a"), _table("job_b")
    sinks = [
        TableSink(a, path=_sink_path(spark, a)),
        TableSink(b, mode="clear_and_append", path=_sink_path(spark, b)),
    ]
    run(spark, base, sinks=sinks)
    write_loans_csv(loans, f"{base}/20240102")
    run(spark, base, sinks=sinks)
    return (
        spark.table(a).withColumn("sink", F.lit("overwrite"))
        .unionByName(spark.table(b).withColumn("sink", F.lit("clear_and_append")))
    )


def q_stream_publish(spark, sf):
    """Two landings drained by two runs of the same incremental query: every loan once."""
    landing = scratch_path(spark, "stream-landing")
    output = scratch_path(spark, "stream-report")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    loans = _loans(spark, sf)
    first = F.col("ProcessingMethod") == "PPP"
    write_loans_csv(loans.filter(first), landing)
    publish_available(spark, landing, output, checkpoint)
    write_loans_csv(loans.filter(~first | first.isNull()), landing, mode="append")
    return publish_available(spark, landing, output, checkpoint)


# ---------------------------------------------------------------- listings and snapshots


def q_list_files(spark, sf):
    return listing.direct_csv_files(_events(spark, sf, True), derived.LANDING)


def q_subfolder_times(spark, sf):
    return listing.subfolder_times(_events(spark, sf, True), derived.LANDING)


def q_latest_snapshot(spark, sf):
    return listing.latest_subfolder(_events(spark, sf, True), derived.LANDING)


def q_resolve_snapshot(spark, sf):
    return listing.resolve(_events(spark, sf, False), derived.LANDING)


def q_resolve_snapshot_direct(spark, sf):
    """The base's own CSV files win over newer subfolders."""
    return listing.resolve(_events(spark, sf, True), derived.LANDING)


def q_resolve_snapshot_file(spark, sf):
    """A source that is one CSV file (the first one of the base): that file of the listing."""
    files = _events(spark, sf, True)
    first = listing.direct_csv_files(files, derived.LANDING).agg(F.min("path")).first()[0]
    return listing.resolve(files, first)


# ---------------------------------------------------------------- manifests and fetch planning


def q_manifest(spark, sf):
    return M.manifest(_catalog(spark, sf))


def q_manifest_top_n(spark, sf):
    return M.manifest(_catalog(spark, sf), limit=TOP_N)


def q_manifest_total(spark, sf):
    return M.totals(M.manifest(_catalog(spark, sf)))


def q_fetch_plan(spark, sf):
    entries = M.manifest(_catalog(spark, sf))
    return M.fetch_plan(entries, derived.document_inventory(spark, sf, read=_spread), derived.DOWNLOADS)


def q_fetch_failures(spark, sf):
    return M.failure_summary(derived.label_outcomes(spark, sf))


def q_failed_files(spark, sf):
    return M.failed_entries(derived.label_outcomes(spark, sf))


def q_failed_names(spark, sf):
    """The names list of the one error, as its message has it."""
    names = joined_names(M.failed_entries(derived.label_outcomes(spark, sf)), "name")
    return spark.createDataFrame([(names,)], "names string")


# ---------------------------------------------------------------- sinks


def _sink_path(spark, table: str) -> str:
    return scratch_path(spark, f"tables/{table}")


def q_overwrite_table(spark, sf):
    t = _table("overwrite")
    path = _sink_path(spark, t)
    tables.overwrite_table(_loans(spark, sf).select("LoanNumber", "BorrowerName"), t, path=path)
    tables.overwrite_table(_report(spark, sf), t, path=path)
    return spark.table(t)


def q_append_table(spark, sf):
    t = _table("append")
    path = _sink_path(spark, t)
    report = _report(spark, sf)
    tables.append_table(report, t, path=path)
    tables.append_table(report, t, path=path, partitions=4)
    return spark.table(t)


def q_append_batches(spark, sf):
    """Two batches, the first one appended again: it adds nothing."""
    t = _table("batches")
    path = _sink_path(spark, t)
    report = _report(spark, sf)
    first = report.filter(F.col("LoanNumber").cast("bigint") % 2 == 0)
    tables.append_table(first, t, path=path, batch="even")
    tables.append_table(report.filter(F.col("LoanNumber").cast("bigint") % 2 == 1), t, path=path, batch="odd")
    tables.append_table(first, t, path=path, batch="even")
    return spark.table(t)


def q_connector_append(spark, sf):
    """Two appends through a connector format's writer (Parquet stands for the connector)."""
    path = scratch_path(spark, "connector")
    sink = ConnectorSink("parquet", {"path": path}, partitions=4)
    report = _report(spark, sf)
    sink(report)
    sink(report)
    return spark.read.parquet(path)


def q_clear_and_append(spark, sf):
    t = _table("refresh")
    path = _sink_path(spark, t)
    report = _report(spark, sf)
    tables.clear_and_append(report.filter(F.col("ProcessingMethod") == "PPP"), t, path=path)
    tables.clear_and_append(report, t, path=path)
    return spark.table(t)


def q_create_if_missing(spark, sf):
    t = _table("create")
    path = _sink_path(spark, t)
    report = _report(spark, sf)
    tables.create_if_missing(spark, t, report.schema, path=path)
    tables.create_if_missing(spark, t, report.schema, path=path)
    tables.append_table(report, t, path=path)
    return spark.table(t)


def q_replace_table(spark, sf):
    t = _table("replace")
    tables.overwrite_table(_loans(spark, sf).select("LoanNumber"), t, path=_sink_path(spark, t))
    tables.replace_table(_report(spark, sf), t, path=_sink_path(spark, t + "__next"))
    return spark.table(t)


def q_fan_out(spark, sf):
    a, b = _table("fan_a"), _table("fan_b")
    sinks = [
        TableSink(a, mode="overwrite", path=_sink_path(spark, a)),
        TableSink(b, mode="clear_and_append", path=_sink_path(spark, b)),
    ]
    tables.fan_out(_report(spark, sf), sinks)
    return spark.table(a).withColumn("sink", F.lit("a")).unionByName(spark.table(b).withColumn("sink", F.lit("b")))


# ---------------------------------------------------------------- contract


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "loan_report": q_loan_report,
    "search": q_search,
    "search_empty": q_search_empty,
    "search_cards": q_search_cards,
    "search_wildcard": q_search_wildcard,
    "search_indexed": q_search_indexed,
    "loan_detail": q_loan_detail,
    "row_count": q_row_count,
    "row_limit": q_row_limit,
    "currency": q_currency,
    "currency_negative": q_currency_negative,
    "currency_half": q_currency_half,
    "currency_nullable": q_currency_nullable,
    "proceeds_displays": q_proceeds_displays,
    "ap_month": q_ap_month,
    "ap_date": q_ap_date,
    "date_with_round": q_date_with_round,
    "clean_location": q_clean_location,
    "location": q_location,
    "zip5": q_zip5,
    "searchtext": q_searchtext,
    "status_cascade": q_status_cascade,
    "recipient": q_recipient,
    "area_type": q_area_type,
    "lender": q_lender,
    "business_type": q_business_type,
    "business_age": q_business_age,
    "industry": q_industry,
    "int_to_text": q_int_to_text,
    "human_bytes": q_human_bytes,
    "valid_name": q_valid_name,
    "csv_scan": q_csv_scan,
    "csv_multi_scan": q_csv_multi_scan,
    "csv_rejects": q_csv_rejects,
    "csv_reject_cells": q_csv_reject_cells,
    "csv_permissive": q_csv_permissive,
    "newest_generation": q_newest_generation,
    "refresh_job": q_refresh_job,
    "refresh_job_rejects": q_refresh_job_rejects,
    "refresh_job_sinks": q_refresh_job_sinks,
    "stream_publish": q_stream_publish,
    "list_files": q_list_files,
    "subfolder_times": q_subfolder_times,
    "latest_snapshot": q_latest_snapshot,
    "resolve_snapshot": q_resolve_snapshot,
    "resolve_snapshot_direct": q_resolve_snapshot_direct,
    "resolve_snapshot_file": q_resolve_snapshot_file,
    "manifest": q_manifest,
    "manifest_top_n": q_manifest_top_n,
    "manifest_total": q_manifest_total,
    "fetch_plan": q_fetch_plan,
    "fetch_failures": q_fetch_failures,
    "failed_files": q_failed_files,
    "failed_names": q_failed_names,
    "overwrite_table": q_overwrite_table,
    "append_table": q_append_table,
    "append_batches": q_append_batches,
    "connector_append": q_connector_append,
    "clear_and_append": q_clear_and_append,
    "create_if_missing": q_create_if_missing,
    "replace_table": q_replace_table,
    "fan_out": q_fan_out,
}


def _optional() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the optional subpackage and its pipeline; none where it can't be imported."""
    try:
        from disclosure.llm.queries import ORACLES, QUERIES
    except ImportError:
        return {}, {}
    queries, sql = dict(QUERIES), dict(ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        return queries, sql
    queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: star-schema loans at sf0.001 -> report -> search box -> result cards."""
    return search_cards(_report(spark, SMOKE_DIR), SEARCH_Q)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _optional()[0]


def oracle_sql() -> dict[str, str]:
    return O.oracle_queries() | _optional()[1]
