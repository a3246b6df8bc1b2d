"""DuckDB SQL that computes, independently of Spark, what each registered query must return.

Used by ``__spark_entry__.oracle_sql()``. The views ``orders customer nation region supplier
events documents labels ...`` are the driver's Parquet tables. Every double constant is
written as a DOUBLE, and ``trim(x, ' ')`` is used because Spark's ``trim`` strips only spaces.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType

from disclosure.functions.display import AP_MONTHS, BYTE_UNITS
from disclosure.schema import LOAN_FIELDS, PROCEEDS, REPORT_COLUMNS

SEARCH_Q = "supplier#000000003 svc"


def _duck_type(dtype) -> str:
    if isinstance(dtype, DateType):
        return "DATE"
    if isinstance(dtype, DoubleType):
        return "DOUBLE"
    if isinstance(dtype, IntegerType):
        return "INTEGER"
    return "VARCHAR"


# ---------------------------------------------------------------- expression helpers


def trim_sp(x: str) -> str:
    return f"trim({x}, ' ')"


def clean(x: str) -> str:
    t = trim_sp(x)
    return f"(CASE WHEN {t} = '' OR upper({t}) IN ('N/A', 'NA') THEN NULL ELSE {t} END)"


def cur(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN '$0' ELSE '$' || format('{{:,}}', CAST(round({x}) AS BIGINT)) END)"


def cur_or_null(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE '$' || format('{{:,}}', CAST(round({x}) AS BIGINT)) END)"


def ap_month(d: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(AP_MONTHS, start=1))
    return f"(CASE month({d}) {whens} END)"


def ap_date(d: str) -> str:
    return f"({ap_month(d)} || ' ' || strftime({d}, '%-d, %Y'))"


def round_suffix(m: str) -> str:
    return f"(CASE WHEN {m} = 'PPP' THEN ' (First Round)' WHEN {m} = 'PPS' THEN ' (Second Round)' ELSE '' END)"


def date_with_round(d: str, m: str) -> str:
    return f"({ap_date(d)} || {round_suffix(m)})"


def status(fd: str, und: str, st: str) -> str:
    return (
        f"(CASE WHEN {fd} IS NOT NULL THEN 'Forgiven as of ' || {ap_date(fd)} "
        f"WHEN {und} = 0 AND {st} = 'Exemption 4' THEN 'Fully Disbursed' "
        f"ELSE coalesce({st}, 'Unknown') END)"
    )


def location(pc: str, bc: str, ps: str, bs: str) -> str:
    city = f"coalesce({clean(pc)}, {clean(bc)})"
    state = f"coalesce({clean(ps)}, {clean(bs)})"
    return f"(CASE WHEN {city} IS NULL AND {state} IS NULL THEN NULL ELSE concat_ws(', ', {city}, {state}) END)"


def zip5(pz: str, bz: str) -> str:
    return f"regexp_extract(coalesce({trim_sp(pz)}, {trim_sp(bz)}), '^(\\d{{5}})', 1)"


def searchtext(src: str = "") -> str:
    p = src
    parts = [
        f"{p}BorrowerName",
        f"{p}OriginatingLender",
        f"{p}ServicingLenderName",
        zip5(f"{p}ProjectZip", f"{p}BorrowerZip"),
        f"{p}BusinessType",
        clean(f"{p}ProjectCity"),
        clean(f"{p}BorrowerCity"),
        clean(f"{p}ProjectState"),
        clean(f"{p}BorrowerState"),
        f"CAST({p}NAICSCode AS VARCHAR)",
    ]
    return f"lower(concat_ws(' ', {', '.join(parts)}))"


def human_bytes(n: str) -> str:
    v = f"coalesce(CAST({n} AS DOUBLE), CAST(0 AS DOUBLE))"
    idx = "CASE " + " ".join(f"WHEN {v} < {1024.0 ** (i + 1)!r} THEN {i}" for i in range(len(BYTE_UNITS) - 1))
    idx += f" ELSE {len(BYTE_UNITS) - 1} END"
    units = "[" + ", ".join(f"'{u}'" for u in BYTE_UNITS) + "]"
    return f"printf('%.1f %s', {v} / pow(CAST(1024 AS DOUBLE), {idx}), {units}[({idx}) + 1])"


# ---------------------------------------------------------------- the star-schema loans

_LOAN_VALUES = {
    "LoanNumber": "CAST(k AS VARCHAR)",
    "DateApproved": "CASE WHEN k % 53 <> 0 THEN day END",
    "SBAOfficeCode": "lpad(CAST(o_custkey % 1000 AS VARCHAR), 4, '0')",
    "ProcessingMethod": "CASE o_orderstatus WHEN 'F' THEN 'PPP' WHEN 'O' THEN 'PPS' END",
    "BorrowerName": "'  ' || c_name || ' '",
    "BorrowerCity": "CASE k % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL WHEN 2 THEN '' ELSE n_name END",
    "BorrowerState": "CASE k % 4 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE r_name END",
    "BorrowerZip": "CASE WHEN k % 2 <> 0 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '9') END",
    "LoanStatusDate": "day",
    "LoanStatus": "CASE k % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Exemption 4' WHEN 2 THEN 'Charged Off' ELSE 'Paid in Full' END",
    "Term": "CAST(24 + k % 37 AS INTEGER)",
    "SBAGuarantyPercentage": "CAST(100.0 AS DOUBLE)",
    "InitialApprovalAmount": "o_totalprice",
    "CurrentApprovalAmount": "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN -o_totalprice ELSE o_totalprice END",
    "UndisbursedAmount": "CASE k % 4 WHEN 0 THEN CAST(0.0 AS DOUBLE) WHEN 1 THEN NULL ELSE o_totalprice / CAST(10.0 AS DOUBLE) END",
    "ServicingLenderName": "CASE WHEN k % 16 <> 0 THEN s_name || ' Svc' END",
    "RuralUrbanIndicator": "CASE k % 4 WHEN 0 THEN 'U' WHEN 1 THEN 'R' WHEN 2 THEN 'u' END",
    "BusinessAgeDescription": "o_orderpriority",
    "ProjectCity": "CASE k % 6 WHEN 0 THEN ' n/a ' WHEN 1 THEN 'Na' WHEN 2 THEN '   ' WHEN 3 THEN NULL ELSE ' ' || n_name END",
    "ProjectState": "CASE k % 5 WHEN 0 THEN 'NA' WHEN 1 THEN NULL ELSE r_name END",
    "ProjectZip": (
        "CASE k % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN '  ' WHEN 2 THEN '1234' WHEN 3 THEN NULL "
        "ELSE ' ' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') || '-2734' END"
    ),
    "JobsReported": "CASE WHEN k % 13 <> 0 THEN CAST(k % 500 AS INTEGER) END",
    "NAICSCode": "CASE WHEN k % 10 <> 0 THEN CAST(100000 + o_custkey AS VARCHAR) END",
    "UTILITIES_PROCEED": "CASE WHEN k % 5 = 0 THEN CAST(k AS DOUBLE) + CAST(0.5 AS DOUBLE) END",
    "PAYROLL_PROCEED": "CASE WHEN k % 2 = 0 THEN o_totalprice * CAST(0.75 AS DOUBLE) END",
    "BusinessType": "c_mktsegment || '  Co '",
    "OriginatingLender": "CASE WHEN k % 8 <> 0 THEN s_name END",
    "ForgivenessAmount": "CASE WHEN k % 3 <> 0 THEN o_totalprice END",
    "ForgivenessDate": "CASE WHEN k % 3 <> 0 THEN day END",
}


def _loan_select() -> str:
    cols = []
    for name, dtype in LOAN_FIELDS:
        expr = _LOAN_VALUES.get(name, "NULL")
        cols.append(f"CAST({expr} AS {_duck_type(dtype)}) AS {name}")
    return ",\n    ".join(cols)


LOANS_CTES = f"""
lines AS (SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey),
j AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_totalprice,
         CAST(o.o_orderdate AS DATE) AS day, o.o_orderpriority,
         c.c_name, c.c_mktsegment, n.n_name, r.r_name, s.s_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
loans AS (
  SELECT
    {_loan_select()}
  FROM j
)"""


def _csv_loans_select() -> str:
    cols = []
    for name, dtype in LOAN_FIELDS:
        cols.append(f"nullif({name}, '') AS {name}" if _duck_type(dtype) == "VARCHAR" else name)
    return ", ".join(cols)


# Loans after a CSV round trip: an empty string and a null are the same empty cell.
CSV_LOANS_CTES = LOANS_CTES + f""",
csv_loans AS (SELECT {_csv_loans_select()} FROM loans)"""


# The malformed CSV of the reject queries: every 23rd approval date in ISO form and every 29th job
# count as ``n.0``. The reader makes these cells null and keeps the row.
REJECTED = "(bad_date OR bad_jobs)"
PERMISSIVE_CTES = CSV_LOANS_CTES + f""",
permissive AS (
  SELECT * REPLACE (
      CASE WHEN CAST(LoanNumber AS BIGINT) % 23 = 0 THEN NULL ELSE DateApproved END AS DateApproved,
      CASE WHEN CAST(LoanNumber AS BIGINT) % 29 = 0 THEN NULL ELSE JobsReported END AS JobsReported),
    CAST(LoanNumber AS BIGINT) % 23 = 0 AND DateApproved IS NOT NULL AS bad_date,
    CAST(LoanNumber AS BIGINT) % 29 = 0 AND JobsReported IS NOT NULL AS bad_jobs
  FROM csv_loans
)"""


def report_exprs() -> dict[str, str]:
    derived = {
        "Recipient_Display": f"upper({trim_sp('BorrowerName')})",
        "Location_Display": location("ProjectCity", "BorrowerCity", "ProjectState", "BorrowerState"),
        "AreaType_Display": "(CASE WHEN RuralUrbanIndicator = 'U' THEN 'Urban' WHEN RuralUrbanIndicator = 'R' THEN 'Rural' END)",
        "Lender_Display": "coalesce(OriginatingLender, ServicingLenderName)",
        "BusinessAge_Display": "BusinessAgeDescription",
        "Industry_Display": "CAST(NAICSCode AS VARCHAR)",
        "JobsReported_Display": "CAST(JobsReported AS VARCHAR)",
        "BusinessType_Display": trim_sp("BusinessType"),
        "LoanAmount_Display": cur("CurrentApprovalAmount"),
        "ForgivenessAmount_Display": cur_or_null("ForgivenessAmount"),
        "DateApproved_Display": date_with_round("DateApproved", "ProcessingMethod"),
        "LoanStatus_Display": status("ForgivenessDate", "UndisbursedAmount", "LoanStatus"),
        "searchtext": searchtext(),
    }
    for source, display in PROCEEDS:
        derived[display] = cur(source)
    return {name: derived.get(name, name) for name in REPORT_COLUMNS}


def report_select(src: str, extra_where: str = "") -> str:
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in report_exprs().items())
    return f"SELECT\n  {cols}\nFROM {src}{extra_where}"


def with_report(src: str = "loans", ctes: str = LOANS_CTES) -> str:
    """CTEs defining ``report`` over ``src``."""
    return f"{ctes},\nreport AS (\n{report_select(src)}\n)"


# ---------------------------------------------------------------- derived inputs

LANDING = "file:/landing"


def event_inventory(with_direct: bool) -> str:
    suffix = "CASE event_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.CSV' WHEN 2 THEN '.json' ELSE '.Csv' END"
    name = f"'events_' || CAST(event_id AS VARCHAR) || {suffix}"
    nested = f"'{LANDING}/' || strftime(ts, '%Y%m%d') || '/' || {name}"
    path = f"CASE WHEN user_id % 10 = 0 THEN '{LANDING}/' || {name} ELSE {nested} END" if with_direct else nested
    return (
        f"SELECT {path} AS path, CAST(floor(value * CAST(100.0 AS DOUBLE)) AS BIGINT) AS length, "
        f"ts AS modificationTime FROM events"
    )


def inventory_rel(with_direct: bool) -> str:
    rel = f"substr(path, {len(LANDING) + 2})"
    return (
        f"SELECT path, length, modificationTime, {rel} AS rel, "
        f"len(string_split({rel}, '/')) - 1 AS depth, "
        f"CASE WHEN len(string_split({rel}, '/')) > 1 THEN string_split({rel}, '/')[1] END AS folder "
        f"FROM ({event_inventory(with_direct)})"
    )


DOC_RESOURCES = """
SELECT doc_id, doc_id // 64 AS block, 'doc-' || CAST(doc_id AS VARCHAR) AS id,
  CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
       ELSE source || '/' || lang || '_' || CAST(doc_id AS VARCHAR) || '.csv' END AS name,
  'https://data.example.org/' || source || '/' || CAST(doc_id AS VARCHAR) AS url,
  CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS BIGINT) ELSE n_chars END AS size,
  CASE doc_id % 4 WHEN 0 THEN 'CSV' WHEN 1 THEN 'csv' WHEN 2 THEN NULL ELSE 'XLSX' END AS format
FROM documents"""


def manifest_sql(limit: int | None = None) -> str:
    keep = f"WHERE pos <= {limit}" if limit is not None else ""
    return f"""
WITH res AS ({DOC_RESOURCES}),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY block ORDER BY doc_id) AS pos
  FROM res WHERE upper(coalesce(format, '')) IN ('CSV')
)
SELECT 'catalog-' || CAST(block AS VARCHAR) AS dataset, CAST(pos AS INTEGER) AS pos,
  regexp_extract(coalesce(nullif(name, ''), id), '[^/]+$', 0) AS name, url, size,
  upper(coalesce(format, '')) AS format
FROM kept {keep}"""


DOC_INVENTORY = """
SELECT 'file:/downloads/' || regexp_extract(coalesce(nullif(name, ''), id), '[^/]+$', 0)
    || CASE WHEN doc_id % 3 = 0 THEN '.part' ELSE '' END AS path,
  CAST(coalesce(size, 0) + CASE WHEN doc_id % 5 = 2 THEN 1 ELSE 0 END AS BIGINT) AS length
FROM (""" + DOC_RESOURCES + """)"""


LABEL_OUTCOMES = """
SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.csv' AS name,
  CASE WHEN toxic = 1 THEN 'HTTP Error 500: Internal Server Error' END AS error
FROM labels"""


# ---------------------------------------------------------------- the registered oracles

CARD_COLS = "LoanNumber, Recipient_Display, Location_Display, LoanStatus_Display, LoanAmount_Display, DateApproved_Display"
DETAIL_COLS = (
    "LoanNumber, " + ", ".join(d for _, d in PROCEEDS) + ", ForgivenessAmount_Display, Lender_Display, "
    "AreaType_Display, BusinessAge_Display, Industry_Display, BusinessType_Display, JobsReported_Display"
)


def _over_report(select: str, src: str = "loans", ctes: str = LOANS_CTES) -> str:
    return f"WITH {with_report(src, ctes)}\n{select}"


def _orders_amount(rule: str, fn) -> str:
    return (
        f"SELECT o_orderkey, amount, {fn('amount')} AS display FROM "
        f"(SELECT o_orderkey, CASE WHEN {rule} THEN o_totalprice END AS amount FROM orders)"
    )


def _order_day(col_sql: str, alias: str) -> str:
    return (
        f"SELECT o_orderkey, d, {col_sql} AS {alias} FROM "
        f"(SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)"
    )


def _loan_cols(cols: str) -> str:
    return _over_report(f"SELECT LoanNumber, {cols} FROM report")


def _inventory(with_direct: bool) -> str:
    return f"WITH inv AS ({inventory_rel(with_direct)}),\n" + (
        "times AS (SELECT folder, max(modificationTime) AS newest, CAST(count(*) AS BIGINT) AS files "
        "FROM inv WHERE folder IS NOT NULL GROUP BY folder),\n"
        "latest AS (SELECT folder, newest FROM times ORDER BY newest DESC, folder DESC LIMIT 1)\n"
    )


def oracle_queries() -> dict[str, str]:
    k_rej = "CAST(LoanNumber AS BIGINT)"
    location_raw = (
        "CASE c_custkey % 8 WHEN 0 THEN ' n/a ' WHEN 1 THEN 'Na' WHEN 2 THEN '' WHEN 3 THEN NULL "
        "WHEN 4 THEN '   ' WHEN 5 THEN 'N/A' WHEN 6 THEN ' ' || c_name || ' ' ELSE c_mktsegment END"
    )
    valid_raw = (
        "CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN replace(p_type, ' ', '_') "
        "WHEN 2 THEN 'T_' || CAST(p_partkey AS VARCHAR) WHEN 3 THEN p_brand "
        "ELSE CAST(p_partkey AS VARCHAR) || '_t' END"
    )
    report_all = _over_report("SELECT * FROM report")
    csv_report_all = _over_report("SELECT * FROM report", src="csv_loans", ctes=CSV_LOANS_CTES)
    q = {
        "loan_report": report_all,
        "search": _over_report(f"SELECT * FROM report WHERE contains(searchtext, '{SEARCH_Q}')"),
        "search_indexed": _over_report(f"SELECT * FROM report WHERE contains(searchtext, '{SEARCH_Q}')"),
        "search_empty": _over_report(f"SELECT {CARD_COLS} FROM report"),
        "search_cards": _over_report(f"SELECT {CARD_COLS} FROM report WHERE contains(searchtext, 'nation_2 asia')"),
        "search_wildcard": _over_report(
            "SELECT LoanNumber, searchtext FROM report WHERE searchtext LIKE '%supplier#00000000_ svc%household%'"
        ),
        "loan_detail": _over_report(f"SELECT {DETAIL_COLS} FROM report WHERE LoanNumber = '10000'"),
        "row_count": f"WITH {LOANS_CTES}\nSELECT CAST(count(*) AS BIGINT) AS n_rows FROM loans",
        # Any 1000 rows may come; each must be a whole row of the report.
        "row_limit": f"WITH {LOANS_CTES}\nSELECT CAST(least(count(*), 1000) AS BIGINT) AS n_rows, "
        "CAST(least(count(*), 1000) AS BIGINT) AS n_in_report FROM loans",
        "currency": _orders_amount("o_orderkey % 7 <> 0", cur),
        "currency_negative": f"SELECT c_custkey, c_acctbal AS amount, {cur('c_acctbal')} AS display FROM customer",
        "currency_half": (
            f"SELECT c_custkey, amount, {cur('amount')} AS display FROM "
            "(SELECT c_custkey, CAST(c_custkey - 700 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS amount FROM customer)"
        ),
        "currency_nullable": _orders_amount("o_orderkey % 3 <> 0", cur_or_null),
        "proceeds_displays": _loan_cols(", ".join(d for _, d in PROCEEDS)),
        "ap_month": _order_day(ap_month("d"), "month_display"),
        "ap_date": _order_day(ap_date("d"), "date_display"),
        "date_with_round": _loan_cols("DateApproved, ProcessingMethod, DateApproved_Display"),
        "clean_location": (
            f"SELECT c_custkey, raw, {clean('raw')} AS cleaned FROM "
            f"(SELECT c_custkey, {location_raw} AS raw FROM customer)"
        ),
        "location": _loan_cols("Location_Display"),
        "zip5": f"WITH {LOANS_CTES}\nSELECT LoanNumber, {zip5('ProjectZip', 'BorrowerZip')} AS zip5 FROM loans",
        "searchtext": _loan_cols("searchtext"),
        "status_cascade": _loan_cols("LoanStatus_Display"),
        "recipient": _loan_cols("Recipient_Display"),
        "area_type": _loan_cols("AreaType_Display"),
        "lender": _loan_cols("Lender_Display"),
        "business_type": _loan_cols("BusinessType_Display"),
        "business_age": _loan_cols("BusinessAge_Display"),
        "industry": _loan_cols("NAICSCode, Industry_Display"),
        "int_to_text": _loan_cols("JobsReported, JobsReported_Display"),
        "human_bytes": (
            f"SELECT doc_id, n_bytes, {human_bytes('n_bytes')} AS display FROM "
            "(SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN (n_chars << (doc_id % 5 * 10)) + doc_id END AS n_bytes "
            "FROM documents)"
        ),
        "valid_name": (
            "SELECT p_partkey, name, regexp_full_match(name, '[A-Za-z_][A-Za-z0-9_]*') AS valid FROM "
            f"(SELECT p_partkey, {valid_raw} AS name FROM part)"
        ),
        "csv_scan": f"WITH {CSV_LOANS_CTES}\nSELECT * FROM csv_loans",
        "newest_generation": f"WITH {CSV_LOANS_CTES}\nSELECT * FROM csv_loans",
        "csv_multi_scan": (
            f"WITH {CSV_LOANS_CTES}\nSELECT * FROM csv_loans UNION ALL "
            "SELECT * FROM csv_loans WHERE ProcessingMethod = 'PPP'"
        ),
        "csv_rejects": (
            f"WITH {LOANS_CTES}\nSELECT LoanNumber, "
            f"CASE WHEN {k_rej} % 23 = 0 THEN NULL ELSE DateApproved END AS DateApproved, "
            f"CASE WHEN {k_rej} % 29 = 0 THEN NULL ELSE JobsReported END AS JobsReported FROM loans "
            f"WHERE ({k_rej} % 23 = 0 AND DateApproved IS NOT NULL) OR ({k_rej} % 29 = 0 AND JobsReported IS NOT NULL)"
        ),
        "csv_reject_cells": (
            f"WITH {LOANS_CTES}\nSELECT LoanNumber, 'DateApproved' AS column_name, strftime(DateApproved, '%Y-%m-%d') AS cell, "
            f"'not a date (MM/dd/yyyy)' AS problem, true AS located FROM loans WHERE {k_rej} % 23 = 0 AND DateApproved IS NOT NULL "
            f"UNION ALL SELECT LoanNumber, 'JobsReported', CAST(JobsReported AS VARCHAR) || '.0', 'not of type int', true "
            f"FROM loans WHERE {k_rej} % 29 = 0 AND JobsReported IS NOT NULL"
        ),
        "refresh_job": csv_report_all,
        # Rejected lines stay in the report, with the bad cells null; the rejects are additional.
        "refresh_job_rejects": (
            f"WITH {with_report('permissive', PERMISSIVE_CTES)}\n"
            "SELECT 'report' AS kind, LoanNumber, DateApproved, DateApproved_Display, JobsReported_Display FROM report "
            f"UNION ALL SELECT 'reject', LoanNumber, DateApproved, NULL, NULL FROM permissive WHERE {REJECTED}"
        ),
        "csv_permissive": f"WITH {PERMISSIVE_CTES}\nSELECT {', '.join(n for n, _ in LOAN_FIELDS)} FROM permissive",
        "refresh_job_sinks": _over_report(
            "SELECT *, 'overwrite' AS sink FROM report UNION ALL SELECT *, 'clear_and_append' AS sink FROM report",
            src="csv_loans",
            ctes=CSV_LOANS_CTES,
        ),
        "connector_append": _over_report("SELECT * FROM report UNION ALL SELECT * FROM report"),
        "resolve_snapshot_direct": (
            _inventory(True) + "SELECT path, length, modificationTime FROM inv WHERE depth = 0 AND lower(rel) LIKE '%.csv'"
        ),
        "resolve_snapshot_file": (
            _inventory(True) + "SELECT path, length, modificationTime FROM inv WHERE path = "
            "(SELECT min(path) FROM inv WHERE depth = 0 AND lower(rel) LIKE '%.csv')"
        ),
        "stream_publish": csv_report_all,
        "list_files": (
            _inventory(True) + "SELECT path, length, modificationTime FROM inv WHERE depth = 0 AND lower(rel) LIKE '%.csv'"
        ),
        "subfolder_times": _inventory(True) + "SELECT folder, newest, files FROM times",
        "latest_snapshot": _inventory(True) + "SELECT folder, newest FROM latest",
        "resolve_snapshot": (
            _inventory(False) + "SELECT path, length, modificationTime FROM inv "
            "WHERE depth = 1 AND lower(rel) LIKE '%.csv' AND folder = (SELECT folder FROM latest)"
        ),
        "manifest": manifest_sql(),
        "manifest_top_n": manifest_sql(3),
        "manifest_total": (
            f"WITH m AS ({manifest_sql()}),\n"
            "t AS (SELECT CAST(count(*) AS BIGINT) AS n_files, "
            "CAST(coalesce(sum(coalesce(size, 0)), 0) AS BIGINT) AS total_bytes FROM m)\n"
            f"SELECT n_files, total_bytes, {human_bytes('total_bytes')} AS total_display FROM t"
        ),
        "fetch_plan": (
            f"WITH m AS ({manifest_sql()}),\ninv AS ({DOC_INVENTORY})\n"
            "SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM inv WHERE "
            "inv.path = 'file:/downloads/' || m.name AND inv.length = m.size AND m.size <> 0)"
        ),
        "fetch_failures": (
            f"SELECT CAST(count(*) FILTER (WHERE error IS NOT NULL) AS BIGINT) AS n_failed, "
            f"CAST(count(*) AS BIGINT) AS n_total FROM ({LABEL_OUTCOMES})"
        ),
        "failed_files": f"SELECT name, error FROM ({LABEL_OUTCOMES}) WHERE error IS NOT NULL",
        "failed_names": (
            f"SELECT coalesce(string_agg(name, ', ' ORDER BY name) FILTER (WHERE error IS NOT NULL), '') AS names FROM ({LABEL_OUTCOMES})"
        ),
        "append_batches": report_all,
        "overwrite_table": report_all,
        "append_table": _over_report("SELECT * FROM report UNION ALL SELECT * FROM report"),
        "clear_and_append": report_all,
        "create_if_missing": report_all,
        "replace_table": report_all,
        "fan_out": _over_report("SELECT *, 'a' AS sink FROM report UNION ALL SELECT *, 'b' AS sink FROM report"),
    }
    return q
