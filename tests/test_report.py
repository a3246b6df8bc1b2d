"""The report and search operators: golden sample rows, star-schema coverage, plan shape."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from disclosure.operators import detail, loan_report, normalize_query, search, search_cards
from disclosure.plans.checks import exchanges, pushed_filters, python_nodes, read_schema_columns
from disclosure.schema import REPORT_COLUMNS
from disclosure.sources.csv import read_loans
from disclosure.sources.star import loans_from_star
from tests.conftest import SAMPLE_CSV, SF01

# Worked out by hand from tests/data/loans_sample.csv.
GOLDEN_COLS = ["Location_Display", "Lender_Display", "LoanAmount_Display", "ForgivenessAmount_Display",
               "DateApproved_Display", "LoanStatus_Display", "AreaType_Display", "Recipient_Display",
               "JobsReported_Display", "Industry_Display", "searchtext"]
GOLDEN = {
    "7000000001": (None, None, "$149,362", "$150,775", "Jan. 22, 2021 (Second Round)", "Forgiven as of Jan. 13, 2022",
                   "Urban", "EXEMPTION 6", "12", "624190", " exemption 6  non-profit organization 624190"),
    "7000000002": ("Ladson, SC", "River Bank", "$140,082", "$141,920", "May 1, 2020 (First Round)",
                   "Forgiven as of Aug. 25, 2021", "Urban", 'JOE "S" PIZZA, INC', "12", None,
                   'joe "s" pizza, inc river bank river bank 29456 limited  liability company(llc) ladson ladson sc sc'),
    "7000000003": ("Redford, MI", "Lake Bank, National Association", "$126,798", None, "May 1, 2020 (First Round)",
                   "Fully Disbursed", "Rural", "LAKE KITCHENS &AMP; MORE, LLC", None, "541990",
                   "lake kitchens &amp; more, llc lake bank, national association 48239 corporation redford mi 541990"),
    "7000000004": (None, "River Bank", "$0", None, "May 1, 2020", "Exemption 4", None, "OPEN LOAN", "12", "541990",
                   "open loan river bank river bank corporation 541990"),
    "7000000005": (None, "River Bank", "$1,000", None, None, "Unknown", "Urban", "BAD CELLS", None, "541990",
                   "bad cells river bank river bank corporation 541990"),
}


@pytest.fixture(scope="module")
def sample_report(spark):
    return loan_report(read_loans(spark, SAMPLE_CSV)).cache()


def test_golden_sample(sample_report):
    rows = {r["LoanNumber"]: r for r in sample_report.collect()}
    assert set(rows) == set(GOLDEN)
    for key, expected in GOLDEN.items():
        assert tuple(rows[key][c] for c in GOLDEN_COLS) == expected, key
        assert rows[key]["MortgageInterest_Display"] == "$0"
    assert rows["7000000001"]["Utilities_Display"] == "$1"
    assert rows["7000000001"]["Payroll_Display"] == "$149,358"


def test_sample_search(sample_report):
    hits = search(search(sample_report, "river"), "29456").select("LoanNumber").collect()
    assert [r[0] for r in hits] == ["7000000002"]


@pytest.fixture(scope="module")
def star_report(spark):
    return loan_report(loans_from_star(spark, SF01)).cache()


def test_star_coverage(star_report):
    r = star_report
    assert r.columns == REPORT_COLUMNS
    assert r.count() == 15000
    assert r.filter(F.col("Location_Display").isNull()).count() == 859
    assert r.filter(F.col("Lender_Display").isNull()).count() == 1176
    assert r.filter(F.col("LoanAmount_Display") == "$0").count() == 883
    assert r.filter(F.col("LoanAmount_Display").startswith("$-")).count() == 743
    assert r.filter(F.col("LoanStatus_Display") == "Fully Disbursed").count() == 114
    assert r.filter(F.col("LoanStatus_Display").startswith("Forgiven as of")).count() == 10000
    assert search(r, "supplier#000000003 svc").count() == 446
    assert search(r, "99").count() == 794
    assert search(r, "brazil").count() == 0


def test_search_semantics(star_report):
    assert normalize_query("  Foo   Bar ") == "foo bar"
    assert search(star_report, None).count() == 15000
    assert search(star_report, "   ").count() == 15000
    literal = search(star_report, "supplier#000000003 svc").count()
    assert search(star_report, "SUPPLIER#000000003   SVC").count() == literal
    assert search(star_report, "supplier#00000000? svc").count() > literal
    assert search(star_report, "supplier#00000000~? svc").count() == 0
    assert search(star_report, "100%").count() == 0
    cards = search_cards(star_report, "nation_2")
    assert cards.columns[0] == "LoanNumber" and len(cards.columns) == 6
    d = detail(star_report, "10000").collect()
    assert len(d) == 1 and len(d[0]) == 15


def test_report_plan_is_one_map_stage(spark, sample_report):
    report = loan_report(read_loans(spark, SAMPLE_CSV))
    assert exchanges(report) == 0
    assert python_nodes(report) == []
    (cols,) = read_schema_columns(report)
    assert len(cols) == 31


def test_search_pushes_into_published_parquet(spark, star_report, tmp_dir):
    path = os.path.join(tmp_dir, "report")
    star_report.write.parquet(path)
    found = search_cards(spark.read.parquet(path), "supplier#000000003 svc")
    (filters,) = pushed_filters(found)
    assert "StringContains(searchtext,supplier#000000003 svc)" in filters
    (cols,) = read_schema_columns(found)
    assert sorted(cols) == sorted(["LoanNumber", "Recipient_Display", "Location_Display", "LoanStatus_Display",
                                   "LoanAmount_Display", "DateApproved_Display", "searchtext"])
    assert found.count() == 446
