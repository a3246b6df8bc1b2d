"""Column builders on small hand-written inputs: nulls, rounding, text edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from disclosure.functions import display as D


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_clean_location(spark):
    rows = [(" n/a ",), ("Na",), ("",), (None,), ("   ",), ("N/A",), (" Ladson ",), ("NAPA",)]
    assert one(spark, D.clean_location("x"), "x string", rows) == [None, None, None, None, None, None, "Ladson", "NAPA"]


def test_currency_rounds_half_up_and_formats(spark):
    rows = [(None,), (0.5,), (2.5,), (-0.5,), (-0.4,), (1234.5,), (-1234.5,), (149360.6,), (1e9,), (0.0,)]
    got = one(spark, D.currency("x"), "x double", rows)
    assert got == ["$0", "$1", "$3", "$-1", "$0", "$1,235", "$-1,235", "$149,361", "$1,000,000,000", "$0"]


def test_currency_or_null(spark):
    assert one(spark, D.currency_or_null("x"), "x double", [(None,), (150775.38,)]) == [None, "$150,775"]


def test_ap_dates(spark):
    days = [dt.date(2021, m, 1 + m) for m in range(1, 13)] + [None]
    got = one(spark, D.ap_date("d"), "d date", [(d,) for d in days])
    assert got[:12] == [
        "Jan. 2, 2021", "Feb. 3, 2021", "March 4, 2021", "April 5, 2021", "May 6, 2021", "June 7, 2021",
        "July 8, 2021", "Aug. 9, 2021", "Sept. 10, 2021", "Oct. 11, 2021", "Nov. 12, 2021", "Dec. 13, 2021",
    ]
    assert got[12] is None
    assert one(spark, D.ap_month("d"), "d date", [(None,)]) == [None]


def test_date_with_round(spark):
    rows = [(dt.date(2021, 1, 22), "PPS"), (dt.date(2020, 5, 1), "PPP"), (dt.date(2020, 5, 1), None),
            (dt.date(2020, 5, 1), "ppp"), (None, "PPP")]
    got = one(spark, D.date_with_round("d", "m"), "d date, m string", rows)
    assert got == ["Jan. 22, 2021 (Second Round)", "May 1, 2020 (First Round)", "May 1, 2020", "May 1, 2020", None]


def test_loan_status_cascade(spark):
    rows = [
        (dt.date(2022, 1, 13), 5.0, "Paid in Full"),
        (None, 0.0, "Exemption 4"),
        (None, None, "Exemption 4"),
        (None, 1.0, "Exemption 4"),
        (None, 0.0, None),
        (None, 0.0, "Charged Off"),
    ]
    got = one(spark, D.loan_status("fd", "u", "s"), "fd date, u double, s string", rows)
    assert got == ["Forgiven as of Jan. 13, 2022", "Fully Disbursed", "Exemption 4", "Exemption 4", "Unknown", "Charged Off"]


def test_location(spark):
    rows = [
        ("Ladson", "X", "SC", "Y"),
        (None, "Manning", None, "SC"),
        ("N/A", None, None, None),
        (" ", "Redford", "NA", None),
        (None, None, "MI", None),
    ]
    got = one(spark, D.location("pc", "bc", "ps", "bs"), "pc string, bc string, ps string, bs string", rows)
    assert got == ["Ladson, SC", "Manning, SC", None, "Redford", "MI"]


def test_zip5_uses_raw_first_non_null(spark):
    rows = [(" 29456-1234", "11111"), ("N/A", "29102"), (None, " 48239 "), ("  ", "29303"), (None, None), ("1234", None)]
    assert one(spark, D.zip5("p", "b"), "p string, b string", rows) == ["29456", "", "48239", "", None, ""]


def test_search_text_keeps_empty_zip(spark):
    schema = ", ".join(f"c{i} string" for i in range(11))
    row = ("NOT AVAILABLE", "Bank", None, "N/A", "", None, "N/A", None, "NA", None, "339114")
    got = one(spark, D.search_text(*[f"c{i}" for i in range(11)]), schema, [row])
    assert got == ["not available bank  339114"]
    assert one(spark, D.search_text(*[f"c{i}" for i in range(11)]), schema, [(None,) * 11]) == [""]


def test_small_columns(spark):
    rows = [("  Acme Co ", "U", None, "Svc", "LLC  x ", 15)]
    df = spark.createDataFrame(rows, "n string, a string, o string, s string, b string, j int")
    r = df.select(
        D.recipient("n"), D.area_type("a"), D.lender("o", "s"), D.business_type("b"), D.as_text("j")
    ).first()
    assert tuple(r) == ("ACME CO", "Urban", "Svc", "LLC  x", "15")
    assert one(spark, D.area_type("a"), "a string", [("u",), ("R",), (None,)]) == [None, "Rural", None]
    assert one(spark, D.lender("o", "s"), "o string, s string", [("", "Svc")]) == [""]


def test_human_bytes(spark):
    rows = [(None,), (0,), (1023,), (1024,), (1280,), (431 * 1024 * 1024 + 200000,), (5 * 1024 ** 5,)]
    got = one(spark, D.human_bytes("n"), "n bigint", rows)
    assert got == ["0.0 B", "0.0 B", "1023.0 B", "1.0 KB", "1.2 KB", "431.2 MB", "5120.0 TB"]


def test_valid_identifier(spark):
    rows = [("loans_report",), ("_x1",), ("1abc",), ("a-b",), ("abc\n",), ("",)]
    assert one(spark, D.valid_identifier("t"), "t string", rows) == [True, True, False, False, False, False]


def test_file_name_helpers(spark):
    df = spark.createDataFrame([("file:/a/b/X.CSV",), ("s3a://b/k/y.json",)], "p string")
    got = df.select(D.base_name("p"), D.has_csv_suffix("p")).collect()
    assert [tuple(r) for r in got] == [("X.CSV", True), ("y.json", False)]


def test_no_python_in_builders(spark):
    df = spark.range(3).select(F.col("id").cast("double").alias("x"))
    from disclosure.plans.checks import python_nodes

    assert python_nodes(df.select(D.currency("x"), D.human_bytes("x"))) == []


def test_trim_keeps_non_breaking_space(spark):
    # Spark's trim strips U+0020 only, so NBSP-padded placeholders are kept as text.
    assert one(spark, D.clean_location("x"), "x string", [(" NA ",), ("\tNA",)]) == [" NA ", "\tNA"]
