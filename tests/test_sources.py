"""CSV edge rows, real folder listings and snapshot choice."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

from disclosure.plans.checks import plan_text
from disclosure.session import scratch_root, subfolders
from disclosure.sources.csv import CORRUPT_COLUMN, loan_reader, read_loans_with_rejects
from disclosure.sources.listing import (
    direct_csv_files,
    latest_subfolder,
    list_tree,
    resolve,
    snapshot_glob,
)

EDGE_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("d", DateType()),
        StructField("n", IntegerType()),
        StructField("x", DoubleType()),
        StructField("s", StringType()),
    ]
)
EDGE_LINES = [
    "id,d,n,x,s",
    "1,01/22/2021,5,1.5,ok",
    "2,2021-01-22,3.0,abc,bad types",
    "3,1/2/2021,7,NaN,lenient date",
    "4,01/22/2021",
    "5,01/22/2021,1,1,a,EXTRA",
    '6,,,,""',
    '7,,,," pad "',
    "",
    '8,02/30/2021,1,"1,000",x',
    '9,01/22/2021,1,1,"JOE ""S"" PIZZA, INC"',
    "10,01/22/2021,1,1,",
]


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


@pytest.mark.parametrize("materialize", ["stage", "persist"])
def test_csv_edge_rows(spark, tmp_dir, materialize):
    path = _write(tmp_dir, "edge.csv", EDGE_LINES)
    parsed = read_loans_with_rejects(spark, path, schema=EDGE_SCHEMA, materialize=materialize)
    loans, rejects = parsed.loans, parsed.rejects
    rows = {r["id"]: r for r in loans.collect()}
    assert len(rows) == loans.count() == 10  # rejected lines stay, with their bad cells null
    assert tuple(rows["1"]) == ("1", dt.date(2021, 1, 22), 5, 1.5, "ok")
    assert (rows["2"]["d"], rows["2"]["n"], rows["2"]["x"]) == (None, None, None)
    assert rows["3"]["d"] is None and rows["3"]["x"] != rows["3"]["x"]  # NaN
    assert (rows["4"]["n"], rows["4"]["x"], rows["4"]["s"]) == (None, None, None)
    assert rows["5"]["s"] == "a"
    assert tuple(rows["6"])[1:] == (None, None, None, None)
    assert rows["7"]["s"] == " pad "
    assert rows["8"]["d"] is None and rows["8"]["x"] is None
    assert rows["9"]["s"] == 'JOE "S" PIZZA, INC'
    assert rows["10"]["s"] is None
    rejected = sorted(r["id"] for r in rejects.collect())
    assert rejected == sorted(["2", "3", "4", "5", "8"])
    assert all(r[CORRUPT_COLUMN] for r in rejects.collect())
    assert "Sort" not in plan_text(rejects, "simple") + plan_text(loans, "simple")
    assert loans.select("id").count() == 10
    parsed.close()
    if materialize == "stage":
        assert not os.path.exists(parsed.folder.removeprefix("file:"))


def test_no_rejects(spark, tmp_dir):
    path = _write(tmp_dir, "ok.csv", EDGE_LINES[:2])
    parsed = read_loans_with_rejects(spark, path, schema=EDGE_SCHEMA)
    assert parsed.loans.count() == 1 and parsed.rejects.count() == 0


def test_backslash_escape_shifts_doubled_quotes(spark, tmp_dir):
    path = _write(tmp_dir, "q.csv", [EDGE_LINES[0], EDGE_LINES[10]])
    row = loan_reader(spark, schema=EDGE_SCHEMA, escape="\\").load(path).first()
    assert row["s"] != 'JOE "S" PIZZA, INC'


def test_reordered_header_fails_instead_of_shifting(spark, tmp_dir):
    path = _write(tmp_dir, "r.csv", ["id,n,d,x,s", "1,5,01/22/2021,1.5,ok"])
    with pytest.raises(SPARK_ERRORS):
        loan_reader(spark, schema=EDGE_SCHEMA).load(path).collect()
    shifted = loan_reader(spark, schema=EDGE_SCHEMA, enforce_schema=True).load(path).first()
    assert shifted["d"] is None  # the position-only reader loads the wrong cells


def _tree(base, direct: bool = True):
    """[base/a.csv, base/B.CSV,] base/notes.txt, base/2024/x.csv (old), base/2025/y.csv + z.json (new)."""
    if direct:
        _write(base, "a.csv", ["id", "1"])
        _write(base, "B.CSV", ["id", "2"])
    _write(base, "notes.txt", ["x"])
    old = _write(os.path.join(base, "2024"), "x.csv", ["id", "3"])
    new1 = _write(os.path.join(base, "2025"), "y.csv", ["id", "4"])
    new2 = _write(os.path.join(base, "2025"), "z.json", ["{}"])
    now = time.time()
    os.utime(old, (now - 3600, now - 3600))
    os.utime(new1, (now - 60, now - 60))
    os.utime(new2, (now, now))


def test_listing_and_snapshot(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing")
    _tree(base)
    listing = list_tree(spark, base)
    direct = [os.path.basename(r.path) for r in direct_csv_files(listing, base).collect()]
    assert direct == ["B.CSV", "a.csv"]
    assert latest_subfolder(listing, base).first()["folder"] == "2025"
    assert sorted(os.path.basename(r.path) for r in resolve(listing, base).collect()) == ["B.CSV", "a.csv"]
    one = resolve(listing, os.path.join(base, "B.CSV")).collect()
    assert [os.path.basename(r.path) for r in one] == ["B.CSV"]
    with pytest.raises(ValueError):
        resolve(listing, os.path.join(base, "none.csv"))
    assert snapshot_glob(spark, base) == f"{base}/*.[cC][sS][vV]"
    assert snapshot_glob(spark, os.path.join(base, "a.csv")) == os.path.join(base, "a.csv")


def test_snapshot_falls_back_to_latest_subfolder(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing2")
    _tree(base, direct=False)
    assert [os.path.basename(r.path) for r in resolve(list_tree(spark, base), base).collect()] == ["y.csv"]
    assert snapshot_glob(spark, base) == f"{base}/2025/*.[cC][sS][vV]"


def test_snapshot_without_csv_raises(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing3")
    _write(os.path.join(base, "2025"), "only.json", ["{}"])
    with pytest.raises(ValueError):
        snapshot_glob(spark, base)
    with pytest.raises(ValueError):
        resolve(list_tree(spark, base), base)
    with pytest.raises(ValueError):
        resolve(list_tree(spark, base).filter("length < 0"), base)


def test_run_with_rejects_table(spark, tmp_dir):
    from disclosure.operators import loan_report
    from disclosure.plans import TableSink, run
    from disclosure.schema import LOAN_COLUMNS
    from disclosure.sources.csv import write_loans_csv
    from disclosure.sources.star import loans_from_star
    from tests.conftest import SF001

    base = os.path.join(tmp_dir, "landing")
    loans = loans_from_star(spark, SF001)
    write_loans_csv(loans, os.path.join(base, "good"))
    bad_line = ",".join(["999999", "2021-01-22"] + [""] * (len(LOAN_COLUMNS) - 2))
    _write(os.path.join(base, "good"), "late.csv", [",".join(LOAN_COLUMNS), bad_line])
    scratch = f"{scratch_root(spark)}/disclosure"
    before = subfolders(spark, scratch)
    report = run(spark, os.path.join(base, "good"), sinks=[TableSink("t_run_report")], rejects=TableSink("t_run_rejects"))
    assert report.count() == loans.count() + 1
    assert report.columns == loan_report(loans).columns
    assert [tuple(r) for r in report.filter("LoanNumber = '999999'").select("DateApproved").collect()] == [(None,)]
    assert [r["LoanNumber"] for r in spark.table("t_run_rejects").collect()] == ["999999"]
    assert subfolders(spark, scratch) == before  # the staged parse is gone


def test_snapshot_glob(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing4")
    _tree(base)
    _write(base, ".hidden.csv", ["id", "9"])
    assert snapshot_glob(spark, base) == f"{base}/*.[cC][sS][vV]"
    got = sorted(r["id"] for r in spark.read.option("header", True).csv(snapshot_glob(spark, base)).collect())
    assert got == ["1", "2"]
    nested = os.path.join(tmp_dir, "landing5")
    _tree(nested, direct=False)
    _write(nested, ".hidden.csv", ["id", "9"])  # hidden files do not count as direct CSV files
    assert snapshot_glob(spark, nested) == f"{nested}/2025/*.[cC][sS][vV]"
    odd = os.path.join(tmp_dir, "we{ir}d[1]")
    _write(odd, "x.csv", ["id", "7"])
    assert [r["id"] for r in spark.read.option("header", True).csv(snapshot_glob(spark, odd)).collect()] == ["7"]


def test_bom_file_reads_clean_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bom.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write("id,d,n,x,s\n1,01/22/2021,5,1.5,ok\n")
    row = loan_reader(spark, schema=EDGE_SCHEMA).load(path).first()
    assert tuple(row) == ("1", dt.date(2021, 1, 22), 5, 1.5, "ok")


def test_quoted_line_break_splits_the_record(spark, tmp_dir):
    # multiLine stays off so files split into parallel tasks; a quoted line break then splits
    # the record: the first line keeps the text up to the break, the rest is a rejected row.
    path = _write(tmp_dir, "ml.csv", [EDGE_LINES[0], '11,01/22/2021,1,1,"two', 'lines"', EDGE_LINES[1]])
    parsed = read_loans_with_rejects(spark, path, schema=EDGE_SCHEMA)
    assert sorted((r["id"], r["s"]) for r in parsed.loans.collect()) == [("1", "ok"), ("11", "two"), ('lines"', None)]
    assert [(r["id"], r[CORRUPT_COLUMN]) for r in parsed.rejects.collect()] == [('lines"', 'lines"')]
    parsed.close()


def test_manifest_selects_files_of_one_generation(spark, tmp_dir):
    from disclosure.plans import run
    from disclosure.schema import LOAN_COLUMNS
    from disclosure.sources.listing import MissingFiles

    folder = os.path.join(tmp_dir, "dl")
    header = ",".join(LOAN_COLUMNS)
    row = lambda k: ",".join([k] + [""] * (len(LOAN_COLUMNS) - 1))
    _write(folder, "loans_240930.csv", [header, row("1"), row("2")])
    _write(folder, "loans_250331.csv", [header, row("1"), row("2"), row("3")])
    _write(folder, "odd{name},x.csv", [header, row("9")])
    manifest = spark.createDataFrame([("loans_250331.csv",), ("odd{name},x.csv",)], "name string")
    got = sorted(r["LoanNumber"] for r in run(spark, folder, manifest=manifest).collect())
    assert got == ["1", "2", "3", "9"]
    assert sorted(r["LoanNumber"] for r in run(spark, folder).collect()) == ["1", "1", "2", "2", "3", "9"]
    with pytest.raises(ValueError):
        run(spark, folder, manifest=manifest.limit(0))
    absent = spark.createDataFrame([("loans_250331.csv",), ("gone.csv",)], "name string")
    with pytest.raises(MissingFiles) as info:
        run(spark, folder, manifest=absent)
    assert [r["name"] for r in info.value.names.collect()] == ["gone.csv"]
    with pytest.raises(MissingFiles):
        run(spark, folder, manifest=manifest.union(manifest))


def test_crlf_line_endings(spark, tmp_dir):
    path = os.path.join(tmp_dir, "crlf.csv")
    with open(path, "wb") as fh:
        fh.write(b"id,d,n,x,s\r\n1,01/22/2021,5,1.5,ok\r\n2,02/01/2021,6,2.5,\r\n")
    rows = loan_reader(spark, schema=EDGE_SCHEMA).load(path).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("1", dt.date(2021, 1, 22), 5, 1.5, "ok"),
        ("2", dt.date(2021, 2, 1), 6, 2.5, None),
    ]
