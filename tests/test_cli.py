"""The command-line job end to end on a CSV snapshot."""

from __future__ import annotations

import os

from disclosure.__main__ import main
from disclosure.sources.csv import write_loans_csv
from disclosure.sources.star import loans_from_star
from tests.conftest import SF001


def test_cli_publishes_tables(spark, tmp_dir, capsys):
    base = os.path.join(tmp_dir, "landing")
    loans = loans_from_star(spark, SF001)
    write_loans_csv(loans, os.path.join(base, "20240101"))
    n = loans.count()
    assert main(["--source", base, "--table", "cli_report", "--table", "cli_store:clear_and_append",
                 "--rejects", "cli_rejects", "--option", "compression=snappy"], spark=spark) == 0
    assert spark.table("cli_report").count() == n
    assert spark.table("cli_store").count() == n
    assert spark.table("cli_rejects").count() == 0
    store = os.path.join(tmp_dir, "store")
    assert main(["--source", base, "--table", "cli_report2", "--connector", "parquet",
                 "--connector-option", f"path={store}", "--connector-partitions", "2"], spark=spark) == 0
    assert spark.read.parquet(store).count() == n
    assert main(["--source", base, "--row-limit", "10"], spark=spark) == 0
    assert "10 report rows" in capsys.readouterr().out
    assert main(["--source", base, "--explain", "--table", "cli_never_written"], spark=spark) == 0
    plan = capsys.readouterr().out
    assert "Scan csv" in plan and "Exchange" not in plan and "Sort" not in plan
    assert not spark.catalog.tableExists("cli_never_written")


def test_cli_reads_the_files_of_a_catalog(spark, tmp_dir):
    import json

    folder = os.path.join(tmp_dir, "dl")
    loans = loans_from_star(spark, SF001)
    write_loans_csv(loans, folder)
    parts = sorted(f for f in os.listdir(folder) if f.endswith(".csv"))
    with open(os.path.join(folder, "stale.csv"), "w") as fh:
        fh.write("not,the,columns\n")
    resources = [{"id": str(i), "name": f, "url": "u", "size": 1, "format": "CSV"} for i, f in enumerate(parts)]
    catalog = os.path.join(tmp_dir, "catalog.json")
    with open(catalog, "w") as fh:
        json.dump({"success": True, "result": {"resources": resources}}, fh)
    assert main(["--catalog", catalog, "--source", folder, "--table", "cli_dl_report"], spark=spark) == 0
    assert spark.table("cli_dl_report").count() == loans.count()


def test_cli_newest_files_cells_journal_and_index(spark, tmp_dir):
    from disclosure.operators.search_index import candidate_files, search_table
    from disclosure.schema import LOAN_COLUMNS

    def row(number, name, date):
        cells = dict.fromkeys(LOAN_COLUMNS, "") | {"LoanNumber": number, "BorrowerName": name, "DateApproved": date}
        return ",".join(cells[c] for c in LOAN_COLUMNS)

    base = os.path.join(tmp_dir, "landing", "20240101")
    os.makedirs(base)
    for date, names in (("240101", ["OLD NAME"]), ("240930", ["NEW NAME", "SECOND"])):
        with open(os.path.join(base, f"public_{date}.csv"), "w") as fh:
            body = [row(str(i), n, "01/02/2021" if i else "2021-01-02") for i, n in enumerate(names)]
            fh.write("\n".join([",".join(LOAN_COLUMNS), *body]) + "\n")
    given = ["--source", os.path.dirname(base), "--ledger", os.path.join(tmp_dir, "ledger"), "--journal", os.path.join(tmp_dir, "journal")]
    both = ["--table", "cli_all", "--reject-cells", "cli_all_cells"]
    assert main([*given, *both], spark=spark) == 0
    assert spark.table("cli_all").count() == 3
    newest = ["--source", base, "--newest-only", "--table", "cli_newest", "--index", "--reject-cells", "cli_cells"]
    assert main(newest, spark=spark) == 0
    assert sorted(r.BorrowerName for r in spark.table("cli_newest").collect()) == ["NEW NAME", "SECOND"]
    cells = spark.table("cli_cells").collect()
    assert [(r.LoanNumber, r.column, r.cell, r.row_in_block) for r in cells] == [("0", "DateApproved", "2021-01-02", 1)] * len(cells)
    assert {os.path.basename(r.file) for r in cells} <= {"public_240930.csv", "public_240101.csv"} and cells
    assert candidate_files(spark, "cli_newest", "new name") is not None
    assert search_table(spark, "cli_newest", "new name").count() == 1
