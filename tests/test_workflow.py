"""A user's whole workflow: catalog -> plan -> refresh two targets -> search -> detail."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from disclosure.operators import detail, search_cards
from disclosure.plans import TableSink, run
from disclosure.sources import manifest as M
from disclosure.sources.csv import write_loans_csv
from disclosure.sources.listing import list_tree
from disclosure.sources.star import loans_from_star
from tests.conftest import SF001


def test_catalog_to_detail_page(spark, tmp_dir):
    # the remote side: the loans as CSV files, and a catalog document listing them (plus a non-CSV entry)
    remote = os.path.join(tmp_dir, "remote")
    loans = loans_from_star(spark, SF001)
    write_loans_csv(loans, remote)
    parts = sorted(f for f in os.listdir(remote) if f.endswith(".csv"))
    resources = [{"id": f"r{i}", "name": f"public_part_{i}.csv", "url": f"file://{remote}/{f}",
                  "size": os.path.getsize(os.path.join(remote, f)), "format": "CSV"} for i, f in enumerate(parts)]
    resources.append({"id": "dict", "name": "dictionary.xlsx", "url": "file:///nonexistent", "size": 1, "format": "XLSX"})
    catalog_file = os.path.join(tmp_dir, "catalog.json")
    with open(catalog_file, "w") as fh:
        json.dump({"success": True, "result": {"resources": resources}}, fh)

    # the catalog's CSV files, put into a folder that also holds an older generation
    folder = os.path.join(tmp_dir, "downloads")
    write_loans_csv(loans.filter(F.col("ProcessingMethod") == "PPP"), os.path.join(tmp_dir, "old"))
    os.makedirs(folder)
    for f in os.listdir(os.path.join(tmp_dir, "old")):
        if f.endswith(".csv"):
            os.link(os.path.join(tmp_dir, "old", f), os.path.join(folder, "stale_" + f))
    catalog = spark.read.text(catalog_file, wholetext=True).select(F.lit("d").alias("dataset"), F.col("value").alias("doc"))
    entries = M.manifest(catalog)
    assert M.fetch_plan(entries, list_tree(spark, folder), folder).count() == len(parts)
    for r in resources[:-1]:
        os.link(r["url"].removeprefix("file://"), os.path.join(folder, r["name"]))
    assert M.fetch_plan(entries, list_tree(spark, folder), folder).count() == 0

    # refresh: the catalog's files only (the stale generation is not loaded), two targets, rejects kept
    report = run(
        spark,
        folder,
        sinks=[TableSink("wf_report", sort_within=("LoanNumber",)), TableSink("wf_store", mode="clear_and_append")],
        rejects=TableSink("wf_rejects"),
        manifest=entries,
    )
    n = loans.count()
    assert report.count() == n
    assert spark.table("wf_store").count() == n and spark.table("wf_rejects").count() == 0

    # consumption: search box, then the detail page of the first hit
    cards = search_cards(spark.table("wf_report"), "  SUPPLIER#000000003   ")
    first = cards.orderBy("LoanNumber").first()
    assert first is not None and cards.count() > 0
    page = detail(spark.table("wf_report"), first["LoanNumber"]).collect()
    assert len(page) == 1 and page[0]["Lender_Display"].startswith("Supplier#00000000")
