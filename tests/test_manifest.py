"""Catalog manifests, file caps, fetch plans, totals and the failure roll-up."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)

from disclosure.sources import manifest as M


def _doc(resources, success=True):
    return json.dumps({"success": success, "result": {"resources": resources}})


RESOURCES = [
    {"id": "r1", "name": "public_150k_plus.csv", "url": "u1", "size": 100, "format": "CSV"},
    {"id": "r2", "name": None, "url": "u2", "size": None, "format": "csv"},
    {"id": "r3", "name": "dictionary.xlsx", "url": "u3", "size": 5, "format": "XLSX"},
    {"id": "r4", "name": "", "url": "u4", "size": 0, "format": None},
    {"id": "r5", "name": "../../etc/up_to.csv", "url": "u5", "size": 2048, "format": "Csv"},
]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([("ppp", _doc(RESOURCES))], "dataset string, doc string")


def test_manifest_filters_and_names(docs):
    rows = [tuple(r) for r in M.manifest(docs).collect()]
    assert rows == [
        ("ppp", 1, "public_150k_plus.csv", "u1", 100, "CSV"),
        ("ppp", 2, "r2", "u2", None, "CSV"),
        ("ppp", 3, "up_to.csv", "u5", 2048, "CSV"),
    ]
    assert M.manifest(docs, formats=None).count() == 5
    everything = {r["name"]: r["format"] for r in M.manifest(docs, formats=()).collect()}
    assert everything["r4"] == ""
    assert [r["name"] for r in M.manifest(docs, formats=["xlsx"]).collect()] == ["dictionary.xlsx"]


def test_manifest_cap(docs):
    assert [r["pos"] for r in M.manifest(docs, limit=2).collect()] == [1, 2]
    with pytest.raises(ValueError):
        M.require_entries(M.manifest(docs, limit=0))


def test_unsuccessful_lookup_fails(spark):
    bad = spark.createDataFrame([("x", _doc(RESOURCES, success=False))], "dataset string, doc string")
    with pytest.raises(SPARK_ERRORS):
        M.manifest(bad).collect()


def test_fetch_plan_skip_rule(spark, docs):
    entries = M.manifest(docs, formats=None)
    inventory = spark.createDataFrame(
        [("file:/dl/public_150k_plus.csv", 100), ("file:/dl/r2", 7), ("file:/dl/r4", 0), ("file:/dl/up_to.csv", 2047),
         ("file:/dl/20240101/dictionary.xlsx", 5)],
        "path string, length bigint",
    )
    todo = sorted(r["name"] for r in M.fetch_plan(entries, inventory, "file:/dl").collect())
    # same name and size -> skipped; null size, size 0 and a size mismatch are fetched again
    assert todo == ["dictionary.xlsx", "r2", "r4", "up_to.csv"]
    assert M.fetch_plan(entries, inventory, "file:/dl", overwrite=True).count() == 5


def test_totals(docs):
    row = M.totals(M.manifest(docs)).first()
    assert (row["n_files"], row["total_bytes"], row["total_display"]) == (3, 2148, "2.1 KB")


def test_failure_roll_up(spark):
    outcomes = spark.createDataFrame([("b.csv", "timeout"), ("a.csv", "HTTP 500"), ("c.csv", None)], "name string, error string")
    s = M.failure_summary(outcomes).first()
    assert (s["n_failed"], s["n_total"]) == (2, 3)
    with pytest.raises(M.FetchFailed) as info:
        M.raise_on_failures(outcomes)
    assert str(info.value).startswith("Failed to download 2 of 3 file(s)")
    assert sorted(r["name"] for r in info.value.failures.collect()) == ["a.csv", "b.csv"]
    M.raise_on_failures(outcomes.filter("error is null"))


def test_duplicate_names(spark):
    docs = spark.createDataFrame(
        [("d", _doc([{"id": "1", "name": "a/x.csv", "url": "u", "size": 1, "format": "CSV"},
                     {"id": "2", "name": "b/x.csv", "url": "v", "size": 1, "format": "CSV"}]))],
        "dataset string, doc string",
    )
    assert [tuple(r) for r in M.duplicate_names(M.manifest(docs)).collect()] == [("x.csv", 2)]


def test_incomplete_entries_fail(spark):
    no_url = [{"id": "1", "name": "a.csv", "url": None, "size": 1, "format": "CSV"}]
    no_name = [{"id": None, "name": "", "url": "u", "size": 1, "format": "CSV"}]
    skipped = [{"id": "1", "name": "a.xlsx", "url": None, "size": 1, "format": "XLSX"}]
    schema = "dataset string, doc string"
    for bad in (no_url, no_name):
        with pytest.raises(SPARK_ERRORS):
            M.manifest(spark.createDataFrame([("d", _doc(bad))], schema)).collect()
    # entries left out by the format filter are never checked
    assert M.manifest(spark.createDataFrame([("d", _doc(skipped))], schema)).count() == 0
    no_list = json.dumps({"success": True, "result": {}})
    with pytest.raises(SPARK_ERRORS):
        M.manifest(spark.createDataFrame([("d", no_list)], schema)).collect()


def test_failure_listing_needs_no_range_sort(spark):
    from disclosure.plans.checks import plan_text

    # a third of the failures share one name
    name = F.when(F.col("id") % 3 == 0, F.lit("a_hot.csv")).otherwise(F.concat(F.lit("f"), F.col("id").cast("string")))
    outcomes = spark.range(999).select(name.alias("name"), F.lit("boom").alias("error"))
    assert "rangepartitioning" not in plan_text(M.failed_entries(outcomes), "simple")
    with pytest.raises(M.FetchFailed) as info:
        M.raise_on_failures(outcomes)
    assert str(info.value).startswith("Failed to download 999 of 999 file(s)")
    assert info.value.failures.count() == 999
