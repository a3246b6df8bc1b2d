"""Steps whose share per task, or cost per row, must not grow with the tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from disclosure.operators import search_index
from disclosure.operators.report import loan_report
from disclosure.plans.job import ConnectorSink
from disclosure.schema import LOAN_SCHEMA
from disclosure.sinks import tables as T
from disclosure.sources.csv import check_headers, header_lines
from tests.conftest import SF001


@pytest.fixture()
def small_tasks(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    yield
    spark.conf.unset(key)


def _many(spark):
    return spark.range(0, 40000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))


def _files(folder):
    return [n for n in os.listdir(folder) if n.endswith(".parquet")]


def test_append_splits_tasks_that_would_read_too_much(spark, tmp_dir, small_tasks):
    T.append_table(_many(spark), "t_growth", path=f"{tmp_dir}/t", partitions=2)
    assert len(_files(f"{tmp_dir}/t")) > 8
    assert spark.table("t_growth").agg(F.count("id"), F.sum("id")).first()[:] == (40000, 40000 * 39999 // 2)


def test_connector_append_splits_tasks_that_would_read_too_much(spark, tmp_dir, small_tasks):
    ConnectorSink("parquet", {"path": f"{tmp_dir}/c"}, partitions=2)(_many(spark))
    assert len(_files(f"{tmp_dir}/c")) > 8
    assert spark.read.parquet(f"{tmp_dir}/c").select("id").distinct().count() == 40000


def test_publications_have_more_files_for_more_loans(spark, monkeypatch):
    monkeypatch.setattr(E, "FILE_LOANS", 150)
    found = E.q_newest_generation(spark, SF001)
    assert len({f.rsplit("/", 1)[-1] for f in found.inputFiles()}) == 10
    assert found.select("LoanNumber").distinct().count() == found.count() == 1500


def test_gate_passes_on_one_line_a_file(spark, tmp_dir):
    starts = {"a.csv": "\n \n \n", "b.csv": "﻿", "c.csv": "﻿ \n\x1c\n", "d.csv": ""}
    for name, start in starts.items():
        with open(f"{tmp_dir}/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(start + "x,y\n" + "1,2\n" * 5000)
    with open(f"{tmp_dir}/e.csv", "w") as f:
        f.write("\n \n")
    lines = header_lines(spark, [tmp_dir]).collect()
    assert sorted(r.file.rsplit("/", 1)[-1] for r in lines) == sorted(starts)
    assert {r.value.lstrip("﻿") for r in lines} == {"x,y"}
    check_headers(spark, [tmp_dir], ["X", "Y"])


@pytest.mark.parametrize("before,after", [("65535", "8000"), ("4000", "4000")])
def test_report_is_compiled_in_any_session(spark, before, after):
    plain = spark.newSession()
    plain.conf.set("spark.sql.codegen.hugeMethodLimit", before)
    loan_report(plain.createDataFrame([], LOAN_SCHEMA))
    assert plain.conf.get("spark.sql.codegen.hugeMethodLimit") == after


def test_index_holds_the_trigrams_of_every_file(spark):
    texts = ["ab", "abc", "a\U0001f600bc\n d", "", None, "größe größe"]
    rows = spark.createDataFrame(list(enumerate(texts)), "LoanNumber int, searchtext string")
    T.overwrite_table(rows.repartition(3, "LoanNumber"), "t_growth_index")
    search_index.build_index(spark, "t_growth_index")
    _, location = search_index._place(spark, "t_growth_index")
    found = {(r.file, r.gram) for r in spark.read.parquet(f"{location}/{search_index.INDEX_FOLDER}").collect()}
    held = spark.table("t_growth_index").select("searchtext", F.col("_metadata.file_path").alias("file")).collect()
    want = {(r.file, t[i : i + 3]) for r in held for t in [r.searchtext or ""] for i in range(len(t) - 2)}
    assert found == want | {(r.file, "") for r in held}


def test_index_does_not_carry_paths_with_every_trigram(spark):
    rows = spark.createDataFrame([("a b c",)], "t string").withColumn("file", F.lit("some/path"))
    assert search_index.file_grams(rows).columns == ["hash", "gram"]
