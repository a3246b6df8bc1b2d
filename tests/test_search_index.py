"""Searches through the trigram index give what the plain search gives, from fewer files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from disclosure.operators.search import search
from disclosure.operators.search_index import build_index, candidate_files, search_table, trigrams
from disclosure.sinks import tables as T


@pytest.fixture(scope="module")
def indexed(spark):
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("LoanNumber"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("lender "), (F.col("id") / 100).cast("int"), F.lit(" größe*50% no "), F.col("id"))
        ).alias("searchtext"),
    )
    T.overwrite_table(rows.repartitionByRange(6, F.col("LoanNumber").cast("int")), "t_indexed")
    build_index(spark, "t_indexed")
    return "t_indexed"


QUERIES = ["lender 3", "LENDER  3 ", "größe", "no 123", "er", "", None, "lender 3*no 31?", "größe~*50", "*", "a", "zzz", "50%", "r 4*r 9"]


@pytest.mark.parametrize("q", QUERIES)
def test_same_rows_as_the_plain_search(spark, indexed, q):
    plain = sorted(r.LoanNumber for r in search(spark.table(indexed), q).collect())
    assert sorted(r.LoanNumber for r in search_table(spark, indexed, q).collect()) == plain


def test_selective_needles_read_few_files(spark, indexed):
    files = spark.table(indexed).inputFiles()
    assert len(files) == 6
    assert len(search_table(spark, indexed, "no 123").inputFiles()) < 6
    assert len(candidate_files(spark, indexed, "lender 3")) == 1
    assert candidate_files(spark, indexed, "zzz") == [] and candidate_files(spark, indexed, "er") is None
    assert trigrams("ab*cde~?f?g") == ["cde", "de?", "e?f"]


def test_appended_files_are_read_and_a_refresh_drops_the_index(spark, nine_rows):
    T.overwrite_table(nine_rows, "t_index_append")
    build_index(spark, "t_index_append")
    T.append_table(nine_rows.withColumn("searchtext", F.lit("appended later")), "t_index_append")
    assert search_table(spark, "t_index_append", "appended").count() == 9
    assert search_table(spark, "t_index_append", "row 3").count() == 1
    T.overwrite_table(nine_rows, "t_index_append")
    assert candidate_files(spark, "t_index_append", "row 3") is None
    assert search_table(spark, "t_index_append", "row 3").count() == 1


@pytest.fixture()
def nine_rows(spark):
    return spark.range(9).select(F.col("id").cast("string").alias("LoanNumber"), F.concat(F.lit("row "), "id").alias("searchtext"))
