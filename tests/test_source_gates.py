"""Header gate, rejected cells, generations, folder ledger, distributed limit and names."""

from __future__ import annotations

import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from disclosure.plans import run
from disclosure.plans.checks import plan_text
from disclosure.schema import LOAN_COLUMNS
from disclosure.sources import listing
from disclosure.sources import names as N
from disclosure.sources.csv import HeaderMismatch, check_headers, limit_rows, read_loans, read_loans_with_rejects

SCHEMA = StructType([StructField("id", StringType()), StructField("d", DateType()), StructField("n", IntegerType()), StructField("s", StringType())])


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join(lines) + "\n")
    return path


# ---------------------------------------------------------------- header gate


def test_count_over_a_reordered_file_raises_and_names_the_files(spark, tmp_dir):
    good = _write(tmp_dir, "good.csv", ["id,d,n,s", "1,01/02/2021,5,x"])
    bad = [_write(tmp_dir, f"bad {i}.csv", ["id,n,d,s", "1,5,01/02/2021,x"]) for i in range(2)]
    with pytest.raises(HeaderMismatch) as info:
        read_loans(spark, [good, *bad], schema=SCHEMA).count()
    message = str(info.value)
    assert "good.csv" not in message and "bad%200.csv" in message and "bad%201.csv" in message
    assert info.value.files.count() == 2
    with pytest.raises(HeaderMismatch):
        read_loans_with_rejects(spark, [f"{tmp_dir}/*.csv"], schema=SCHEMA)
    assert read_loans(spark, [good, *bad], schema=SCHEMA, enforce_schema=True).count() == 3


def test_headers_that_are_the_schemas(spark, tmp_dir):
    _write(tmp_dir, "case.csv", ["ID,D,N,S", "1,,,"])
    _write(tmp_dir, "quoted.csv", ['"id","d","n","s"', "1,,,"])
    _write(tmp_dir, "bom.csv", ["﻿id,d,n,s", "1,,,"])
    _write(tmp_dir, "blank.csv", ["", "id,d,n,s", "1,,,"])
    open(os.path.join(tmp_dir, "empty.csv"), "w").close()
    check_headers(spark, [tmp_dir], SCHEMA.names)
    assert read_loans(spark, f"{tmp_dir}/case.csv", schema=SCHEMA).count() == 1
    for name, line in (("short.csv", "id,d,n"), ("long.csv", "id,d,n,s,t"), ("data.csv", "1,2,3,4")):
        with pytest.raises(HeaderMismatch, match=name):
            check_headers(spark, [_write(tmp_dir, name, [line, "1,,,"])], SCHEMA.names)


def test_only_first_blocks_give_a_line(spark, tmp_dir):
    path = _write(tmp_dir, "large.csv", ["id,d,n,s", *[f"{i},01/02/2021,{i},text" for i in range(20_000)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        check_headers(spark, [path], SCHEMA.names)
        assert read_loans(spark, path, schema=SCHEMA).count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# ---------------------------------------------------------------- rejected cells


def test_reject_cells_name_line_column_and_text(spark, tmp_dir):
    lines = ["id,d,n,s", "1,01/02/2021,5,ok", "2,2021-01-02,5,date", "3,01/02/2021,5.0,int", '4,x,y,"a, ""b"""', "5,,,", "6,01/02/2021", "7,,z"]
    path = _write(tmp_dir, "cells.csv", lines)
    parsed = read_loans_with_rejects(spark, path, schema=SCHEMA)
    rows = parsed.cells(keys=("id",)).collect()
    got = {(r.id, r.column, r.cell, r.row_in_block, r.problem) for r in rows}
    date, number = "not a date (MM/dd/yyyy)", "not of type int"
    assert got == {
        ("2", "d", "2021-01-02", 2, date),
        ("3", "n", "5.0", 3, number),
        ("4", "d", "x", 4, date),
        ("4", "n", "y", 4, number),
        ("6", None, None, 6, "wrong number of cells"),
        ("7", None, None, 7, "wrong number of cells"),
        ("7", "n", "z", 7, number),
    }
    assert all(r.file.endswith("cells.csv") and r.block_start == 0 for r in rows)
    assert parsed.loans.columns == SCHEMA.names and parsed.loans.count() == 7 and parsed.rejects.count() == 5
    parsed.close()


def test_reject_cells_in_later_blocks_are_placed(spark, tmp_dir):
    lines = [f"{i:05d},{'bad' if i % 997 == 0 else '01/02/2021'},{i},text" for i in range(5000)]
    path = _write(tmp_dir, "blocks.csv", ["id,d,n,s", *lines])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        cells = read_loans_with_rejects(spark, path, schema=SCHEMA).cells(keys=("id",)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.id for r in cells) == [f"{i:05d}" for i in range(0, 5000, 997)]
    assert len({r.block_start for r in cells}) > 1
    text = open(path, "rb").read()
    for r in cells:  # the block's records begin after the first line break at or after its start
        at = r.block_start if r.block_start == 0 else text.index(b"\n", r.block_start - 1) + 1
        records = text[at:].split(b"\n")[1 if r.block_start == 0 else 0 :]
        assert records[r.row_in_block - 1].startswith(r.id.encode())


# ---------------------------------------------------------------- generations and listings


def test_newest_generation_of_every_stem(spark, tmp_dir):
    names = ["a_240101.csv", "a_240930.csv", "a_20231231.csv", "b-230101.csv", "b.csv", "c.csv", "public_1_240101.csv", "public_2_240101.CSV", "x_12.csv"]
    for name in names:
        _write(tmp_dir, name, ["id,d,n,s", f"{name},,,"])
    found = listing.newest_generation(listing.list_tree(spark, tmp_dir))
    got = sorted(os.path.basename(r.path) for r in found.collect())
    assert got == ["a_240930.csv", "b-230101.csv", "c.csv", "public_1_240101.csv", "public_2_240101.CSV", "x_12.csv"]
    loans = read_loans(spark, listing.newest_files(spark, tmp_dir), schema=SCHEMA)
    assert sorted(r.id for r in loans.collect()) == got


def test_run_with_newest_only(spark, tmp_dir):
    for date, rows in (("240101", ["1", "2"]), ("240930", ["1", "2", "3"])):
        body = [",".join([r] + [""] * (len(LOAN_COLUMNS) - 1)) for r in rows]
        _write(tmp_dir, f"public_{date}.csv", [",".join(LOAN_COLUMNS), *body])
    assert run(spark, tmp_dir).count() == 5
    assert sorted(r.LoanNumber for r in run(spark, tmp_dir, newest_only=True).select("LoanNumber").collect()) == ["1", "2", "3"]


def test_ledger_lists_only_folders_that_changed(spark, tmp_dir, monkeypatch):
    base, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    now = time.time()
    for i in range(12):
        path = _write(os.path.join(base, f"2024{i:02d}"), "x.csv", ["id", "1"])
        os.utime(path, (now - 5000 + i, now - 5000 + i))
    seen = []
    real = listing._folder_facts

    def facts(rel):
        out = real(rel)
        seen.append(sorted(r.folder for r in out.collect()))
        return out

    monkeypatch.setattr(listing, "_folder_facts", facts)
    assert listing.snapshot_glob(spark, base, ledger).endswith("/202411/*.[cC][sS][vV]")
    assert len(seen.pop()) == 12
    assert listing.snapshot_glob(spark, base, ledger).endswith("/202411/*.[cC][sS][vV]") and not seen  # one level only
    _write(os.path.join(base, "202412"), "y.csv", ["id", "1"])
    assert listing.snapshot_glob(spark, base, ledger).endswith("/202412/*.[cC][sS][vV]")
    assert seen.pop() == ["202412"]
    os.makedirs(os.path.join(base, "empty"))
    assert listing.snapshot_glob(spark, base, ledger).endswith("/202412/*.[cC][sS][vV]")
    assert listing.snapshot_glob(spark, base) == listing.snapshot_glob(spark, base, ledger)
    assert len(os.listdir(ledger)) <= 2
    _write(base, "direct.csv", ["id", "1"])
    assert listing.snapshot_glob(spark, base, ledger) == f"{base}/*.[cC][sS][vV]"


# ---------------------------------------------------------------- limit and names


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500, 501, 999, 1000, 5000])
def test_limit_is_exact_and_deals_no_rows_to_one_task(spark, n):
    rows = spark.range(1000).repartition(6).filter("id % 2 = 0").withColumn("_x", F.lit("own"))
    got = limit_rows(rows, n)
    assert got.columns == ["id", "_x"]
    ids = [r.id for r in got.collect()]
    assert len(ids) == len(set(ids)) == min(n, 500) and all(i % 2 == 0 for i in ids)
    assert "SinglePartition" not in plan_text(got) if n else True


def test_joined_names_are_sorted_whatever_their_number(spark):
    rng = random.Random(3)
    names = [f"file {rng.randrange(10**6)}.csv" for _ in range(5000)] + ["hot.csv"] * 3000
    rng.shuffle(names)
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string").repartition(7)
    assert N.joined_names(df, "name").split(", ") == sorted(names)
    assert N.joined_names(df.filter("name = 'none'"), "name") == ""
