"""Incremental publishing: every landed file exactly once across runs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from disclosure.sources.csv import write_loans_csv
from disclosure.sources.star import loans_from_star
from disclosure.streaming import publish_available
from tests.conftest import SF001


def test_incremental_publish_is_exactly_once(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "out", "ckpt"))
    loans = loans_from_star(spark, SF001).cache()
    total = loans.count()
    parts = [loans.filter(F.col("ProcessingMethod") == m) for m in ("PPP", "PPS")]
    rest = loans.filter(~F.col("ProcessingMethod").isin("PPP", "PPS") | F.col("ProcessingMethod").isNull())

    write_loans_csv(parts[0], landing)
    n1 = publish_available(spark, landing, out, ckpt).count()
    assert n1 == parts[0].count()
    # nothing new landed: a re-run adds nothing
    assert publish_available(spark, landing, out, ckpt).count() == n1
    write_loans_csv(parts[1], landing, mode="append")
    write_loans_csv(rest, landing, mode="append")
    report = publish_available(spark, landing, out, ckpt, max_files_per_trigger=2)
    assert report.count() == total
    assert report.select("LoanNumber").distinct().count() == total
    loans.unpersist()


def test_checkpoint_belongs_to_the_output(spark, tmp_dir):
    landing, out = os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "o")
    loans = loans_from_star(spark, SF001)
    write_loans_csv(loans.filter("LoanNumber % 2 = 0"), landing)
    n = publish_available(spark, landing, out).count()
    assert os.path.isdir(out + "__checkpoint")
    # a later run of another session finds the same checkpoint and adds only the new files
    write_loans_csv(loans.filter("LoanNumber % 2 = 1"), landing, mode="append")
    assert publish_available(spark.newSession(), landing, out).count() == loans.count() > n
    with pytest.raises(ValueError):
        publish_available(spark, landing, out, os.path.join(tmp_dir, "fresh"))
    assert spark.read.parquet(out).count() == loans.count()
    # nor does the checkpoint of one output serve another
    with pytest.raises(ValueError, match="belongs to the output"):
        publish_available(spark, landing, os.path.join(tmp_dir, "other"), out + "__checkpoint")
    assert not os.path.exists(os.path.join(tmp_dir, "other"))
