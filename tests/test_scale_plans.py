"""Plan shape under scale conditions: large dimensions, a hot key, many input splits."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from disclosure.operators import loan_report
from disclosure.plans.checks import plan_text
from disclosure.sources.star import loans_from_star
from tests.conftest import SF01


def _skewed_star(spark, folder):
    """The sf0.01 star with one customer owning a third of all orders."""
    for name in ("customer", "nation", "region", "supplier", "lineitem"):
        os.symlink(f"{SF01}/{name}.parquet", os.path.join(folder, f"{name}.parquet"))
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", hot).repartition(8).write.parquet(os.path.join(folder, "orders.parquet"))


def test_hot_customer_is_split(spark, tmp_dir):
    _skewed_star(spark, tmp_dir)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        report = loan_report(loans_from_star(spark, tmp_dir))
        assert report.count() == 15000
        report.collect()
        final = plan_text(report, "simple")
        assert "SortMergeJoin" in final and "skew=true" in final  # the hot customer's partition was split
        assert "BroadcastExchange" not in final  # nothing is broadcast without a size check
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_suppliers_are_all_read_and_no_order_is_lost(spark, tmp_dir):
    for name in ("customer", "nation", "region", "supplier", "orders"):
        os.symlink(f"{SF01}/{name}.parquet", os.path.join(tmp_dir, f"{name}.parquet"))
    lines = spark.read.parquet(f"{SF01}/lineitem.parquet")
    lines.filter("l_orderkey % 4 > 0").write.parquet(os.path.join(tmp_dir, "lineitem.parquet"))
    loans = loans_from_star(spark, tmp_dir)
    assert loans.count() == 15000
    assert loans.filter("LoanNumber % 4 = 0 AND OriginatingLender IS NOT NULL").count() == 0
    full = loans_from_star(spark, SF01).select("OriginatingLender").distinct().count()
    assert full > 0.9 * spark.read.parquet(f"{SF01}/supplier.parquet").count()


def test_plan_checks_see_exchanges_and_python(spark):
    from disclosure.plans.checks import exchanges, python_nodes

    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert exchanges(df) >= 1
    assert python_nodes(df) == []
    mapped = spark.range(10).mapInPandas(lambda it: it, "id long")
    assert python_nodes(mapped) == ["MapInPandas"]


def test_session_settings_are_real_runtime_keys(spark):
    from disclosure.session import SESSION_CONF

    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql."):
            assert spark.conf.isModifiable(key), key
            assert spark.conf.get(key) == value, key  # build_session applied it
