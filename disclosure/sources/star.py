"""Loan records derived from the TPC-H-like star schema of the test tables.

One loan per order: ``orders`` joined to ``customer``, its ``nation`` and ``region``, and the
supplier of the order's lines with the smallest key (an order without lines, or with an unknown
supplier, has none). The test tables have no nulls, so nulls, blanks, placeholders and odd
values are injected by ``k % n`` rules on the order key ``k``. Every one of the 53 source columns
is filled, in the source layout, so the result can be written as a source CSV file or fed to the
report directly.

Plan: ``orders`` (the fact side, streamed) joins ``customer`` on ``o_custkey``: Spark
broadcasts ``customer`` when its file statistics are below the broadcast threshold and
otherwise shuffles both sides by the key (AQE splits a hot customer). ``nation`` and
``region`` are joined next; their tiny files are broadcast by the same size check. ``lineitem``
is reduced to one supplier key per order (two columns read, map-side partial minimum) and joined
on the order key; the supplier's name comes last, again broadcast by file size only. All joins
after the first are left joins in the fact's order, so no order is lost and no build side can
be the fact table. Columns nobody asks for prune their joins' columns, not the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.schema import LOAN_FIELDS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(k: Column, n: int) -> Column:
    return k % n == 0


def _null() -> Column:
    return F.lit(None)


def loans_from_star(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    """The 53-column loan source built from the star schema under ``sf_dir``.

    ``read`` opens a table; a caller may pass one that repartitions small files.
    """
    orders = read(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("l_suppkey"))
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")

    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .join(supplier, lines.l_suppkey == supplier.s_suppkey, "left")
    )

    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice")
    custkey_text = F.col("o_custkey").cast("string")

    values: dict[str, Column] = {
        "LoanNumber": k.cast("string"),
        "DateApproved": F.when(~_every(k, 53), day),
        "SBAOfficeCode": F.lpad((F.col("o_custkey") % 1000).cast("string"), 4, "0"),
        "ProcessingMethod": F.when(F.col("o_orderstatus") == "F", F.lit("PPP")).when(
            F.col("o_orderstatus") == "O", F.lit("PPS")
        ),
        "BorrowerName": F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")),
        "BorrowerCity": F.when(k % 7 == 0, F.lit("N/A"))
        .when(k % 7 == 1, _null())
        .when(k % 7 == 2, F.lit(""))
        .otherwise(F.col("n_name")),
        "BorrowerState": F.when(k % 4 == 0, F.lit(" ")).when(k % 4 == 1, _null()).otherwise(F.col("r_name")),
        "BorrowerZip": F.when(k % 2 != 0, F.lpad(custkey_text, 5, "9")),
        "LoanStatusDate": day,
        "LoanStatus": F.when(k % 11 == 0, _null())
        .when(k % 11 == 1, F.lit("Exemption 4"))
        .when(k % 11 == 2, F.lit("Charged Off"))
        .otherwise(F.lit("Paid in Full")),
        "Term": (F.lit(24) + k % 37).cast("int"),
        "SBAGuarantyPercentage": F.lit(100.0),
        "InitialApprovalAmount": price,
        "CurrentApprovalAmount": F.when(_every(k, 17), _null()).when(_every(k, 19), -price).otherwise(price),
        "UndisbursedAmount": F.when(k % 4 == 0, F.lit(0.0)).when(k % 4 == 1, _null()).otherwise(price / 10.0),
        "ServicingLenderName": F.when(~_every(k, 16), F.concat(F.col("s_name"), F.lit(" Svc"))),
        "RuralUrbanIndicator": F.when(k % 4 == 0, F.lit("U")).when(k % 4 == 1, F.lit("R")).when(k % 4 == 2, F.lit("u")),
        "BusinessAgeDescription": F.col("o_orderpriority"),
        "ProjectCity": F.when(k % 6 == 0, F.lit(" n/a "))
        .when(k % 6 == 1, F.lit("Na"))
        .when(k % 6 == 2, F.lit("   "))
        .when(k % 6 == 3, _null())
        .otherwise(F.concat(F.lit(" "), F.col("n_name"))),
        "ProjectState": F.when(k % 5 == 0, F.lit("NA")).when(k % 5 == 1, _null()).otherwise(F.col("r_name")),
        "ProjectZip": F.when(k % 9 == 0, F.lit("N/A"))
        .when(k % 9 == 1, F.lit("  "))
        .when(k % 9 == 2, F.lit("1234"))
        .when(k % 9 == 3, _null())
        .otherwise(F.concat(F.lit(" "), F.lpad(custkey_text, 5, "0"), F.lit("-2734"))),
        "JobsReported": F.when(~_every(k, 13), (k % 500).cast("int")),
        "NAICSCode": F.when(~_every(k, 10), (F.lit(100000) + F.col("o_custkey")).cast("string")),
        "UTILITIES_PROCEED": F.when(_every(k, 5), k.cast("double") + F.lit(0.5)),
        "PAYROLL_PROCEED": F.when(_every(k, 2), price * F.lit(0.75)),
        "BusinessType": F.concat(F.col("c_mktsegment"), F.lit("  Co ")),
        "OriginatingLender": F.when(~_every(k, 8), F.col("s_name")),
        "ForgivenessAmount": F.when(~_every(k, 3), price),
        "ForgivenessDate": F.when(~_every(k, 3), day),
    }
    return joined.select(
        *[values.get(name, _null()).cast(dtype).alias(name) for name, dtype in LOAN_FIELDS]
    )
