"""The report projection: raw loan records -> the 49 published columns.

The whole report is ONE ``select`` of built-in expressions over the source columns. It is a
narrow, row-wise map: no shuffle, no Python, and Catalyst prunes the scan to the 31 source
columns the expressions read. At any data size it runs as a single map stage fused into the
scan's whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosure.functions import display as D
from disclosure.schema import PROCEEDS, REPORT_COLUMNS
from disclosure.session import compile_in_pieces


def report_columns() -> list[Column]:
    """The 49 report columns, in published order, as expressions over the source columns."""
    derived: dict[str, Column] = {
        "Recipient_Display": D.recipient("BorrowerName"),
        "Location_Display": D.location("ProjectCity", "BorrowerCity", "ProjectState", "BorrowerState"),
        "AreaType_Display": D.area_type("RuralUrbanIndicator"),
        "Lender_Display": D.lender("OriginatingLender", "ServicingLenderName"),
        "BusinessAge_Display": F.col("BusinessAgeDescription"),
        "Industry_Display": D.as_text("NAICSCode"),
        "JobsReported_Display": D.as_text("JobsReported"),
        "BusinessType_Display": D.business_type("BusinessType"),
        "LoanAmount_Display": D.currency("CurrentApprovalAmount"),
        "ForgivenessAmount_Display": D.currency_or_null("ForgivenessAmount"),
        "DateApproved_Display": D.date_with_round("DateApproved", "ProcessingMethod"),
        "LoanStatus_Display": D.loan_status("ForgivenessDate", "UndisbursedAmount", "LoanStatus"),
        "searchtext": D.search_text(
            "BorrowerName",
            "OriginatingLender",
            "ServicingLenderName",
            "ProjectZip",
            "BorrowerZip",
            "BusinessType",
            "ProjectCity",
            "BorrowerCity",
            "ProjectState",
            "BorrowerState",
            "NAICSCode",
        ),
    }
    for source, display in PROCEEDS:
        derived[display] = D.currency(source)
    return [derived[name].alias(name) if name in derived else F.col(name) for name in REPORT_COLUMNS]


def loan_report(loans: DataFrame) -> DataFrame:
    """Project raw loan records (the 53-column source layout) to the published report."""
    compile_in_pieces(loans.sparkSession)
    return loans.select(*report_columns())
