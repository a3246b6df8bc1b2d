"""Source and report layouts of the loan-disclosure data.

Everything in this module is a fixed value: the names, order and types must stay exactly as
the published source files and the published report define them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- Fixed values: source CSV columns, in file order (the schema is applied by position). ---
_S, _D, _I, _F = StringType(), DateType(), IntegerType(), DoubleType()
LOAN_FIELDS: list[tuple[str, DataType]] = [
    ("LoanNumber", _S),
    ("DateApproved", _D),
    ("SBAOfficeCode", _S),
    ("ProcessingMethod", _S),
    ("BorrowerName", _S),
    ("BorrowerAddress", _S),
    ("BorrowerCity", _S),
    ("BorrowerState", _S),
    ("BorrowerZip", _S),
    ("LoanStatusDate", _D),
    ("LoanStatus", _S),
    ("Term", _I),
    ("SBAGuarantyPercentage", _F),
    ("InitialApprovalAmount", _F),
    ("CurrentApprovalAmount", _F),
    ("UndisbursedAmount", _F),
    ("FranchiseName", _S),
    ("ServicingLenderLocationID", _S),
    ("ServicingLenderName", _S),
    ("ServicingLenderAddress", _S),
    ("ServicingLenderCity", _S),
    ("ServicingLenderState", _S),
    ("ServicingLenderZip", _S),
    ("RuralUrbanIndicator", _S),
    ("HubzoneIndicator", _S),
    ("LMIIndicator", _S),
    ("BusinessAgeDescription", _S),
    ("ProjectCity", _S),
    ("ProjectCountyName", _S),
    ("ProjectState", _S),
    ("ProjectZip", _S),
    ("CD", _S),
    ("JobsReported", _I),
    ("NAICSCode", _S),
    ("Race", _S),
    ("Ethnicity", _S),
    ("UTILITIES_PROCEED", _F),
    ("PAYROLL_PROCEED", _F),
    ("MORTGAGE_INTEREST_PROCEED", _F),
    ("RENT_PROCEED", _F),
    ("REFINANCE_EIDL_PROCEED", _F),
    ("HEALTH_CARE_PROCEED", _F),
    ("DEBT_INTEREST_PROCEED", _F),
    ("BusinessType", _S),
    ("OriginatingLenderLocationID", _S),
    ("OriginatingLender", _S),
    ("OriginatingLenderCity", _S),
    ("OriginatingLenderState", _S),
    ("Gender", _S),
    ("Veteran", _S),
    ("NonProfit", _S),
    ("ForgivenessAmount", _F),
    ("ForgivenessDate", _D),
]

# --- Fixed values: proceeds source column -> display column, in display order. ---
PROCEEDS: list[tuple[str, str]] = [
    ("PAYROLL_PROCEED", "Payroll_Display"),
    ("UTILITIES_PROCEED", "Utilities_Display"),
    ("MORTGAGE_INTEREST_PROCEED", "MortgageInterest_Display"),
    ("HEALTH_CARE_PROCEED", "HealthCare_Display"),
    ("RENT_PROCEED", "Rent_Display"),
    ("REFINANCE_EIDL_PROCEED", "RefinanceEidl_Display"),
    ("DEBT_INTEREST_PROCEED", "DebtInterest_Display"),
]

# --- Fixed values: published report columns, in order. ---
REPORT_COLUMNS: list[str] = [
    "LoanNumber",
    "Recipient_Display",
    "Location_Display",
    "AreaType_Display",
    "Lender_Display",
    "BusinessAge_Display",
    "Industry_Display",
    "JobsReported_Display",
    "BusinessType_Display",
    "LoanAmount_Display",
    "ForgivenessAmount_Display",
    "DateApproved_Display",
    "LoanStatus_Display",
    "searchtext",
    "Payroll_Display",
    "Utilities_Display",
    "MortgageInterest_Display",
    "HealthCare_Display",
    "Rent_Display",
    "RefinanceEidl_Display",
    "DebtInterest_Display",
    "CurrentApprovalAmount",
    "InitialApprovalAmount",
    "ForgivenessAmount",
    "UndisbursedAmount",
    "PAYROLL_PROCEED",
    "UTILITIES_PROCEED",
    "MORTGAGE_INTEREST_PROCEED",
    "RENT_PROCEED",
    "REFINANCE_EIDL_PROCEED",
    "HEALTH_CARE_PROCEED",
    "DEBT_INTEREST_PROCEED",
    "DateApproved",
    "ForgivenessDate",
    "LoanStatusDate",
    "ProcessingMethod",
    "BorrowerName",
    "BorrowerCity",
    "BorrowerState",
    "BorrowerZip",
    "ProjectCity",
    "ProjectState",
    "ProjectZip",
    "OriginatingLender",
    "ServicingLenderName",
    "BusinessType",
    "NAICSCode",
    "JobsReported",
    "LoanStatus",
]

# --- Fixed values: columns a search-result card shows, and those of the detail page. ---
CARD_COLUMNS: list[str] = [
    "Recipient_Display",
    "Location_Display",
    "LoanStatus_Display",
    "LoanAmount_Display",
    "DateApproved_Display",
]
DETAIL_COLUMNS: list[str] = [display for _, display in PROCEEDS] + [
    "ForgivenessAmount_Display",
    "Lender_Display",
    "AreaType_Display",
    "BusinessAge_Display",
    "Industry_Display",
    "BusinessType_Display",
    "JobsReported_Display",
]

LOAN_SCHEMA = StructType([StructField(name, dtype, True) for name, dtype in LOAN_FIELDS])
LOAN_COLUMNS: list[str] = [name for name, _ in LOAN_FIELDS]
DATE_COLUMNS: list[str] = [name for name, dtype in LOAN_FIELDS if isinstance(dtype, DateType)]

# Source date format of the published files.
SOURCE_DATE_FORMAT = "MM/dd/yyyy"
