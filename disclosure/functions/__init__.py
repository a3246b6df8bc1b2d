"""Column-expression builders (no session, no UDFs)."""

from disclosure.functions.display import (
    ap_date,
    ap_month,
    area_type,
    as_text,
    base_name,
    business_type,
    clean_location,
    currency,
    currency_or_null,
    date_with_round,
    has_csv_suffix,
    human_bytes,
    lender,
    loan_status,
    location,
    recipient,
    round_suffix,
    search_text,
    valid_identifier,
    zip5,
)

__all__ = [
    "ap_date",
    "ap_month",
    "area_type",
    "as_text",
    "base_name",
    "business_type",
    "clean_location",
    "currency",
    "currency_or_null",
    "date_with_round",
    "has_csv_suffix",
    "human_bytes",
    "lender",
    "loan_status",
    "location",
    "recipient",
    "round_suffix",
    "search_text",
    "valid_identifier",
    "zip5",
]
