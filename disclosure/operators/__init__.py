"""Row-wise report operators: the report projection, search, result cards and detail page."""

from disclosure.operators.report import loan_report, report_columns
from disclosure.operators.search import detail, normalize_query, search, search_cards

__all__ = ["detail", "loan_report", "normalize_query", "report_columns", "search", "search_cards"]
