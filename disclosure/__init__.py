"""PySpark engine that publishes loan-disclosure CSV records as a searchable report.

Subpackages:

* ``functions`` - column-expression builders (display text, currency, AP dates, search text).
* ``sources``   - explicit-schema CSV scan with rejects, file listings, snapshot choice,
                  catalog manifests and fetch planning, and the inputs
                  derived from the test tables.
* ``operators`` - the report projection and the search / card / detail operators.
* ``sinks``     - full-refresh, append, clear-then-append and create-if-missing table writers.
* ``plans``     - the end-to-end refresh job (one transform, many sinks) and plan checks.
* ``streaming`` - incremental publishing of newly arrived CSV files.

``python -m disclosure`` (or ``spark-submit`` of ``disclosure/__main__.py``) runs the job from
the command line: optional download from a catalog, then the refresh.

Everything is expressed with built-in Spark DataFrame expressions; there are no Python UDFs
on the data path.
"""

from disclosure.operators.report import loan_report
from disclosure.operators.search import detail, search, search_cards
from disclosure.schema import LOAN_SCHEMA, REPORT_COLUMNS

__all__ = [
    "LOAN_SCHEMA",
    "REPORT_COLUMNS",
    "detail",
    "loan_report",
    "search",
    "search_cards",
]
