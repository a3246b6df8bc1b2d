"""Search-box, result-card and detail-page operators over a published report.

The report's search box is a BI measure: ``q = LOWER(TRIM(input))``, an empty ``q`` keeps
every row, otherwise ``CONTAINSSTRING(searchtext, q)``. Its functions have these semantics,
which we keep:

* ``TRIM`` drops leading and trailing spaces and collapses inner runs of spaces to one.
* ``CONTAINSSTRING`` is a case-insensitive substring test in which ``*`` matches any run of
  characters, ``?`` any one character, and ``~`` escapes the next character.

A query without wildcards becomes a plain column ``Contains``; on the *published* table
(Parquet or another columnar sink) Spark pushes it into the scan as ``StringContains`` and
reads only the card columns. A query with wildcards becomes an anchored-free ``rlike`` with
every other character quoted. ``%`` and ``_`` are always literal.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosure.schema import CARD_COLUMNS, DETAIL_COLUMNS


def normalize_query(q: str | None) -> str:
    """The search box value as it is matched: spaces trimmed and collapsed, lower-cased."""
    return re.sub(" {2,}", " ", (q or "").strip(" ")).lower()


def _tokens(needle: str) -> list[str]:
    """Literal runs and the wildcards ``*`` and ``?`` between them; a literal run is never one of those."""
    out: list[str] = []
    literal: list[str] = []
    i = 0
    while i < len(needle):
        ch = needle[i]
        escaped = ch == "~" and i + 1 < len(needle) and needle[i + 1] in "*?~"
        if ch in "*?":
            if literal:
                out.append("=" + "".join(literal))
                literal = []
            out.append(ch)
        else:
            literal.append(needle[i + 1] if escaped else ch)
        i += 2 if escaped else 1
    return out + (["=" + "".join(literal)] if literal else [])


def literal_runs(q: str | None) -> list[str]:
    """The texts between wildcards that every match of the search box value contains."""
    return [t[1:] for t in _tokens(normalize_query(q)) if t.startswith("=")]


def _wildcard_regex(needle: str) -> str | None:
    """Java regex for a needle with ``*``/``?`` wildcards; None when it has none."""
    tokens = _tokens(needle)
    if not any(t in ("*", "?") for t in tokens):
        return None
    wild = {"*": "(?s:.*)", "?": "(?s:.)"}
    return "".join(wild.get(t) or re.escape(t[1:]) for t in tokens)


def match(searchtext: Column | str, q: str | None) -> Column:
    """Predicate of the search box over a ``searchtext`` column."""
    text = F.col(searchtext) if isinstance(searchtext, str) else searchtext
    needle = normalize_query(q)
    if needle == "":
        return F.lit(True)
    pattern = _wildcard_regex(needle)
    if pattern is None:
        literal = re.sub("~([*?~])", r"\1", needle)
        return text.contains(F.lit(literal))
    return text.rlike(pattern)


def search(report: DataFrame, q: str | None) -> DataFrame:
    """Rows whose ``searchtext`` matches the search box value; an empty value keeps every row."""
    if normalize_query(q) == "":
        return report
    return report.filter(match("searchtext", q))


def search_cards(report: DataFrame, q: str | None) -> DataFrame:
    """Search result list: the key plus the card columns."""
    return search(report, q).select("LoanNumber", *CARD_COLUMNS)


def detail(report: DataFrame, loan_number: str) -> DataFrame:
    """Detail page of one loan: the key plus the detail columns."""
    return report.filter(F.col("LoanNumber") == F.lit(loan_number)).select("LoanNumber", *DETAIL_COLUMNS)
