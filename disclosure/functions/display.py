"""Column -> Column builders for the report's display and search columns.

All of them are compositions of built-in Spark expressions, so they run inside whole-stage
codegen and need no session. Null handling is part of each contract and is spelled out in
the docstrings; the tests pin every one of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: AP-style month names, January to December. ---
AP_MONTHS = ["Jan.", "Feb.", "March", "April", "May", "June", "July", "Aug.", "Sept.", "Oct.", "Nov.", "Dec."]

# --- Fixed values: round suffix by processing method. ---
FIRST_ROUND_METHOD, FIRST_ROUND_SUFFIX = "PPP", " (First Round)"
SECOND_ROUND_METHOD, SECOND_ROUND_SUFFIX = "PPS", " (Second Round)"

# --- Fixed values: loan status texts. ---
FORGIVEN_PREFIX = "Forgiven as of "
EXEMPTION_4 = "Exemption 4"
FULLY_DISBURSED = "Fully Disbursed"
UNKNOWN_STATUS = "Unknown"

# --- Fixed values: location placeholders that mean "no value" (compared upper-cased). ---
NO_LOCATION = ["N/A", "NA"]

# --- Fixed values: rural/urban codes. ---
AREA_TYPES = {"U": "Urban", "R": "Rural"}

# --- Fixed values: byte-size units, and the identifier pattern a table name must match. ---
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]
IDENTIFIER_PATTERN = r"[A-Za-z_][A-Za-z0-9_]*"

ZIP5_PATTERN = r"^(\d{5})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_location(c: Column | str) -> Column:
    """Trimmed city/state; blank, ``N/A`` and ``NA`` in any case become null."""
    t = F.trim(_col(c))
    return F.when((t == "") | F.upper(t).isin(*NO_LOCATION), F.lit(None).cast("string")).otherwise(t)


def currency(amount: Column | str) -> Column:
    """``$`` + amount rounded half-up to whole units with thousands commas; null shows ``$0``.

    ``round`` comes first because ``format_number`` alone rounds half-even. Negative amounts
    print as ``$-1,235``.
    """
    return F.coalesce(currency_or_null(amount), F.lit("$0"))


def currency_or_null(amount: Column | str) -> Column:
    """Like :func:`currency`, but a null amount stays null."""
    return F.concat(F.lit("$"), F.format_number(F.round(_col(amount)), 0))


def ap_month(d: Column | str) -> Column:
    """AP-style month name of a date: March-July in full, ``Sept.``, others abbreviated."""
    return F.elt(F.month(_col(d)), *[F.lit(m) for m in AP_MONTHS])


def ap_date(d: Column | str) -> Column:
    """``Jan. 22, 2021``: AP month, day without padding, four-digit year; null stays null."""
    d = _col(d)
    return F.concat(ap_month(d), F.lit(" "), F.date_format(d, "d, yyyy"))


def round_suffix(method: Column | str) -> Column:
    """`` (First Round)`` / `` (Second Round)`` by processing method, else empty."""
    m = _col(method)
    return (
        F.when(m == FIRST_ROUND_METHOD, F.lit(FIRST_ROUND_SUFFIX))
        .when(m == SECOND_ROUND_METHOD, F.lit(SECOND_ROUND_SUFFIX))
        .otherwise(F.lit(""))
    )


def date_with_round(d: Column | str, method: Column | str) -> Column:
    """AP date followed by the round suffix; a null date gives null."""
    return F.concat(ap_date(d), round_suffix(method))


def loan_status(forgiveness_date: Column | str, undisbursed: Column | str, status: Column | str) -> Column:
    """Status cascade: forgiven (with its AP date), fully disbursed, the status, or ``Unknown``.

    A null undisbursed amount does not count as zero; it falls through to the status.
    """
    fd, und, st = _col(forgiveness_date), _col(undisbursed), _col(status)
    return (
        F.when(fd.isNotNull(), F.concat(F.lit(FORGIVEN_PREFIX), ap_date(fd)))
        .when((und == 0) & (st == EXEMPTION_4), F.lit(FULLY_DISBURSED))
        .otherwise(F.coalesce(st, F.lit(UNKNOWN_STATUS)))
    )


def location(
    project_city: Column | str,
    borrower_city: Column | str,
    project_state: Column | str,
    borrower_state: Column | str,
) -> Column:
    """``City, State``; project values win over borrower values, city and state independently.

    One part is shown alone when the other is missing; null when both are.
    """
    city = F.coalesce(clean_location(project_city), clean_location(borrower_city))
    state = F.coalesce(clean_location(project_state), clean_location(borrower_state))
    # clean_location never yields '', so an empty join means both parts are null.
    return F.nullif(F.concat_ws(", ", city, state), F.lit(""))


def recipient(name: Column | str) -> Column:
    """Borrower name upper-cased and trimmed."""
    return F.upper(F.trim(_col(name)))


def area_type(indicator: Column | str) -> Column:
    """``Urban`` / ``Rural`` for the exact codes ``U`` / ``R`` (case-sensitive), else null."""
    ind = _col(indicator)
    out = None
    for code, label in AREA_TYPES.items():
        out = F.when(ind == code, F.lit(label)) if out is None else out.when(ind == code, F.lit(label))
    return out


def lender(originating: Column | str, servicing: Column | str) -> Column:
    """Originating lender, else servicing lender (null check only; a blank name wins)."""
    return F.coalesce(_col(originating), _col(servicing))


def business_type(c: Column | str) -> Column:
    """Outer spaces trimmed; inner double spaces stay."""
    return F.trim(_col(c))


def as_text(c: Column | str) -> Column:
    """Value as text; null stays null."""
    return _col(c).cast("string")


def zip5(project_zip: Column | str, borrower_zip: Column | str) -> Column:
    """Leading five digits of the first non-null trimmed ZIP (project before borrower).

    The choice is made on the raw trimmed values, so a project ``N/A`` hides a good borrower ZIP;
    no five leading digits gives ``''``, and null stays null.
    """
    raw = F.coalesce(F.trim(_col(project_zip)), F.trim(_col(borrower_zip)))
    return F.regexp_extract(raw, ZIP5_PATTERN, 1)


def search_text(
    borrower_name: Column | str,
    originating_lender: Column | str,
    servicing_lender: Column | str,
    project_zip: Column | str,
    borrower_zip: Column | str,
    business_type_col: Column | str,
    project_city: Column | str,
    borrower_city: Column | str,
    project_state: Column | str,
    borrower_state: Column | str,
    naics: Column | str,
) -> Column:
    """Lower-cased, space-joined search text; never null.

    Names and business type are used untrimmed; city and state are cleaned and both project
    and borrower values are kept. Nulls are skipped, but ``''`` (a ZIP without five digits)
    is kept and so leaves a double space.
    """
    return F.lower(
        F.concat_ws(
            " ",
            _col(borrower_name),
            _col(originating_lender),
            _col(servicing_lender),
            zip5(project_zip, borrower_zip),
            _col(business_type_col),
            clean_location(project_city),
            clean_location(borrower_city),
            clean_location(project_state),
            clean_location(borrower_state),
            as_text(naics),
        )
    )


def human_bytes(n: Column | str) -> Column:
    """``431.2 MB``: one decimal, units B..TB by powers of 1024, TB is the cap; null/0 -> ``0.0 B``.

    The unit is the first one in which the value is below 1024. Rounding to one decimal is
    half-even (``bround``), as a binary float prints with one decimal.
    """
    v = F.coalesce(_col(n).cast("double"), F.lit(0.0))
    unit_index = F.lit(len(BYTE_UNITS) - 1)
    for i in reversed(range(len(BYTE_UNITS) - 1)):
        unit_index = F.when(v < F.lit(1024.0 ** (i + 1)), F.lit(i)).otherwise(unit_index)
    scaled = v / F.pow(F.lit(1024.0), unit_index)
    units = F.array(*[F.lit(u) for u in BYTE_UNITS])
    return F.format_string("%.1f %s", F.bround(scaled, 1), F.element_at(units, unit_index + 1))


def valid_identifier(name: Column | str) -> Column:
    """True when the whole text is a table identifier (no trailing newline accepted)."""
    return _col(name).rlike(r"\A" + IDENTIFIER_PATTERN + r"\z")


def base_name(path: Column | str) -> Column:
    """Last path segment of a file path or URL path."""
    return F.regexp_extract(_col(path), r"[^/]+$", 0)


def has_csv_suffix(path: Column | str) -> Column:
    """True when the path ends with ``.csv`` in any case."""
    return F.lower(_col(path)).endswith(".csv")
