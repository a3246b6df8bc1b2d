"""Property tests: the column builders against plain-Python statements of the same rules."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from disclosure.functions import display as D
from disclosure.operators.search import _wildcard_regex, normalize_query

SETTINGS = settings(max_examples=5, deadline=None)


def _currency_py(x):
    if x is None:
        return "$0"
    n = int(Decimal(repr(x)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
    return "$" + f"{n:,}"


def _human_py(n):
    value = float(n or 0)
    for unit in D.BYTE_UNITS:
        if value < 1024 or unit == D.BYTE_UNITS[-1]:
            return f"{value:.1f} {unit}"
        value /= 1024


amounts = st.one_of(
    st.none(),
    st.floats(min_value=-1e12, max_value=1e12, allow_nan=False),
    st.integers(min_value=-10**6, max_value=10**6).map(lambda i: i / 2),
)


@SETTINGS
@given(st.lists(amounts, min_size=50, max_size=300))
def test_currency_matches_decimal_half_up(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(D.currency("x")).collect()]
    assert got == [_currency_py(x) for x in xs]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=2**50)), min_size=50, max_size=300))
def test_human_bytes_matches_python_format(spark, ns):
    df = spark.createDataFrame([(n,) for n in ns], "n bigint")
    got = [r[0] for r in df.select(D.human_bytes("n")).collect()]
    assert got == [_human_py(n) for n in ns]


texts = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list(" naNA/xyz")), max_size=8))


@SETTINGS
@given(st.lists(texts, min_size=50, max_size=300))
def test_clean_location_is_idempotent_and_never_blank(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x string").select(D.clean_location("x").alias("c"))
    once = [r[0] for r in df.collect()]
    twice = [r[0] for r in df.select(D.clean_location("c")).collect()]
    assert once == twice
    assert all(c is None or (c.strip(" ") == c and c != "" and c.upper() not in ("N/A", "NA")) for c in once)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab *?~%_")), max_size=10))
def test_query_normalisation(q):
    n = normalize_query(q)
    assert n == normalize_query(n)
    assert "  " not in n and n == n.strip(" ")
    if "*" not in n and "?" not in n:
        assert _wildcard_regex(n) is None


_SEARCH_CACHE: dict = {}


def _py_match(text: str, q: str) -> bool:
    """The search measure in plain Python: TRIM/LOWER, then CONTAINSSTRING with * ? ~."""
    import re as _re

    needle = _re.sub(" {2,}", " ", (q or "").strip(" ")).lower()
    if needle == "":
        return True
    out, i = "", 0
    while i < len(needle):
        ch = needle[i]
        if ch == "~" and i + 1 < len(needle) and needle[i + 1] in "*?~":
            out += _re.escape(needle[i + 1])
            i += 2
            continue
        out += ".*" if ch == "*" else "." if ch == "?" else _re.escape(ch)
        i += 1
    return _re.search(out, text, flags=_re.S) is not None


@settings(max_examples=15, deadline=None)
@given(data=st.data())
def test_search_matches_python_statement(spark, data):
    from disclosure.operators import loan_report, search
    from disclosure.sources.star import loans_from_star
    from tests.conftest import SF001

    if "report" not in _SEARCH_CACHE:
        report = loan_report(loans_from_star(spark, SF001)).select("LoanNumber", "searchtext").cache()
        _SEARCH_CACHE.update(report=report, rows=[tuple(r) for r in report.collect()])
    report, rows = _SEARCH_CACHE["report"], _SEARCH_CACHE["rows"]
    text = data.draw(st.sampled_from([t for _, t in rows]))
    start = data.draw(st.integers(0, max(len(text) - 1, 0)))
    piece = text[start:start + data.draw(st.integers(1, 12))]
    q = data.draw(st.sampled_from(["{}", " {} ", "{}*", "?{}", "{}".upper()])).format(piece)
    got = sorted(r[0] for r in search(report, q).select("LoanNumber").collect())
    want = sorted(k for k, t in rows if _py_match(t, q))
    assert got == want, q
