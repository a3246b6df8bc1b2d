"""Physical-plan checks used by tests and the benchmark's plan report.

They read the text of ``DataFrame.explain`` and answer the questions that matter at scale:
does the plan shuffle, does Python run on the data path, which columns does the scan read,
which filters reach the scan.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain`` output of ``df`` as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges (``Exchange`` nodes, broadcasts excluded)."""
    return len(re.findall(r"^\(\d+\) Exchange\b", plan_text(df), flags=re.M))


def python_nodes(df: DataFrame) -> list[str]:
    """Python evaluation nodes in the physical plan (row UDFs, Arrow UDFs, pandas maps)."""
    names = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
    text = plan_text(df, "simple")
    return [n for n in names if n in text]


def read_schema_columns(df: DataFrame) -> list[list[str]]:
    """Top-level column names of each scan's ``ReadSchema``."""
    out = []
    for m in re.finditer(r"ReadSchema: struct<(.*)>", plan_text(df)):
        body, depth, cols, cur = m.group(1), 0, [], ""
        for ch in body:
            if ch == "<":
                depth += 1
            elif ch == ">":
                depth -= 1
            if ch == "," and depth == 0:
                cols.append(cur)
                cur = ""
            else:
                cur += ch
        if cur:
            cols.append(cur)
        out.append([c.split(":", 1)[0] for c in cols])
    return out


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` lists of the scans."""
    return re.findall(r"PushedFilters: \[(.*?)\]\n", plan_text(df))
