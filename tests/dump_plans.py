"""Writes PLANS.md: final (post-AQE) physical plans of the main queries after they ran.

    python tests/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from disclosure.plans.checks import plan_text  # noqa: E402
from disclosure.session import build_session  # noqa: E402

KEYS = ["loan_report", "search", "refresh_job", "csv_rejects", "resolve_snapshot", "manifest", "fetch_plan",
        "manifest_total", "fan_out", "stream_publish"]
WIDTH = 160


def _final(text: str) -> str:
    """The final plan of an AQE plan (the initial plan is dropped), long lines cut."""
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    text = re.sub(r"#\d+L?", "", text)
    lines = [line for line in text.strip("\n").splitlines() if line.strip() not in ("+-", "")]
    return "\n".join(line[:WIDTH] + (" ..." if len(line) > WIDTH else "") for line in lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    out = [
        "# Final physical plans",
        "",
        f"Generated by `python tests/dump_plans.py` at `{sf_dir}` on `local[8]` with the session settings of",
        "`disclosure.session.build_session`. Each query ran first, so AQE's final plan is shown (expression",
        "ids removed, lines cut). The one `RoundRobinPartitioning` exchange over a table's scan comes from the entry file's `_spread`:",
        "each test table is a single Parquet row group, so one split; at scale it is absent.",
        "",
    ]
    for key in KEYS:
        df = E.queries()[key](spark, sf_dir)
        df.collect()
        out += [f"## `{key}`", "", "```", _final(plan_text(df, "simple")), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
