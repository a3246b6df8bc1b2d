"""Runs every registered query against its DuckDB oracle: ``python tests/run_oracle.py [sf_dir] [key ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from disclosure.session import build_session  # noqa: E402
from tests.compare import compare, duck_connection  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.oracle_sql())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    oracles = E.oracle_sql()
    bad = 0
    for key in keys:
        t = time.time()
        try:
            ok, msg = compare(E.queries()[key](spark, sf_dir), con, oracles[key])
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {key:20s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
