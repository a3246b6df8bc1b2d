from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from disclosure.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


# Five made-up loans in the published layout: both rounds, placeholders, a missing industry code,
# quoted commas and quotes, a rural area, exempt and missing statuses, bad cells.
SAMPLE_CSV = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data", "loans_sample.csv")


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="disclosure-tests-")
    session = build_session(
        "local[8]",
        app_name="disclosure-tests",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoint"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="disclosure-t-")
