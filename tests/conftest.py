from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tradeflow.session import checkpoint_dir, make_session

    scratch = tempfile.mkdtemp(prefix="tradeflow-tests-")
    session = make_session(
        "tradeflow-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    checkpoint_dir(session, fallback=os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="tradeflow-case-")
