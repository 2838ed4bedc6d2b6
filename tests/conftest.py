from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txnguard.schemas import SILVER_SCHEMA  # noqa: E402
from txnguard.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="txnguard-tests", shuffle_partitions=8)
    # our own checkpoint folder only where the environment names none
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txnguard-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from txnguard.session import work_dir

    return work_dir(spark, "tests", unique=True)


def txn(
    tid="t1",
    user="u1",
    amount=100.0,
    time="2024-01-01T10:00:00",
    device="device_1",
    location="India",
    intl=False,
    merchant="amazon",
    ingested="2024-01-01 10:00:05",
):
    import datetime as dt

    ing = dt.datetime.fromisoformat(ingested) if isinstance(ingested, str) else ingested
    return (tid, user, merchant, amount, time, device, location, intl, ing)


def silver_df(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)
