import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cairn.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cairn-tests-")
    session = build_session(
        "local[*]",
        app_name="cairn-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
