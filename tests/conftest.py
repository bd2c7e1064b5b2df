import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetpulse.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="fleetpulse-tests-")
    s = build_session("local[4]", app="fleetpulse-tests", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoint"),
    })
    yield s
    s.stop()
