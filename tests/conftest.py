import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

AS_OF = dt.date(2025, 6, 1)


@pytest.fixture(scope="session")
def spark():
    from accountlens.session import build_session
    ckpt = tempfile.mkdtemp(prefix="accountlens-test-ckpt-")
    s = build_session("local[4]", app_name="accountlens-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="accountlens-test-")
