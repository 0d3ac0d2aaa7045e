import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import build_session, checkpoint_root  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # The checkpoint dir comes from the configuration when it is set there;
    # checkpoint_root registers a temporary one only when it is unset.
    warehouse = tempfile.mkdtemp(prefix="tidewater-test-warehouse-")
    s = build_session("local[4]", "tidewater-tests", 4, {"spark.sql.warehouse.dir": warehouse})
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tidewater.session import scratch_path
    return lambda tag="t": scratch_path(spark, tag)
