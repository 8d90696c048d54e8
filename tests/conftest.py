import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Tests only: a private warehouse, so catalog tables do not land in the working directory.
    warehouse = tempfile.mkdtemp(prefix="sluice-warehouse-")
    s = build_session("local[4]", app="sluice-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from sluice.session import scratch_path
    return lambda purpose="t": scratch_path(spark, purpose)
