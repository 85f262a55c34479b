import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeshift.session import local_session

    warehouse = tempfile.mkdtemp(prefix="lakeshift-warehouse-")
    s = local_session("*", 8, extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return tempfile.mkdtemp(prefix="lakeshift-test-")
