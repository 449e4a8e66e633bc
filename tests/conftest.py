import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = get_session("local[4]", 8, app="ledgerline-tests", extra={
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_check import duck

    return duck(SF_SMALL)
