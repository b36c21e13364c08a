import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from markbook.session import get_session

    s = get_session("local[*]", 8, app_name="markbook-tests", extra_conf={"spark.driver.memory": "2g"})
    yield s
    s.stop()
