import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.session import get_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="tripflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf0001():
    return SF0001
