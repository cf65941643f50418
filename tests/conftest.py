import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from tests_session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.conf.set("spark.sql.session.timeZone", "UTC")
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
