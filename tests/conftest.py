import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    return local_session(8)


@pytest.fixture
def folder(spark):
    """A fresh path in the shared folder."""
    from millrace.session import scratch

    return scratch(spark, "test")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
