import os
import sys

import pytest

os.environ.setdefault("CLICKPULSE_RECORDS_PER_TRIGGER", "300")  # several micro-batches of the small tables

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickpulse.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="clickpulse-tests")
    yield s
    s.stop()


@pytest.fixture
def workdir(tmp_path):
    return str(tmp_path)
