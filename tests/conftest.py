import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.config import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from starloom.sinks.staging import drop_staging

    s = local_session("*", shuffle_partitions=8, app_name="starloom-tests")
    yield s
    drop_staging(s)
    s.stop()
