import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandspark.session import session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke():
    return SMOKE
