import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattline.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(shuffle_partitions=8, app="wattline-tests")
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh, never reused folder under the session's checkpoint folder."""
    base = checkpoint_dir(spark)
    d = os.path.join(base, "tests", uuid.uuid4().hex)
    os.makedirs(d, exist_ok=True)
    return d
