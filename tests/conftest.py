import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from courierflow.fixtures import Views  # noqa: E402
from courierflow.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def views(spark):
    return Views(spark, SF)
