import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kithra.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoint"))
    session = local_session(4, "tests", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=folder)
    yield session
    session.stop()


@pytest.fixture
def vectors(spark):
    """rows → (id, vector)"""

    def make(rows, key="id"):
        return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], f"{key} long, vector array<double>")

    return make
