import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from namewright.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "tests", **{"spark.checkpoint.dir": root})
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column over the values of one column ``x``."""

    def run(make, inputs, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
        return [row[0] for row in rows.orderBy("i").select(make("x")).collect()]

    return run
