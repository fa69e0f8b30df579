import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from textgrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "textgrain-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    # Small inputs would otherwise end up in one partition and hide ordering mistakes.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session
    session.stop()
