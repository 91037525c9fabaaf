import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from orrery.session import build_session

    session = build_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orrery-test-ckpt-"))
    yield session
    session.stop()
