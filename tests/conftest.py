import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ridgeline.session import get_session
    s = get_session(master="local[*]", app_name="ridgeline-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g"})
    # Tests own the shared folder; on a cluster it comes from the session.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ridgeline-test-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
