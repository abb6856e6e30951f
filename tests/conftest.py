import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablejobs.session import build_session, release_all  # noqa: E402

SF_DIR = os.environ.get("TABLEJOBS_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    # The event log goes to a scratch folder of the test run; tests read task
    # metrics from it (shuffle records per task) to measure skew handling.
    log_dir = tempfile.mkdtemp(prefix="tablejobs-eventlog-")
    session = build_session("local[8]", 8, "tablejobs-tests", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    yield session
    try:
        release_all(session)      # this session's outputs only
    finally:
        session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
