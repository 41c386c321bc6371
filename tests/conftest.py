import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mentionlab.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8)
    if not s.sparkContext.getCheckpointDir():
        # tests only: no cluster checkpoint folder is configured here
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mentionlab-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="mentionlab-test-")
