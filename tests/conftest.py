import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment's Spark settings when it names one; otherwise
    # the package gives a local session a private folder (tickscan.session.shared_dir)
    from tickscan.session import get_session, shared_dir
    s = get_session("local[*]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    shared_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tickscan-test-")
