import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chainstar.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app="chainstar-tests",
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="chainstar-wh-")})
    # Tests own the session: choose a checkpoint folder only because none is set.
    checkpoint_dir(s, tempfile.mkdtemp(prefix="chainstar-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="chainstar-test-")
