import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillwork.session import checkpoint_dir, get_session

    s = get_session("local[4]", 4, app="tillwork-tests")
    s.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster-provided checkpoint folder: set our own.
    checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s
