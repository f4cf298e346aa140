import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from slawatch.session import build_session, checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="slawatch-tests-")
    s = build_session("local[*]", app_name="slawatch-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse",
                             "spark.ui.showConsoleProgress": "false"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
