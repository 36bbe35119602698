import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sightline.session import session

    s = session("tests", cpus=4, spark__sql__shuffle__partitions="4")
    yield s


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA
