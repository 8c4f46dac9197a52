import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers find the package too, wherever pytest is started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from driftfold.session import local_session

    return local_session(4, 4)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
