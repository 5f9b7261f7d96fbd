import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])  # for Spark's Python workers


@pytest.fixture(scope="session")
def spark():
    from docpack.session import local_session

    return local_session("tests", "4", 4)
