import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Python workers start from the JVM's environment: let them import the test modules
# (decoders and send hooks defined in tests are pickled by reference).
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.dirname(os.path.abspath(__file__))] + [p for p in [os.environ.get("PYTHONPATH")] if p]
)


@pytest.fixture(scope="session")
def spark():
    from eventloom.session import local_session

    s = local_session(4, app="eventloom-tests", shuffle_partitions=8)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
