import json
import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from shared_cases import FIXTURES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4,
                      conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def demo_text():
    with open(os.path.join(FIXTURES, "demo_document.txt"), encoding="utf-8") as fh:
        return fh.read()


@pytest.fixture(scope="session")
def pyramid_golden():
    with open(os.path.join(FIXTURES, "pyramid_golden.json"), encoding="utf-8") as fh:
        return json.load(fh)


@pytest.fixture(scope="session")
def router_golden():
    with open(os.path.join(FIXTURES, "router_golden.json"), encoding="utf-8") as fh:
        return json.load(fh)
