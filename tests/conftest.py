from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import build_session

    return build_session(shuffle_partitions=4)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
