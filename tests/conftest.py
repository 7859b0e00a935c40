from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from nestmart.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", shuffle_partitions=8, app_name="nestmart-tests")
    yield session
    session.stop()


@pytest.fixture()
def tmp_root():
    """A new folder per test (never reused)."""
    return tempfile.mkdtemp(prefix="nestmart-test-")


def write_text(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path
