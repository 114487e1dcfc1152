from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larder import session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session.local_session(8, app="tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def root(spark):
    """A new scratch folder for one test."""
    return session.scratch_path(spark, "test")
