from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sieveline.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """One small session; the shared folder is a temporary one, as spark.checkpoint.dir would be on a cluster."""
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, "4g", **{"spark.checkpoint.dir": f"file://{shared}", "spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": str(shared / "warehouse")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA
