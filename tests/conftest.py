from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8", app="riskloom-tests",
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from riskloom.plans.workspace import workspace

    return workspace(spark, "/root/testdata/sf0.001")
