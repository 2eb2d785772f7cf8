from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from docframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "docframe-tests",
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        8,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def docs(spark):
    """Build (doc_id, md) documents from texts."""

    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, md string")

    return make
