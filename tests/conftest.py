import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse, shared = str(tmp_path_factory.mktemp("warehouse")), str(tmp_path_factory.mktemp("shared"))
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": warehouse,
        "spark.driver.memory": "8g", "spark.checkpoint.dir": shared,
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
