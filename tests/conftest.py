import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from helpers import SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyhouse.session import build_session

    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR
