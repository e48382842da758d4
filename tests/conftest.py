from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from perigee.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark_sql_shuffle_partitions": "4", "spark_ui_enabled": "false", "spark_driver_memory": "8g",
        "spark_ui_showConsoleProgress": "false", "spark_checkpoint_dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
