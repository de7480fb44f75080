from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "8g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))},
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()
