import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from filigree.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{
            "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false",
            "spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1",
            # inputs are tiny here, so compiling plans would take most of the time
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
