import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from riverstat.session import get_session

    session = get_session(
        "riverstat-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.sql.codegen.fallback": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
