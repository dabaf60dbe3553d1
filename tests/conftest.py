import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from tabloom.session import get_session

    s = get_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
