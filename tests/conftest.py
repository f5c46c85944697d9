import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from rillframe.session import get_session

    return get_session("tests", 8, spark__sql__shuffle__partitions="4")
