import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidepanel.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, driver_memory="4g")
    yield s
