import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kinweave.runtime import release_stages, session

    held = session("4", 4, driver_memory="4g")
    yield held
    release_stages(held)
