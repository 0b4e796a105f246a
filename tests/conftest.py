import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The driver compares against DuckDB at sf0.01; the oracle tests use the same
# tables (on other data a mean can land exactly on a rounding tie where the
# two engines' summation orders differ by one ulp).
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stationcast.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck_connect
    return duck_connect(SF_SMALL)
