import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from sigstat.session import local_session

    s = local_session(8, "tests", "6g")
    s.sparkContext.setLogLevel("OFF")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s


@pytest.fixture
def small_groups(monkeypatch):
    """Make groups of more than 20 rows hot, so that the two-level paths run."""
    from sigstat.plans import skew

    monkeypatch.setattr(skew, "BLOCK_ROWS", 20)
