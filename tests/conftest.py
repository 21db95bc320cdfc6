import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    import check
    from scanloom.session import tune
    s = check.session()
    s.sparkContext.setLogLevel("OFF")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return tune(s)
