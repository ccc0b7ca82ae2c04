import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ebbtide.session import get_session

    session = get_session("tests", master="local[8]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def skewed(spark):
    """2,000 scored rows; a third of them share one score, and ids decide every tie."""
    import random

    rng = random.Random(7)
    rows = []
    for i in range(2000):
        y = int(rng.random() < 0.2)
        p = 0.25 if rng.random() < 0.34 else round(min(0.999, max(0.0, rng.gauss(0.3 + 0.3 * y, 0.2))), 2)
        rows.append((i, y, p))
    return spark.createDataFrame(rows, "id long, y int, p double").repartition(5).cache(), rows
