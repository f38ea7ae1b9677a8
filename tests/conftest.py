import datetime as dt
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tapework.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def price_series():
    """rows(key, n): n sessions on increasing days, some days apart, two-decimal prices."""
    def rows(key, n, seed=0, step=3):
        rng = random.Random(seed * 1000 + n)
        day, price, out = dt.date(2010, 1, 4), 50.0, []
        for _ in range(n):
            price = round(max(price * rng.uniform(0.93, 1.0725), 0.5), 2)
            volume = None if rng.random() < 0.1 else rng.randrange(10_000)
            out.append((key, int(day.strftime("%Y%m%d")), day, price, volume))
            day += dt.timedelta(days=rng.randint(1, step))
        return out
    return rows
