import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rankfold.session import get_spark, ship_package
    s = get_spark("local[4]", shuffle_partitions=4)
    ship_package(s)
    yield s
    s.stop()


def ts(day: int, sec: int = 0):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day, seconds=sec)


RATING_SCHEMA = "user_id long, item_id long, rating double, ts timestamp_ntz, seq long"
EVENT_SCHEMA = "event_id long, user_id long, item_id long, rating double, ts timestamp_ntz"
