import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
RAW = ("date date, ticker string, open double, high double, low double, close double, "
       "volume bigint, src_seq bigint")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw bars from short rows: day of January 2020, then any fields that differ from a good bar."""
    def build(*rows):
        out = []
        for seq, (day, change) in enumerate(rows):
            bar = {"date": None if day is None else dt.date(2020, 1, day), "ticker": "AAA", "open": 10.0,
                   "high": 12.0, "low": 9.0, "close": 11.0, "volume": 100, "src_seq": seq} | change
            out.append(tuple(bar.values()))
        return spark.createDataFrame(out, RAW)
    return build
