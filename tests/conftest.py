from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from barlake import schemas  # noqa: E402
from barlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="barlake-tests")
    yield s
    s.stop()


D0 = dt.date(2024, 1, 1)


def day(i: int) -> dt.date:
    return D0 + dt.timedelta(days=i)


def bars(spark, rows):
    """Silver-shaped frame from (date, ticker, open, high, low, close, volume) tuples."""
    return spark.createDataFrame(rows, schemas.SILVER)


def series(spark, ticker, closes=None, volumes=None, opens=None, start=0):
    """One ticker's consecutive daily bars; high/low wrap open/close."""
    n = len(closes or volumes or opens)
    closes = closes or [100.0] * n
    volumes = volumes or [100] * n
    opens = opens or closes
    rows = []
    for i in range(n):
        o, c = opens[i], closes[i]
        hi = max(x for x in (o, c) if x is not None)
        lo = min(x for x in (o, c) if x is not None)
        rows.append((day(start + i), ticker, o, hi, lo, c, volumes[i]))
    return rows


def dim(spark, rows):
    return spark.createDataFrame(rows, schemas.TICKERS)


def stock(t, sector="Tech", name=None):
    return (t, name or t, sector, "US", "stock", "spdr", "XLK")


def index(t, market="US"):
    return (t, t, None, market, "index", "manual", None)
