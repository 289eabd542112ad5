from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodgepole.schemas import RAW  # noqa: E402
from lodgepole.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="lodgepole-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _row(table: str, **values):
    names = [f.name for f in RAW[table].fields]
    unknown = set(values) - set(names)
    assert not unknown, unknown
    return tuple(values.get(n) for n in names)


@pytest.fixture
def raw(spark):
    """Build a raw-layer frame from keyword rows: raw("bookings", dict(...), ...)."""

    def make(table: str, *rows: dict):
        return spark.createDataFrame([_row(table, **r) for r in rows], RAW[table])

    return make


def booking(i: int, **kw) -> dict:
    base = dict(
        booking_id=i,
        user_id=1,
        apartment_id=1,
        booking_date="06/01/2020",
        checkin_date="10/01/2020",
        checkout_date="12/01/2020",
        total_price=100.0,
        currency="EUR",
        booking_status="confirmed",
    )
    base.update(kw)
    return base


def listing(i: int, **kw) -> dict:
    base = dict(
        id=i,
        title=f"flat {i}",
        source="web",
        price=100.0,
        currency="EUR",
        listing_created_on="06/01/2020",
        is_active=True,
        last_modified_timestamp="06/01/2020",
    )
    base.update(kw)
    return base


def attributes(i: int, **kw) -> dict:
    base = dict(id=i, category="flat", cityname=f"city{i}", state="S", bathrooms=1, bedrooms=1)
    base.update(kw)
    return base
