import datetime as dt
import math

from conftest import attributes, booking, listing
from lodgepole.functions.numeric import nan_to_null
from lodgepole.operators import curate, merge


def test_bad_dates_become_null(raw):
    df = curate.curated_bookings(
        raw(
            "bookings",
            booking(1, booking_date="2020-01-05"),
            booking(2, booking_date="1/2/2020"),
            booking(3, booking_date="31/02/2020"),
            booking(4, booking_date="05/01/2020"),
        )
    )
    got = {r.booking_id: r.booking_date for r in df.collect()}
    assert got == {1: None, 2: None, 3: None, 4: dt.date(2020, 1, 5)}


def test_iso_week_with_calendar_year(raw):
    df = curate.curated_bookings(
        raw("bookings", booking(1, booking_date="01/01/2021"), booking(2, booking_date="30/12/2024"))
    )
    got = {r.booking_id: r.booking_week for r in df.collect()}
    assert got == {1: 53, 2: 1}


def test_stay_days_absolute(raw):
    df = curate.curated_bookings(
        raw("bookings", booking(1, checkin_date="10/01/2020", checkout_date="06/01/2020"))
    )
    assert df.first().stay_days == 4


def test_rows_differing_only_in_currency_collapse(raw):
    df = curate.curated_bookings(
        raw("bookings", booking(1, currency="EUR"), booking(1, currency="USD"), booking(2))
    )
    rows = df.collect()
    assert len(rows) == 2 and {r.currency for r in rows} == {"USD"}


def test_listing_without_attributes_is_dropped(raw):
    df = curate.curated_apartments(
        raw("apartments", listing(1), listing(2)), raw("apartments_attributes", attributes(1))
    )
    assert [r.id for r in df.collect()] == [1]
    assert df.columns[:3] == ["id", "title", "source"] and len(df.columns) == 24


def test_nan_price_becomes_null(raw):
    df = nan_to_null(raw("apartments", listing(1, price=float("nan")), listing(2, price=None), listing(3)))
    got = {r.id: r.price for r in df.collect()}
    assert got[1] is None and got[2] is None and got[3] == 100.0
    assert not any(isinstance(v, float) and math.isnan(v) for v in got.values())


def test_keyless_append_doubles_then_dedupe_restores(raw):
    views = raw("user_viewing", dict(user_id=1, apartment_id=2, viewed_at="01/01/2020"))
    appended = merge.append(views, views)
    assert appended.count() == 2
    assert curate.curated_user_viewing(appended).count() == 1
