from conftest import attributes, booking, listing
from lodgepole.operators import curate, metrics


def _listings(raw, *rows, attrs=None):
    ids = [r["id"] for r in rows]
    attrs = attrs or [attributes(i) for i in ids]
    return curate.curated_apartments(raw("apartments", *rows), raw("apartments_attributes", *attrs))


def _bookings(raw, *rows):
    return curate.curated_bookings(raw("bookings", *rows))


def test_average_listing_price_skips_inactive_and_null(raw):
    listings = _listings(
        raw,
        listing(1, price=100.0),
        listing(2, price=50.25),
        listing(3, price=1000.0, is_active=False),
        listing(4, price=1000.0, is_active=None),
    )
    rows = metrics.average_listing_price(listings).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.year, r.week) == (2020, 2)
    assert r.average_price == 75.125
    assert (r.week_start_date, r.week_end_date) == ("06/01/2020", "06/01/2020")
    iso = metrics.average_listing_price_iso(listings)
    assert iso.columns == ["year", "week", "week_start_date", "week_end_date", "average_price"]
    assert iso.first().week_start_date == "2020-01-06"


def test_occupancy_month_without_bookings_and_signed_nights(spark, raw):
    listings = _listings(raw, listing(1), listing(2))
    bookings = _bookings(
        raw,
        booking(1, checkin_date="10/01/2020", checkout_date="12/01/2020"),
        booking(2, checkin_date="20/01/2020", checkout_date="16/01/2020"),
        booking(3, checkin_date="20/01/2020", checkout_date="25/01/2020", booking_status="pending"),
    )
    out = metrics.occupancy_rate(spark, listings, bookings, "2020-01-01", "2020-02-29").collect()
    jan, feb = out
    assert (jan.year, jan.month, jan.active_listings, jan.days_in_month) == (2020, 1, 2, 31)
    assert (jan.available_nights, jan.total_bookings, jan.total_booked_nights) == (62, 2, -2)
    assert jan.occupancy_rate == -3.23
    assert (feb.total_bookings, feb.total_booked_nights, feb.occupancy_rate) == (0, 0, 0.0)


def test_occupancy_without_active_listings(spark, raw):
    listings = _listings(raw, listing(1, is_active=False))
    bookings = _bookings(raw, booking(1))
    assert metrics.occupancy_rate(spark, listings, bookings, "2020-01-01", "2020-03-31").count() == 0
    full = metrics.occupancy_rate_full_spine(spark, listings, bookings, "2020-01-01", "2020-03-31").collect()
    assert len(full) == 3
    assert all(r.active_listings == 0 and r.occupancy_rate is None for r in full)


def test_popular_locations_tie_broken_by_city(raw):
    # six cities with one booking each in the same week: five are kept, by name
    listings = _listings(raw, *[listing(i) for i in range(6)])
    bookings = _bookings(raw, *[booking(i, apartment_id=i) for i in range(6)])
    rows = metrics.popular_locations(bookings, listings).collect()
    assert [r.cityname for r in rows] == [f"city{i}" for i in range(5)]
    assert [r.rank for r in rows] == [1, 2, 3, 4, 5]


def test_top_listings_rank_ties_keep_more_than_k(raw):
    listings = _listings(raw, *[listing(i) for i in range(6)])
    prices = [600.0, 500.0, 400.0, 300.0, 200.0, 200.0]
    bookings = _bookings(raw, *[booking(i, apartment_id=i, total_price=p) for i, p in enumerate(prices)])
    rows = metrics.top_performing_listings(bookings, listings).collect()
    assert len(rows) == 6
    assert [r.rank for r in rows] == [1, 2, 3, 4, 5, 5]
    assert rows[0].week_revenue == 600.0


def test_revenue_is_exact_cents(raw):
    listings = _listings(raw, listing(1))
    bookings = _bookings(raw, *[booking(i, total_price=0.1) for i in range(10)])
    assert metrics.top_performing_listings(bookings, listings).first().week_revenue == 1.0


def test_money_keeps_every_digit(raw):
    listings = _listings(raw, listing(1, price=10.005), listing(2, price=0.004), listing(3, price=None))
    (m1,) = metrics.average_listing_price(listings).collect()
    assert m1.average_price == 5.0045
    bookings = _bookings(raw, booking(1, total_price=10.005), booking(2, total_price=0.004))
    assert metrics.top_performing_listings(bookings, listings).first().week_revenue == 10.009


def test_values_without_decimal_form_are_summed_as_doubles(raw):
    listings = _listings(raw, *[listing(i) for i in range(1, 5)])
    nan, inf = float("nan"), float("inf")
    prices = [(1, nan), (1, 5.0), (2, 1e17), (2, 1.0), (3, inf), (3, 7.0), (4, 1e300), (4, 2.5)]
    bookings = _bookings(raw, *[booking(i, apartment_id=a, total_price=p) for i, (a, p) in enumerate(prices)])
    rows = metrics.top_performing_listings(bookings, listings).collect()
    assert [(r.id, r.rank) for r in rows] == [(1, 1), (3, 2), (4, 3), (2, 4)]
    assert rows[0].week_revenue != rows[0].week_revenue and [r.week_revenue for r in rows[1:]] == [inf, 1e300, 1e17 + 1.0]


def test_user_weekly_bookings_and_duration(raw):
    bookings = _bookings(
        raw,
        booking(1, user_id=7),
        booking(2, user_id=7, checkout_date="15/01/2020"),
        booking(3, user_id=8, checkin_date="10/01/2020", checkout_date="06/01/2020"),
    )
    uw = {r.user_id: r.total_bookings for r in metrics.user_weekly_bookings(bookings).collect()}
    assert uw == {7: 2, 8: 1}
    (d,) = metrics.average_booking_duration(bookings).collect()
    assert d.avg_booking_duration == (2 + 5 - 4) / 3


def test_repeat_rate_counts_null_user_as_repeat_only(raw):
    bookings = _bookings(
        raw,
        booking(1, user_id=None),
        booking(2, user_id=None),
        booking(3, user_id=1),
        booking(4, user_id=1),
    )
    (r,) = metrics.repeat_customer_rate(bookings).collect()
    assert (r.total_users, r.repeat_users, r.repeat_rate) == (1, 2, 200.0)


def test_repeat_30d_windows_are_epoch_aligned(raw):
    # 2020-01-05 and 2020-02-03 are 29 days apart but in different windows;
    # user 3 only has a booking with an unparsable date (denominator only).
    bookings = _bookings(
        raw,
        booking(1, user_id=1, booking_date="05/01/2020"),
        booking(2, user_id=1, booking_date="03/02/2020"),
        booking(3, user_id=2, booking_date="10/02/2020"),
        booking(4, user_id=2, booking_date="20/02/2020"),
        booking(5, user_id=3, booking_date="2020-02-20"),
    )
    (r,) = metrics.repeat_rate_30d(bookings).collect()
    assert (r.total_users, r.repeat_users) == (3, 1)
    assert abs(r.repeat_rate - 100 / 3) < 1e-12


def test_results_do_not_depend_on_partitioning(spark, raw):
    listings = _listings(raw, *[listing(i) for i in range(8)])
    rows = [booking(i, apartment_id=i % 8, user_id=i % 3, total_price=float(i % 5)) for i in range(64)]
    bookings = _bookings(raw, *rows)
    results = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(
            sorted(metrics.top_performing_listings(bookings, listings).collect())
            + sorted(metrics.popular_locations(bookings, listings).collect())
        )
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_month_calendar_defaults_and_month_lengths(spark):
    from lodgepole.functions.dates import month_calendar

    rows = month_calendar(spark).collect()
    assert len(rows) == 72
    assert (rows[0].year, rows[0].month) == (2020, 1) and (rows[-1].year, rows[-1].month) == (2025, 12)
    days = {(r.year, r.month): r.days_in_month for r in rows}
    assert days[(2020, 2)] == 29 and days[(2021, 2)] == 28 and days[(2024, 4)] == 30
    # a start in the middle of a month steps by whole months from that day
    assert [(r.year, r.month) for r in month_calendar(spark, "2021-01-31", "2021-04-15").collect()] == [
        (2021, 1), (2021, 2), (2021, 3)
    ]
