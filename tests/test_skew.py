"""Skewed inputs: one listing, user and week hold over a third of all
bookings, and one row is copied as often again. Results must equal a
brute-force model, whatever the number of shuffle partitions, and the hot
groups must be combined inside each task before any exchange."""

import collections
import contextlib
import datetime as dt
import io

import pytest

from conftest import attributes, booking, listing
from lodgepole.operators import curate, metrics

N_HOT, N_COPIES, N_SPREAD = 120, 120, 90
CITIES = 7


def _bookings_spec():
    rows = []
    # hot group: listing 1, user 1, all in ISO week 2 of 2020
    for i in range(N_HOT):
        rows.append(booking(i, user_id=1, apartment_id=1, booking_date=f"{6 + i % 5:02d}/01/2020",
                            total_price=10.0 + i % 3))
    # one booking copied many times (identical rows collapse in the curated table)
    for _ in range(N_COPIES):
        rows.append(booking(10_000, user_id=2, apartment_id=2, booking_date="07/01/2020", total_price=5.0))
    # the rest spread over listings, users and weeks
    for k in range(N_SPREAD):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=k % 60)
        rows.append(booking(20_000 + k, user_id=3 + k % 13, apartment_id=3 + k % 9,
                            booking_date=day.strftime("%d/%m/%Y"), total_price=float(1 + k % 17),
                            booking_status="confirmed" if k % 4 else "pending"))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    from lodgepole.schemas import RAW

    def make(table, rows):
        names = [f.name for f in RAW[table].fields]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW[table])

    spec = _bookings_spec()
    ids = range(1, 12)
    listings = curate.curated_apartments(
        make("apartments", [listing(i, title=f"flat {i}") for i in ids]),
        make("apartments_attributes", [attributes(i, cityname=f"city{i % CITIES}") for i in ids]),
    )
    bookings = curate.curated_bookings(make("bookings", spec))
    return spec, listings, bookings


def _model_rows(spec):
    """Distinct confirmed bookings with (year, iso week, month) of booking."""
    seen, out = set(), []
    for r in spec:
        key = tuple(sorted(r.items()))
        if key in seen:
            continue
        seen.add(key)
        if r["booking_status"] != "confirmed":
            continue
        d = dt.datetime.strptime(r["booking_date"], "%d/%m/%Y").date()
        out.append(dict(r, year=d.year, week=d.isocalendar()[1], month=d.month))
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "8"])
def test_skewed_metrics_match_model(spark, frames, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        spec, listings, bookings = frames
        model = _model_rows(spec)
        assert bookings.count() == N_HOT + 1 + N_SPREAD

        # M5: bookings per (year, week, user)
        m5 = collections.Counter((r["year"], r["week"], r["user_id"]) for r in model)
        got5 = {(r.year, r.week, r.user_id): r.total_bookings for r in metrics.user_weekly_bookings(bookings).collect()}
        assert got5 == dict(m5)

        # M3: top cities per week by count, ties by city name
        city = {i: f"city{i % CITIES}" for i in range(1, 12)}
        per_city = collections.Counter((r["year"], r["week"], city[r["apartment_id"]]) for r in model)
        weeks = collections.defaultdict(list)
        for (y, w, c), n in per_city.items():
            weeks[(y, w)].append((-n, c))
        m3 = {(y, w, c): (-negn, rank)
              for (y, w), cs in weeks.items()
              for rank, (negn, c) in enumerate(sorted(cs)[:5], start=1)}
        got3 = {(r.year, r.week, r.cityname): (r.booking_count, r.rank)
                for r in metrics.popular_locations(bookings, listings).collect()}
        assert got3 == m3

        # M4: revenue per (year, week, listing), rank <= 5 (ties share a rank)
        rev = collections.defaultdict(int)
        for r in model:
            rev[(r["year"], r["week"], r["apartment_id"])] += round(r["total_price"] * 100)
        by_week = collections.defaultdict(list)
        for (y, w, i), cents in rev.items():
            by_week[(y, w)].append((cents, i))
        m4 = {}
        for (y, w), items in by_week.items():
            for cents, i in items:
                rank = 1 + sum(1 for c, _ in items if c > cents)
                if rank <= 5:
                    m4[(y, w, i)] = (cents / 100, rank)
        got4 = {(r.year, r.week, r.id): (r.week_revenue, r.rank)
                for r in metrics.top_performing_listings(bookings, listings).collect()}
        assert got4 == m4

        # M7: users and repeat users per (year, month)
        per_user = collections.Counter((r["year"], r["month"], r["user_id"]) for r in model)
        m7 = collections.defaultdict(lambda: [0, 0])
        for (y, m, _), n in per_user.items():
            m7[(y, m)][0] += 1
            m7[(y, m)][1] += n > 1
        got7 = {(r.year, r.month): [r.total_users, r.repeat_users]
                for r in metrics.repeat_customer_rate(bookings).collect()}
        assert got7 == dict(m7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_groups_are_combined_before_the_exchange(frames):
    _, listings, bookings = frames
    # every shuffle of the skew-prone aggregations is fed by a partial
    # aggregate (or a partial top-k), never by raw rows of the hot group
    for df in (
        metrics.user_weekly_bookings(bookings),
        metrics.repeat_customer_rate(bookings),
        metrics.repeat_rate_30d(bookings),
        metrics.popular_locations(bookings, listings),
        metrics.top_performing_listings(bookings, listings),
    ):
        plan = _physical(df)
        assert "partial_count" in plan or "partial_sum" in plan
    top = _physical(metrics.top_performing_listings(bookings, listings))
    assert "WindowGroupLimit" in top and "Partial" in top
