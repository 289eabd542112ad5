"""Explicit schemas for the three layers.

Raw columns follow the raw-layer DDL (dates are ``dd/MM/yyyy`` strings);
curated and presentation columns follow the curated / presentation DDL,
in DDL column order. Declared-type conflicts in the source material are
settled once here: ``square_feet`` is DOUBLE raw and INT curated,
``pets_allowed`` is a string.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The source date format and the currency every row is
# normalised to.
DATE_FORMAT = "dd/MM/yyyy"
NORMALISED_CURRENCY = "USD"
CONFIRMED = "confirmed"

L, S, D, B, I, DT = (
    T.LongType(),
    T.StringType(),
    T.DoubleType(),
    T.BooleanType(),
    T.IntegerType(),
    T.DateType(),
)


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_APARTMENTS = _struct([
    ("id", L), ("title", S), ("source", S), ("price", D), ("currency", S),
    ("listing_created_on", S), ("is_active", B), ("last_modified_timestamp", S),
])

RAW_APARTMENT_ATTRIBUTES = _struct([
    ("id", L), ("category", S), ("body", S), ("amenities", S),
    ("bathrooms", I), ("bedrooms", I), ("fee", D), ("has_photo", B),
    ("pets_allowed", S), ("price_display", S), ("price_type", S),
    ("square_feet", D), ("address", S), ("cityname", S), ("state", S),
    ("latitude", D), ("longitude", D),
])

RAW_BOOKINGS = _struct([
    ("booking_id", L), ("user_id", L), ("apartment_id", L),
    ("booking_date", S), ("checkin_date", S), ("checkout_date", S),
    ("total_price", D), ("currency", S), ("booking_status", S),
])

RAW_USER_VIEWING = _struct([
    ("user_id", L), ("apartment_id", L), ("viewed_at", S),
    ("is_wishlisted", B), ("call_to_action", S),
])

RAW = {
    "apartments": RAW_APARTMENTS,
    "apartments_attributes": RAW_APARTMENT_ATTRIBUTES,
    "bookings": RAW_BOOKINGS,
    "user_viewing": RAW_USER_VIEWING,
}

# Primary keys of the operational tables (user_viewing has none).
RAW_KEYS = {
    "apartments": ["id"],
    "apartments_attributes": ["id"],
    "bookings": ["booking_id"],
    "user_viewing": [],
}

# String date columns per raw table, parsed during cleaning.
RAW_DATE_COLUMNS = {
    "apartments": ["listing_created_on", "last_modified_timestamp"],
    "apartments_attributes": [],
    "bookings": ["booking_date", "checkin_date", "checkout_date"],
    "user_viewing": ["viewed_at"],
}

CURATED_APARTMENTS = _struct([
    ("id", L), ("title", S), ("source", S), ("price", D), ("currency", S),
    ("listing_created_on", DT), ("is_active", B), ("last_modified_timestamp", DT),
    ("category", S), ("body", S), ("amenities", S), ("bathrooms", I),
    ("bedrooms", I), ("fee", D), ("has_photo", B), ("pets_allowed", S),
    ("price_display", S), ("price_type", S), ("square_feet", I),
    ("address", S), ("cityname", S), ("state", S), ("latitude", D),
    ("longitude", D),
])

CURATED_BOOKINGS = _struct([
    ("booking_id", L), ("user_id", L), ("apartment_id", L),
    ("booking_date", DT), ("checkin_date", DT), ("checkout_date", DT),
    ("total_price", D), ("currency", S), ("booking_status", S),
    ("stay_days", I), ("booking_week", I),
])

CURATED_USER_VIEWING = _struct([
    ("user_id", L), ("apartment_id", L), ("viewed_at", DT),
    ("is_wishlisted", B), ("call_to_action", S),
])

CURATED = {
    "curated_apartments": CURATED_APARTMENTS,
    "curated_bookings": CURATED_BOOKINGS,
    "curated_user_viewing": CURATED_USER_VIEWING,
}

PRESENTATION = {
    "average_listing_price": _struct([
        ("year", I), ("week", I), ("average_price", D),
        ("week_start_date", S), ("week_end_date", S),
    ]),
    "occupancy_rate": _struct([
        ("year", I), ("month", I), ("active_listings", L), ("days_in_month", I),
        ("available_nights", L), ("total_bookings", L),
        ("total_booked_nights", L), ("occupancy_rate", D),
    ]),
    "popular_locations": _struct([
        ("year", I), ("week", I), ("cityname", S), ("booking_count", L),
        ("rank", I),
    ]),
    "top_performing_listings": _struct([
        ("year", I), ("week", I), ("id", L), ("title", S), ("cityname", S),
        ("week_revenue", D), ("rank", I),
    ]),
    "user_weekly_bookings": _struct([
        ("year", I), ("week", I), ("user_id", L), ("total_bookings", L),
    ]),
    "average_booking_duration": _struct([
        ("year", I), ("week", I), ("avg_booking_duration", D),
    ]),
    "repeat_customer_rate": _struct([
        ("year", I), ("month", I), ("total_users", L), ("repeat_users", L),
        ("repeat_rate", D),
    ]),
}

# Layer → tables, as created in the warehouse (three schemas, 14 tables).
LAYERS = {
    "raw_layer": RAW,
    "curated_layer": CURATED,
    "presentation_layer": PRESENTATION,
}

# Partition column of tables that keep each run's rows apart (not published).
RUN_COLUMN = "load_run"

# Physical layout per table: (distribution key or None for EVEN, sort keys).
LAYOUT = {
    "curated_apartments": ("id", ["cityname", "is_active"]),
    "curated_bookings": ("apartment_id", ["booking_date"]),
    "curated_user_viewing": (None, ["viewed_at"]),
    "average_listing_price": ("year", ["year", "week"]),
    "occupancy_rate": ("year", ["year", "month"]),
    "popular_locations": ("year", ["year", "week"]),
    "top_performing_listings": ("year", ["year", "week", "rank"]),
    "user_weekly_bookings": ("year", ["year", "week"]),
    "average_booking_duration": ("year", ["year", "week"]),
    "repeat_customer_rate": ("year", ["year", "month"]),
}

# Tables whose loaders turn NaN into NULL on ingest (the bookings loader keeps
# NaN as is).
NAN_TO_NULL_TABLES = ("apartments", "apartments_attributes", "user_viewing")
