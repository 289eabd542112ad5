"""DuckDB SQL used as an independent oracle for every registered query.

The driver pre-registers the generated tables (part, orders, lineitem, ...)
as views; each statement rebuilds the rental-domain tables from them with
plain SQL and computes the same result as the Spark query of the same key.

Conventions shared with the Spark side:

* presentation types follow the published DDL (INT year/week/month/rank,
  BIGINT counts, DOUBLE money and rates);
* money is summed exactly, from the shortest decimal form of each double, and
  rounded to DOUBLE once; a NaN makes its group's sum NaN;
* ``spark_round2`` reproduces Spark's ``round(double, 2)``, which rounds the
  shortest decimal form of the double HALF_UP (DuckDB's own ``round``
  works on the binary value, so 1.005 would give 1.0 instead of 1.01).
"""

from __future__ import annotations

SPINE_START = "1995-01-01"
SPINE_END = "2001-12-31"


def spark_round(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def spark_round2(expr: str) -> str:
    return spark_round(expr, 2)


def parse(col: str, fmt: str = "%d/%m/%Y") -> str:
    return f"CAST(try_strptime({col}, '{fmt}') AS DATE)"


SOURCE_CTES = """
src_apartments AS (
  SELECT CAST(p_partkey AS BIGINT) AS id,
         p_name AS title,
         p_brand AS source,
         CASE WHEN p_partkey % 43 = 0 THEN NULL
              WHEN p_partkey % 47 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN p_partkey % 29 = 0 THEN CAST(p_retailprice AS DOUBLE) + CAST(0.005 AS DOUBLE)
              ELSE CAST(p_retailprice AS DOUBLE) END AS price,
         'EUR' AS currency,
         strftime(DATE '1995-01-01' + CAST(p_partkey % 2000 AS INTEGER), '%d/%m/%Y') AS listing_created_on,
         CASE WHEN p_partkey % 31 <> 0 THEN p_size % 5 <> 0 END AS is_active,
         strftime(DATE '1995-01-01' + CAST(p_partkey % 2000 AS INTEGER) + p_size, '%d/%m/%Y')
           AS last_modified_timestamp
  FROM part
),
src_apartments_attributes AS (
  SELECT CAST(p_partkey AS BIGINT) AS id,
         p_type AS category,
         p_name AS body,
         p_brand AS amenities,
         CAST(p_size % 3 + 1 AS INTEGER) AS bathrooms,
         CAST(p_size % 5 + 1 AS INTEGER) AS bedrooms,
         CAST(p_size AS DOUBLE) AS fee,
         p_size % 2 = 0 AS has_photo,
         CASE WHEN p_size % 3 = 0 THEN 'true' ELSE 'false' END AS pets_allowed,
         p_brand AS price_display,
         'Monthly' AS price_type,
         CASE WHEN p_size % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(p_size * 25 AS DOUBLE) END AS square_feet,
         'Unit ' || CAST(p_partkey AS VARCHAR) AS address,
         n_name AS cityname,
         r_name AS state,
         CAST(n_nationkey * 2.5 AS DOUBLE) AS latitude,
         CAST(n_regionkey * -12.5 AS DOUBLE) AS longitude
  FROM part
  JOIN nation ON p_partkey % 25 = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE p_partkey % 20 <> 0
),
one_bookings AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS booking_id,
         CASE WHEN l_orderkey % 101 <> 0 THEN CAST(o_custkey AS BIGINT) END AS user_id,
         CAST(l_partkey AS BIGINT) AS apartment_id,
         CASE WHEN l_orderkey % 97 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
              ELSE strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') END AS booking_date,
         strftime(CAST(l_shipdate AS DATE), '%d/%m/%Y') AS checkin_date,
         strftime(CAST(l_shipdate AS DATE) + ((CAST(floor(l_quantity) AS INTEGER) % 14) - 2), '%d/%m/%Y')
           AS checkout_date,
         CASE WHEN (l_orderkey * 10 + l_linenumber) % 1009 = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE CAST(l_extendedprice AS DOUBLE) END AS total_price,
         'EUR' AS currency,
         CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'pending'
                            WHEN 'P' THEN 'cancelled' END AS booking_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
src_bookings AS (
  SELECT * FROM one_bookings
  UNION ALL
  SELECT * REPLACE ('USD' AS currency) FROM one_bookings WHERE booking_id % 53 = 0
),
src_user_viewing AS (
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CAST(event_id % (SELECT count(*) FROM part) AS BIGINT) AS apartment_id,
         strftime(CAST(ts AS DATE), '%d/%m/%Y') AS viewed_at,
         value > 50 AS is_wishlisted,
         event_type AS call_to_action
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0) e
),
raw_apartments AS (
  SELECT * REPLACE (CASE WHEN isnan(price) THEN NULL ELSE price END AS price) FROM src_apartments
),
raw_apartments_attributes AS (
  SELECT * REPLACE (CASE WHEN isnan(square_feet) THEN NULL ELSE square_feet END AS square_feet)
  FROM src_apartments_attributes
),
raw_bookings AS (SELECT * FROM src_bookings),
raw_user_viewing AS (SELECT * FROM src_user_viewing)
"""

CLEAN_CTES = f"""
pre_apartments AS (
  SELECT id, title, source, price, 'USD' AS currency,
         {parse('listing_created_on')} AS listing_created_on, is_active,
         {parse('last_modified_timestamp')} AS last_modified_timestamp
  FROM raw_apartments
),
pre_apartments_attributes AS (SELECT * FROM raw_apartments_attributes),
pre_bookings AS (
  SELECT booking_id, user_id, apartment_id,
         {parse('booking_date')} AS booking_date,
         {parse('checkin_date')} AS checkin_date,
         {parse('checkout_date')} AS checkout_date,
         total_price, 'USD' AS currency, booking_status
  FROM raw_bookings
),
pre_user_viewing AS (
  SELECT user_id, apartment_id, {parse('viewed_at')} AS viewed_at, is_wishlisted, call_to_action
  FROM raw_user_viewing
),
clean_apartments AS (SELECT DISTINCT * FROM pre_apartments),
clean_apartments_attributes AS (SELECT DISTINCT * FROM pre_apartments_attributes),
clean_bookings AS (SELECT DISTINCT * FROM pre_bookings),
clean_user_viewing AS (SELECT DISTINCT * FROM pre_user_viewing),
curated_apartments AS (
  SELECT a.id, a.title, a.source, a.price, a.currency, a.listing_created_on, a.is_active,
         a.last_modified_timestamp, b.category, b.body, b.amenities, b.bathrooms, b.bedrooms,
         b.fee, b.has_photo, b.pets_allowed, b.price_display, b.price_type,
         TRY_CAST(b.square_feet AS INTEGER) AS square_feet, b.address, b.cityname, b.state,
         b.latitude, b.longitude
  FROM clean_apartments a JOIN clean_apartments_attributes b ON a.id = b.id
),
curated_bookings AS (
  SELECT *, CAST(abs(checkout_date - checkin_date) AS INTEGER) AS stay_days,
         CAST(weekofyear(booking_date) AS INTEGER) AS booking_week
  FROM clean_bookings
),
curated_user_viewing AS (SELECT * FROM clean_user_viewing),
confirmed AS (SELECT * FROM curated_bookings WHERE booking_status = 'confirmed'),
active AS (SELECT * FROM curated_apartments WHERE is_active)
"""

PRELUDE = "WITH " + SOURCE_CTES.strip() + ",\n" + CLEAN_CTES.strip() + "\n"


def _with(extra_ctes: str, select: str) -> str:
    body = PRELUDE
    if extra_ctes.strip():
        body += ",\n" + extra_ctes.strip() + "\n"
    return body + select


def exact_sum(col: str) -> str:
    """The sum of doubles as exact decimals, rounded to DOUBLE once; with a
    value that has no such form, what adding doubles gives."""
    exact = f"TRY_CAST(CAST({col} AS VARCHAR) AS DECIMAL(28,10))"
    return (
        f"(CASE WHEN count(*) FILTER (WHERE {col} IS NOT NULL AND {exact} IS NULL) > 0 THEN sum({col}) "
        f"ELSE CAST(CAST(sum({exact}) AS VARCHAR) AS DOUBLE) END)"
    )


def _avg_price(fmt: str, order: list[str]) -> str:
    cols = {
        "year": "CAST(year(listing_created_on) AS INTEGER) AS year",
        "week": "CAST(weekofyear(listing_created_on) AS INTEGER) AS week",
        "average_price": f"CASE WHEN count(price) > 0 THEN {exact_sum('price')} / CAST(count(price) AS DOUBLE) END "
        "AS average_price",
        "week_start_date": f"strftime(min(listing_created_on), '{fmt}') AS week_start_date",
        "week_end_date": f"strftime(max(listing_created_on), '{fmt}') AS week_end_date",
    }
    return _with("", f"SELECT {', '.join(cols[c] for c in order)} FROM active GROUP BY 1, 2")


def _calendar(count_expr: str) -> str:
    return f"""
spine AS (
  SELECT CAST(m AS DATE) AS month
  FROM generate_series(DATE '{SPINE_START}', DATE '{SPINE_END}', INTERVAL 1 MONTH) t(m)
),
calendar AS (
  SELECT CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month,
         CAST(day(last_day(month)) AS INTEGER) AS days_in_month, n.active_listings
  FROM spine CROSS JOIN (SELECT CAST({count_expr} AS BIGINT) AS active_listings FROM active) n
)"""


def _occupancy(count_listing: str, count_booking: str, keep_empty: bool) -> str:
    where = "" if keep_empty else "WHERE c.active_listings > 0"
    ctes = _calendar(count_listing) + f""",
booked AS (
  SELECT CAST(year(checkin_date) AS INTEGER) AS year, CAST(month(checkin_date) AS INTEGER) AS month,
         CAST(sum(checkout_date - checkin_date) AS BIGINT) AS total_booked_nights,
         CAST({count_booking} AS BIGINT) AS total_bookings
  FROM confirmed GROUP BY 1, 2
),
occ AS (
  SELECT c.year, c.month, c.active_listings, c.days_in_month,
         CAST(c.active_listings * c.days_in_month AS BIGINT) AS available_nights,
         CAST(coalesce(b.total_bookings, 0) AS BIGINT) AS total_bookings,
         CAST(coalesce(b.total_booked_nights, 0) AS BIGINT) AS total_booked_nights
  FROM calendar c LEFT JOIN booked b ON c.year = b.year AND c.month = b.month
  {where}
)"""
    rate = spark_round2(
        "CASE WHEN available_nights = 0 THEN NULL "
        "ELSE CAST(total_booked_nights AS DOUBLE) / CAST(available_nights AS DOUBLE) * 100 END"
    )
    return _with(ctes, f"SELECT *, {rate} AS occupancy_rate FROM occ")


YEAR_WEEK_BOOKING = (
    "CAST(year(booking_date) AS INTEGER) AS year, CAST(weekofyear(booking_date) AS INTEGER) AS week"
)


POPULAR_LOCATIONS = _with(
    f"""
per_city AS (
  SELECT {YEAR_WEEK_BOOKING}, a.cityname, CAST(count(*) AS BIGINT) AS booking_count
  FROM confirmed b JOIN curated_apartments a ON b.apartment_id = a.id
  GROUP BY 1, 2, 3
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY year, week
                 ORDER BY booking_count DESC, cityname ASC NULLS LAST) AS INTEGER) AS rank
  FROM per_city
)""",
    "SELECT year, week, cityname, booking_count, rank FROM ranked WHERE rank <= 5",
)

TOP_PERFORMING_LISTINGS = _with(
    f"""
per_listing AS (
  SELECT {YEAR_WEEK_BOOKING}, a.id, a.title, a.cityname,
         {exact_sum('b.total_price')} AS week_revenue
  FROM confirmed b JOIN curated_apartments a ON b.apartment_id = a.id
  GROUP BY 1, 2, 3, 4, 5
),
ranked AS (
  SELECT *, CAST(rank() OVER (PARTITION BY year, week ORDER BY week_revenue DESC NULLS LAST) AS INTEGER)
            AS rank
  FROM per_listing
)""",
    "SELECT year, week, id, title, cityname, week_revenue, rank "
    "FROM ranked WHERE rank <= 5",
)

USER_WEEKLY_BOOKINGS = _with(
    "",
    f"SELECT {YEAR_WEEK_BOOKING}, user_id, CAST(count(booking_id) AS BIGINT) AS total_bookings "
    "FROM confirmed GROUP BY 1, 2, 3",
)

AVERAGE_BOOKING_DURATION = _with(
    "",
    "SELECT CAST(year(checkin_date) AS INTEGER) AS year, CAST(weekofyear(checkin_date) AS INTEGER) AS week, "
    "CASE WHEN count(checkout_date - checkin_date) = 0 THEN NULL ELSE "
    "CAST(sum(checkout_date - checkin_date) AS DOUBLE) / CAST(count(checkout_date - checkin_date) AS DOUBLE) "
    "END AS avg_booking_duration FROM confirmed GROUP BY 1, 2",
)

REPEAT_CUSTOMER_RATE = _with(
    """
per_user AS (
  SELECT CAST(year(booking_date) AS INTEGER) AS year, CAST(month(booking_date) AS INTEGER) AS month,
         user_id, count(*) AS bookings
  FROM confirmed GROUP BY 1, 2, 3
),
per_month AS (
  SELECT year, month, CAST(count(user_id) AS BIGINT) AS total_users,
         CAST(sum(CASE WHEN bookings > 1 THEN 1 ELSE 0 END) AS BIGINT) AS repeat_users
  FROM per_user GROUP BY 1, 2
)""",
    "SELECT year, month, total_users, repeat_users, "
    + spark_round2(
        "CASE WHEN total_users = 0 THEN NULL "
        "ELSE CAST(repeat_users AS DOUBLE) / CAST(total_users AS DOUBLE) * 100 END"
    )
    + " AS repeat_rate FROM per_month",
)

REPEAT_RATE_30D = _with(
    """
per_window AS (
  SELECT user_id, floor((booking_date - DATE '1970-01-01') / 30) AS window_index,
         count(booking_id) AS n
  FROM confirmed WHERE booking_date IS NOT NULL GROUP BY 1, 2
),
repeaters AS (SELECT count(DISTINCT user_id) AS repeat_users FROM per_window WHERE n > 1),
users AS (SELECT count(DISTINCT user_id) AS total_users FROM confirmed)
""",
    "SELECT CAST(total_users AS BIGINT) AS total_users, CAST(repeat_users AS BIGINT) AS repeat_users, "
    "CASE WHEN total_users = 0 THEN NULL ELSE CAST(repeat_users AS DOUBLE) / CAST(total_users AS DOUBLE) * 100.0 END "
    "AS repeat_rate FROM users CROSS JOIN repeaters",
)

CURATED_APARTMENTS = _with("", "SELECT * FROM curated_apartments")
CURATED_BOOKINGS = _with("", "SELECT * FROM curated_bookings")
CURATED_USER_VIEWING = _with("", "SELECT * FROM curated_user_viewing")

ACTIVE_LISTING_CALENDAR = _with(_calendar("count(*)"), "SELECT * FROM calendar")

ORACLE = {
    "average_listing_price": _avg_price(
        "%d/%m/%Y", ["year", "week", "average_price", "week_start_date", "week_end_date"]
    ),
    "average_listing_price_iso": _avg_price(
        "%Y-%m-%d", ["year", "week", "week_start_date", "week_end_date", "average_price"]
    ),
    "occupancy_rate": _occupancy("count(*)", "count(*)", keep_empty=False),
    "occupancy_rate_full_spine": _occupancy("count(id)", "count(booking_id)", keep_empty=True),
    "popular_locations": POPULAR_LOCATIONS,
    "top_performing_listings": TOP_PERFORMING_LISTINGS,
    "user_weekly_bookings": USER_WEEKLY_BOOKINGS,
    "average_booking_duration": AVERAGE_BOOKING_DURATION,
    "repeat_customer_rate": REPEAT_CUSTOMER_RATE,
    "repeat_rate_30d": REPEAT_RATE_30D,
    "curated_apartments": CURATED_APARTMENTS,
    "curated_bookings": CURATED_BOOKINGS,
    "curated_user_viewing": CURATED_USER_VIEWING,
    "active_listing_calendar": ACTIVE_LISTING_CALENDAR,
}


# --------------------------------------------------------------------------
# Profiling, ingest, sinks and loads
# --------------------------------------------------------------------------
from lodgepole.schemas import CURATED, RAW, RAW_DATE_COLUMNS  # noqa: E402  (column lists only)

NUMERIC_TYPES = ("int", "bigint", "double", "float", "smallint", "tinyint")


def _duplicate_profile() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS total_rows, "
        f"CAST((SELECT count(*) FROM clean_{t}) AS BIGINT) AS distinct_rows, "
        f"CAST(count(*) - (SELECT count(*) FROM clean_{t}) AS BIGINT) AS duplicate_rows FROM pre_{t}"
        for t in RAW
    ]
    return _with("", "\nUNION ALL\n".join(parts))


def _null_profile() -> str:
    parts = []
    for t, schema in RAW.items():
        for i, f in enumerate(schema.fields):
            dtype = "date" if f.name in RAW_DATE_COLUMNS[t] else f.dataType.simpleString()
            parts.append(
                f"SELECT '{t}' AS table_name, {i} AS ordinal, '{f.name}' AS column_name, "
                f"'{dtype}' AS data_type, CAST(count(*) - count(\"{f.name}\") AS BIGINT) AS null_count "
                f"FROM clean_{t}"
            )
    return _with("", "\nUNION ALL\n".join(parts))


def _summary_profile() -> str:
    parts = []
    tables = {t: (schema, f"raw_{t}") for t, schema in RAW.items()}
    tables |= {t: (CURATED[t], t) for t in ("curated_apartments", "curated_bookings")}
    nan = "CAST('NaN' AS DOUBLE)"
    for t, (schema, view) in tables.items():
        fields = [f for f in schema.fields if f.dataType.simpleString() in (*NUMERIC_TYPES, "string")]
        for i, f in enumerate(fields):
            head = f"SELECT '{t}' AS table_name, {i} AS ordinal, '{f.name}' AS column_name, CAST(count(\"{f.name}\") AS BIGINT) AS count, "
            if f.dataType.simpleString() == "string":
                parts.append(
                    head + "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, "
                    f"CAST(NULL AS DOUBLE) AS max, min(\"{f.name}\") AS min_text, max(\"{f.name}\") AS max_text FROM {view}"
                )
                continue
            c = f'CAST("{f.name}" AS DOUBLE)'
            some = f"count(*) FILTER (WHERE isnan({c})) > 0"
            number = f"FILTER (WHERE NOT isnan({c}))"
            parts.append(
                head + f"CASE WHEN {some} THEN {nan} ELSE {spark_round(f'avg({c}) {number}', 6)} END AS mean, "
                f"CASE WHEN {some} THEN {nan} ELSE {spark_round(f'stddev_samp({c}) {number}', 6)} END AS stddev, "
                f"min({c}) AS min, max({c}) AS max, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM {view}"
            )
    return _with("", "\nUNION ALL\n".join(parts))


_LISTING_COLS = [f.name for f in RAW["apartments"].fields]
UPSERT_LISTINGS = _with(
    f"""
updates AS (
  SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS title, p_brand AS source,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price,
         'EUR' AS currency,
         strftime(DATE '1995-01-01' + CAST(p_partkey % 2000 AS INTEGER), '%d/%m/%Y') AS listing_created_on,
         true AS is_active,
         strftime(CAST(l_shipdate AS DATE), '%d/%m/%Y') AS last_modified_timestamp
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
merged AS (
  SELECT *, 0 AS src FROM raw_apartments
  UNION ALL
  SELECT *, 1 AS src FROM updates
),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY id
      ORDER BY src DESC, {parse('last_modified_timestamp')} DESC NULLS LAST,
               {', '.join(f'{c} DESC NULLS LAST' for c in _LISTING_COLS if c != 'id')}) AS rn
  FROM merged
)""",
    f"SELECT {', '.join(_LISTING_COLS)} FROM ranked WHERE rn = 1",
)


def _count(sql: str) -> str:
    return f"(SELECT CAST(count(*) AS BIGINT) FROM ({sql}) q)"


def _batch_reconcile() -> str:
    rows = []
    for t in RAW:
        rows.append(("raw_layer", t, _count(_with("", f"SELECT * FROM raw_{t}"))))
    for t in ("curated_apartments", "curated_bookings", "curated_user_viewing"):
        rows.append(("curated_layer", t, _count(_with("", f"SELECT * FROM {t}"))))
    for t in (
        "average_listing_price",
        "occupancy_rate",
        "popular_locations",
        "top_performing_listings",
        "user_weekly_bookings",
        "average_booking_duration",
        "repeat_customer_rate",
    ):
        rows.append(("presentation_layer", t, _count(ORACLE[t])))
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, true AS present, true AS readable, "
        f"{n} AS source_rows, {n} AS target_rows, true AS complete"
        for layer, t, n in rows
    )


def _by_city(listings: str) -> str:
    return _with(
        "",
        "SELECT cityname, CAST(count(*) AS BIGINT) AS bookings, CAST(count(DISTINCT user_id) AS BIGINT) AS users, "
        f"CAST(sum(stay_days) AS BIGINT) AS nights FROM curated_bookings JOIN {listings} l "
        "ON l.id = CASE WHEN booking_id % 3 = 0 THEN 7 ELSE apartment_id END GROUP BY cityname",
    )


ORACLE.update(
    {
        "duplicate_profile": _duplicate_profile(),
        "null_profile": _null_profile(),
        "summary_profile": _summary_profile(),
        "nan_to_null_attributes": _with("", "SELECT * FROM raw_apartments_attributes"),
        "upsert_listings": UPSERT_LISTINGS,
        "append_views_dedup": CURATED_USER_VIEWING,
        "csv_roundtrip": _with("", "SELECT * FROM raw_bookings"),
        "catalog_register": _with("", "SELECT * FROM raw_bookings"),
        "layer_load_overwrite": CURATED_BOOKINGS,
        "layer_load_append": _with(
            "", "SELECT * FROM curated_bookings UNION ALL SELECT * FROM curated_bookings"
        ),
        "layout_sorted": _with(
            "", "SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS out_of_order FROM curated_bookings"
        ),
        "layout_bucketed": CURATED_BOOKINGS,
        "batch_average_listing_price": ORACLE["average_listing_price"],
        "batch_top_performing_listings": ORACLE["top_performing_listings"],
        "batch_append_bookings": _with("", "SELECT * FROM raw_bookings"),
        "batch_reconcile": _batch_reconcile(),
        "catalog_register_partitioned": """
SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority),
  CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""",
        "csv_quarantine": """
WITH lines AS (
  SELECT *, o_orderkey % 11 = 0 AS bad_price, o_orderkey % 13 = 0 AS bad_customer,
    o_orderkey % 17 = 0 AS few, o_orderkey % 23 = 0 AS many, CAST(o_totalprice AS DECIMAL(18, 2)) AS price,
    strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 19 = 0 THEN 'F, closed' ELSE o_orderstatus END AS status
  FROM orders),
judged AS (
  SELECT *, few <> many AS wrong_fields,
    -- one field too few and one too many: five fields, the third and fourth moved
    few AND many AS moved FROM lines)
SELECT q AS quarantined,
  CASE WHEN NOT q THEN o_orderkey END AS o_orderkey,
  CAST(CASE WHEN NOT q THEN o_custkey END AS INTEGER) AS o_custkey,
  CASE WHEN NOT q THEN CAST(price AS DOUBLE) END AS o_totalprice,
  CASE WHEN NOT q THEN status END AS o_orderstatus,
  CASE WHEN NOT q THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
  CASE WHEN q THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), CASE WHEN bad_customer THEN '12x' ELSE CAST(o_custkey AS VARCHAR) END,
    CASE WHEN bad_price THEN 'abc' ELSE CAST(price AS VARCHAR) END,
    CASE WHEN NOT few THEN CASE WHEN o_orderkey % 19 = 0 THEN '"F, closed"' ELSE o_orderstatus END END, day, CASE WHEN many THEN 'more' END) END AS record,
  CASE WHEN wrong_fields THEN 'not 5 fields' WHEN q THEN concat_ws('; ', CASE WHEN bad_customer THEN 'o_custkey: ''12x'' is no int' END,
    CASE WHEN bad_price THEN 'o_totalprice: ''abc'' is no double' END, CASE WHEN moved THEN 'o_orderdate: ''more'' is no date' END) END AS reason
FROM (SELECT *, bad_price OR bad_customer OR wrong_fields OR moved AS q FROM judged)""",
        "layout_bucketed_salted": _by_city("curated_apartments"),
        "skewed_listing_join": _by_city("(SELECT a.* FROM curated_apartments a, range(3))"),
        "layout_sized": _with(
            "",
            "SELECT CAST(p AS INTEGER) AS shuffle_partitions, (SELECT CAST(count(*) AS BIGINT) FROM curated_bookings) AS row_count, "
            "true AS files_follow_size FROM (SELECT unnest([1, 8, 200]) AS p)",
        ),
        "incremental_extract": _with(
            "",
            f"SELECT *, CAST(CASE WHEN {parse('last_modified_timestamp')} <= DATE '1997-12-31' THEN 1 ELSE 2 END AS INTEGER) AS extract_run "
            "FROM raw_apartments WHERE id % 13 <> 0",
        ),
        "layer_presence": _with(
            "",
            "SELECT 'presence_layer.' || t AS table_name, t <> 'missing' AS present, t <> 'missing' AS readable, n > 0 AS has_rows, "
            "n = 0 AND t <> 'missing' AS refused FROM (SELECT 'bookings' AS t, count(*) AS n FROM raw_bookings UNION ALL "
            "SELECT 'cancelled_in_advance', count(*) FROM raw_bookings WHERE booking_status = 'cancelled in advance' UNION ALL SELECT 'missing', 0) q",
        ),
        "bookings_preview": _with(
            "", f"SELECT * FROM raw_bookings ORDER BY {', '.join(f'{f.name} NULLS FIRST' for f in RAW['bookings'].fields)} LIMIT 20"
        ),
        "append_rerun_bookings": _with(
            "", "SELECT *, CASE WHEN booking_id % 2 = 0 THEN 'base' ELSE 'second' END AS load_run FROM raw_bookings"
        ),
        "load_content_reconcile": _with(
            "",
            """SELECT 'content_layer' AS layer, t AS table_name, n AS source_rows, n AS target_rows, true AS rows_match,
  t = 'as_loaded' AS content_match,
  CASE t WHEN 'changed' THEN 'total_price' WHEN 'lost' THEN (
    SELECT concat_ws(',', 'booking_id', CASE WHEN a.user_id IS DISTINCT FROM b.user_id THEN 'user_id' END,
      CASE WHEN a.apartment_id IS DISTINCT FROM b.apartment_id THEN 'apartment_id' END, CASE WHEN a.booking_date IS DISTINCT FROM b.booking_date THEN 'booking_date' END,
      CASE WHEN a.checkin_date IS DISTINCT FROM b.checkin_date THEN 'checkin_date' END, CASE WHEN a.checkout_date IS DISTINCT FROM b.checkout_date THEN 'checkout_date' END,
      CASE WHEN a.total_price IS DISTINCT FROM b.total_price THEN 'total_price' END, CASE WHEN a.currency IS DISTINCT FROM b.currency THEN 'currency' END,
      CASE WHEN a.booking_status IS DISTINCT FROM b.booking_status THEN 'booking_status' END)
    FROM raw_bookings a, raw_bookings b
    WHERE a.booking_id = (SELECT min(booking_id) FROM (SELECT booking_id FROM raw_bookings GROUP BY booking_id HAVING count(*) = 1 AND count(user_id) = 1))
      AND b.booking_id = (SELECT max(booking_id) FROM (SELECT booking_id FROM raw_bookings GROUP BY booking_id HAVING count(*) = 1 AND count(user_id) = 1))) ELSE '' END AS differing_columns
FROM (SELECT unnest(['as_loaded', 'changed', 'swapped', 'lost']) AS t), (SELECT CAST(count(*) AS BIGINT) AS n FROM raw_bookings)""",
        ),
    }
)
