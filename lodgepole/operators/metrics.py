"""Presentation metrics over the curated tables.

Each metric is a pure function ``curated frames → DataFrame``; nothing is
collected to the driver. Design points that matter at scale:

* Filters on ``booking_status`` / ``is_active`` and the columns each metric
  reads are pushed into the Parquet scan of materialised curated tables.
* Metrics that join bookings to listings first aggregate bookings per
  (year, week, listing). The join then sees one row per listing-week instead
  of one per booking, and a listing holding a third of all bookings is one
  row per week, not a hot join key.
* Top-k per (year, week) filters the rank directly, which Spark plans as a
  partial ``WindowGroupLimit`` before the shuffle: a week holding most of
  the data sends at most k rows per task to the final window.
* Money is summed as exact decimals that keep every input digit, so ranks on
  revenue are stable and averages are a single correctly rounded division.
  Values without a decimal form (NaN, infinities, 10**18 and over) are added
  as doubles, so one NaN makes its group's sum NaN, as summing doubles does.
* The occupancy calendar gets the number of active listings as a scalar
  subquery (one distributed count, its value placed on every month),
  instead of crossing every listing with every month (O(N), not O(72·N)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgepole.functions.dates import (
    DEFAULT_SPINE_END,
    DEFAULT_SPINE_START,
    epoch_window,
    format_date,
    iso_week,
    month_calendar,
    signed_nights,
)
from lodgepole.functions.numeric import exact, exact_mean, exact_sum, inexact, percent
from lodgepole.schemas import CONFIRMED, DATE_FORMAT

# Top-k size and the repeat window length in days.
TOP_K = 5
REPEAT_WINDOW_DAYS = 30


def confirmed(bookings: DataFrame) -> DataFrame:
    """Bookings whose status is exactly ``confirmed`` (case-sensitive)."""
    return bookings.filter(F.col("booking_status") == F.lit(CONFIRMED))


def active(listings: DataFrame) -> DataFrame:
    """Listings with ``is_active`` true; NULL counts as not active."""
    return listings.filter(F.col("is_active"))


def _year_week(date_col: str) -> list[Column]:
    return [F.year(date_col).alias("year"), iso_week(date_col).alias("week")]


def _year_month(date_col: str) -> list[Column]:
    return [F.year(date_col).alias("year"), F.month(date_col).alias("month")]


# --------------------------------------------------------------------------
# M1: average listing price per (year, ISO week) of creation
# --------------------------------------------------------------------------
def average_listing_price(
    listings: DataFrame, date_format: str = DATE_FORMAT, notebook_order: bool = False
) -> DataFrame:
    d = "listing_created_on"
    out = (
        active(listings)
        .groupBy(*_year_week(d))
        .agg(
            exact_mean(exact_sum(F.sum(exact("price")), F.sum(inexact("price"))), F.count("price")).alias(
                "average_price"
            ),
            format_date(F.min(d), date_format).alias("week_start_date"),
            format_date(F.max(d), date_format).alias("week_end_date"),
        )
    )
    cols = (
        ["year", "week", "week_start_date", "week_end_date", "average_price"]
        if notebook_order
        else ["year", "week", "average_price", "week_start_date", "week_end_date"]
    )
    return out.select(*cols).orderBy("year", "week")


def average_listing_price_iso(listings: DataFrame) -> DataFrame:
    """Notebook variant: ``yyyy-MM-dd`` dates, price column last."""
    return average_listing_price(listings, date_format="yyyy-MM-dd", notebook_order=True)


# --------------------------------------------------------------------------
# M2: monthly occupancy rate
# --------------------------------------------------------------------------
def active_listing_calendar(
    spark: SparkSession,
    listings: DataFrame,
    start: str = DEFAULT_SPINE_START,
    end: str = DEFAULT_SPINE_END,
    count_ids: bool = False,
) -> DataFrame:
    """Month spine with the number of active listings (``year, month,
    days_in_month, active_listings``).

    The reference crosses every active listing with every month and counts;
    counting once and placing the count on every month gives the same
    numbers without the 72·N intermediate and without any join: the count
    is a scalar subquery (a distributed aggregate returning one value).
    """
    return _calendar(spark, listings, start, end, count_ids).drop("month_start")


def _calendar(spark: SparkSession, listings: DataFrame, start: str, end: str, count_ids: bool) -> DataFrame:
    counted = F.count("id") if count_ids else F.count(F.lit(1))
    n_active = active(listings).agg(counted.alias("active_listings"))
    return month_calendar(spark, start, end).withColumn("active_listings", n_active.scalar())


def _booked_by_checkin_month(bookings: DataFrame, count_col: str | None) -> DataFrame:
    """Confirmed bookings per check-in month.

    One derived key, the first day of the month, serves the grouping and the
    join, so a check-in date that is still parsed from text is parsed once for
    it. There is at most one row per month of the calendar that a DATE can
    hold, which bounds the broadcast however many bookings there are.
    """
    counted = F.count(count_col) if count_col else F.count(F.lit(1))
    return (
        confirmed(bookings)
        .groupBy(F.trunc("checkin_date", "MM").alias("month_start"))
        .agg(
            F.sum(signed_nights()).alias("total_booked_nights"),
            counted.alias("total_bookings"),
        )
    )


def _occupancy(calendar: DataFrame, booked: DataFrame) -> DataFrame:
    return (
        calendar.join(F.broadcast(booked), "month_start", "left")
        .fillna(0, subset=["total_booked_nights", "total_bookings"])
        .withColumn("available_nights", F.col("active_listings") * F.col("days_in_month"))
        .withColumn("occupancy_rate", percent(F.col("total_booked_nights"), F.col("available_nights")))
        .select(
            F.col("year").cast("int"),
            F.col("month").cast("int"),
            F.col("active_listings").cast("long"),
            F.col("days_in_month").cast("int"),
            F.col("available_nights").cast("long"),
            F.col("total_bookings").cast("long"),
            F.col("total_booked_nights").cast("long"),
            F.col("occupancy_rate").cast("double"),
        )
        .orderBy("year", "month")
    )


def occupancy_rate(
    spark: SparkSession,
    listings: DataFrame,
    bookings: DataFrame,
    start: str = DEFAULT_SPINE_START,
    end: str = DEFAULT_SPINE_END,
) -> DataFrame:
    """Scheduled-job variant: no rows at all when no listing is active."""
    calendar = _calendar(spark, listings, start, end, False).filter(F.col("active_listings") > 0)
    return _occupancy(calendar, _booked_by_checkin_month(bookings, None))


def occupancy_rate_full_spine(
    spark: SparkSession,
    listings: DataFrame,
    bookings: DataFrame,
    start: str = DEFAULT_SPINE_START,
    end: str = DEFAULT_SPINE_END,
) -> DataFrame:
    """Notebook variant: every spine month is kept (rate NULL with no
    active listing); counts ``id`` and ``booking_id`` instead of rows."""
    calendar = _calendar(spark, listings, start, end, True)
    return _occupancy(calendar, _booked_by_checkin_month(bookings, "booking_id"))


# --------------------------------------------------------------------------
# M3 / M4: top-k per (year, week) over bookings joined to listings
# --------------------------------------------------------------------------
def _per_listing_week(bookings: DataFrame, **values: Column) -> DataFrame:
    return (
        confirmed(bookings)
        .groupBy(*_year_week("booking_date"), F.col("apartment_id"))
        .agg(*[value.alias(name) for name, value in values.items()])
    )


def _join_listings(per_listing: DataFrame, listings: DataFrame, cols: list[str]) -> DataFrame:
    return per_listing.join(
        listings.select("id", *cols), per_listing["apartment_id"] == listings["id"], "inner"
    )


def popular_locations(bookings: DataFrame, listings: DataFrame, k: int = TOP_K) -> DataFrame:
    """Confirmed bookings per (year, week, city); best k cities per week by
    ``row_number`` (ties broken by city name, so the cut is deterministic)."""
    per_listing = _per_listing_week(bookings, n=F.count(F.lit(1)))
    per_city = (
        _join_listings(per_listing, listings, ["cityname"])
        .groupBy("year", "week", "cityname")
        .agg(F.sum("n").alias("booking_count"))
    )
    w = Window.partitionBy("year", "week").orderBy(
        F.col("booking_count").desc(), F.col("cityname").asc_nulls_last()
    )
    return (
        per_city.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(
            F.col("year").cast("int"),
            F.col("week").cast("int"),
            "cityname",
            F.col("booking_count").cast("long"),
            F.col("rank").cast("int"),
        )
        .orderBy("year", "week", "rank")
    )


def top_performing_listings(bookings: DataFrame, listings: DataFrame, k: int = TOP_K) -> DataFrame:
    """Confirmed revenue per (year, week, listing); ``rank`` ≤ k, so ties at
    the cut can return more than k rows. A NaN revenue ranks first, as Spark
    orders doubles; no revenue (NULL) ranks last."""
    per_listing = _per_listing_week(
        bookings, exact_part=F.sum(exact("total_price")), inexact_part=F.sum(inexact("total_price"))
    )
    total = exact_sum(F.sum("exact_part"), F.sum("inexact_part"))
    per_listing_title = (
        _join_listings(per_listing, listings, ["title", "cityname"])
        .groupBy("year", "week", "id", "title", "cityname")
        .agg(total.alias("week_revenue"))
    )
    w = Window.partitionBy("year", "week").orderBy(F.col("week_revenue").desc_nulls_last())
    return (
        per_listing_title.withColumn("rank", F.rank().over(w))
        .filter(F.col("rank") <= k)
        .select(
            F.col("year").cast("int"),
            F.col("week").cast("int"),
            F.col("id").cast("long"),
            "title",
            "cityname",
            "week_revenue",
            F.col("rank").cast("int"),
        )
        .orderBy("year", "week", "rank")
    )


# --------------------------------------------------------------------------
# M5 / M6: weekly bookings per user, average stay
# --------------------------------------------------------------------------
def user_weekly_bookings(bookings: DataFrame) -> DataFrame:
    return (
        confirmed(bookings)
        .groupBy(*_year_week("booking_date"), F.col("user_id"))
        .agg(F.count("booking_id").alias("total_bookings"))
        .select(
            F.col("year").cast("int"),
            F.col("week").cast("int"),
            "user_id",
            F.col("total_bookings").cast("long"),
        )
        # A large output: sorted inside each task, as the written table is laid
        # out, instead of range-partitioning all rows for a global order.
        .sortWithinPartitions("year", "week", F.col("total_bookings").desc(), F.col("user_id").asc_nulls_last())
    )


def average_booking_duration(bookings: DataFrame) -> DataFrame:
    """Mean signed nights per (year, ISO week) of check-in.

    Computed as exact integer sum ÷ count (one rounding), not as a float
    accumulation whose last bits depend on the order of addition.
    """
    nights = signed_nights()
    return (
        confirmed(bookings)
        .groupBy(*_year_week("checkin_date"))
        .agg(exact_mean(F.sum(nights), F.count(nights)).alias("avg_booking_duration"))
        .select(F.col("year").cast("int"), F.col("week").cast("int"), "avg_booking_duration")
        .orderBy("year", "week")
    )


# --------------------------------------------------------------------------
# M7 / M8: repeat customers
# --------------------------------------------------------------------------
def repeat_customer_rate(bookings: DataFrame) -> DataFrame:
    """Per (year, month) of booking: users, users with more than one
    booking, and their share in percent.

    ``total_users`` counts non-NULL users while ``repeat_users`` also counts
    a NULL user with several bookings, as the published metric does.
    """
    per_user = (
        confirmed(bookings)
        .groupBy(*_year_month("booking_date"), F.col("user_id"))
        .agg(F.count(F.lit(1)).alias("bookings"))
    )
    is_repeat = F.when(F.col("bookings") > 1, 1).otherwise(0)
    return (
        per_user.groupBy("year", "month")
        .agg(
            F.count("user_id").alias("total_users"),
            F.sum(is_repeat).alias("repeat_users"),
        )
        .withColumn("repeat_rate", percent(F.col("repeat_users"), F.col("total_users")))
        .select(
            F.col("year").cast("int"),
            F.col("month").cast("int"),
            F.col("total_users").cast("long"),
            F.col("repeat_users").cast("long"),
            F.col("repeat_rate").cast("double"),
        )
        .orderBy("year", "month")
    )


def repeat_rate_30d(bookings: DataFrame, days: int = REPEAT_WINDOW_DAYS) -> DataFrame:
    """Share (percent) of confirmed users with more than one booking inside
    some epoch-aligned ``days``-day tumbling window; one row.

    Denominator: distinct non-NULL users over all confirmed bookings,
    including bookings with a NULL date (those fall in no window). The
    whole computation is one distributed plan: bookings are aggregated per
    (user, window), then per user, then globally; no value is collected to
    the driver between steps.
    """
    win = epoch_window("booking_date", days)
    per_window = (
        confirmed(bookings)
        .groupBy(F.col("user_id"), win.alias("window_index"))
        .agg(F.count("booking_id").alias("n"))
    )
    per_user = per_window.groupBy("user_id").agg(
        F.max(
            F.when(F.col("window_index").isNotNull() & (F.col("n") > 1), 1).otherwise(0)
        ).alias("is_repeat")
    )
    totals = per_user.agg(
        F.count("user_id").alias("total_users"),
        F.coalesce(
            F.sum(F.when(F.col("user_id").isNotNull(), F.col("is_repeat"))), F.lit(0)
        ).alias("repeat_users"),
    )
    return totals.select(
        F.col("total_users").cast("long"),
        F.col("repeat_users").cast("long"),
        (F.try_divide(F.col("repeat_users"), F.col("total_users")) * F.lit(100.0)).alias(
            "repeat_rate"
        ),
    )


def all_metrics(
    spark: SparkSession,
    curated: dict[str, DataFrame],
    start: str = DEFAULT_SPINE_START,
    end: str = DEFAULT_SPINE_END,
) -> dict[str, DataFrame]:
    """The seven published presentation metrics, keyed by table name."""
    listings = curated["curated_apartments"]
    bookings = curated["curated_bookings"]
    return {
        "average_listing_price": average_listing_price(listings),
        "occupancy_rate": occupancy_rate(spark, listings, bookings, start, end),
        "popular_locations": popular_locations(bookings, listings),
        "top_performing_listings": top_performing_listings(bookings, listings),
        "user_weekly_bookings": user_weekly_bookings(bookings),
        "average_booking_duration": average_booking_duration(bookings),
        "repeat_customer_rate": repeat_customer_rate(bookings),
    }
