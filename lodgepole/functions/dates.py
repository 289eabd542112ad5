"""Date helpers built only from JVM-side Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgepole.schemas import DATE_FORMAT

# Default bounds of the monthly occupancy calendar.
DEFAULT_SPINE_START = "2020-01-01"
DEFAULT_SPINE_END = "2025-12-31"


def parse_date(col: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """String → DATE; a string that does not match ``fmt`` becomes NULL.

    ``try_to_date`` keeps the NULL-on-error behaviour under ANSI mode,
    where plain ``to_date`` would fail the whole job on one bad row.
    """
    return F.try_to_date(F.col(col) if isinstance(col, str) else col, fmt)


def format_date(col: str | Column, fmt: str = DATE_FORMAT) -> Column:
    return F.date_format(col, fmt)


def year(col: str | Column) -> Column:
    """Calendar year (paired with the ISO week, as in the published schema)."""
    return F.year(col)


def iso_week(col: str | Column) -> Column:
    """ISO-8601 week number: 2021-01-01 is week 53, 2024-12-30 is week 1."""
    return F.weekofyear(col)


def signed_nights(checkin: str = "checkin_date", checkout: str = "checkout_date") -> Column:
    """Checkout minus checkin in days; negative when the dates are reversed."""
    return F.datediff(F.col(checkout), F.col(checkin))


def epoch_window(col: str | Column, days: int) -> Column:
    """Index of the ``days``-long tumbling window holding a date.

    Windows are aligned to 1970-01-01, exactly like
    ``window(date, '<days> days')`` with a UTC session zone, but computed as
    integer arithmetic so the result never depends on the session zone.
    A NULL date gives a NULL window (the row belongs to no window).
    """
    return F.floor(F.unix_date(F.col(col) if isinstance(col, str) else col) / F.lit(days))


# The calendar as SQL text: a parameterised subquery for the bounds and a
# table-generating function for the months. Named parameters are bound as
# literals, so the optimizer folds the sequence into a constant array.
_CALENDAR_SQL = """
SELECT trunc(m, 'MM') AS month_start, year(m) AS year, month(m) AS month, day(last_day(m)) AS days_in_month
FROM (SELECT to_date(:start) AS first_month, to_date(:end) AS last_month) AS bounds
LATERAL VIEW explode(sequence(first_month, last_month, INTERVAL 1 MONTH)) months AS m
"""


def month_calendar(
    spark: SparkSession,
    start: str = DEFAULT_SPINE_START,
    end: str = DEFAULT_SPINE_END,
) -> DataFrame:
    """Spine with ``month_start`` (a date), ``year``, ``month`` and
    ``days_in_month`` columns (one row per month from ``start`` to ``end``, inclusive), built with Spark SQL."""
    return spark.sql(_CALENDAR_SQL, args={"start": start, "end": end})
