"""Curated tables: listings (with attributes), bookings and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgepole.functions.dates import iso_week, signed_nights
from lodgepole.operators.clean import clean
from lodgepole.schemas import CURATED_APARTMENTS, CURATED_BOOKINGS, CURATED_USER_VIEWING


def _to_schema(df: DataFrame, schema) -> DataFrame:
    """Select the DDL columns in DDL order, cast to the DDL types.

    ``try_cast`` keeps a value that does not fit (e.g. a fractional or
    out-of-range ``square_feet``) from failing the job under ANSI mode.
    """
    return df.select(
        [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def curated_apartments(apartments: DataFrame, attributes: DataFrame) -> DataFrame:
    """Cleaned listings inner-joined with cleaned attributes on ``id``.

    Listings without an attributes row are dropped; a repeated id on either
    side fans out, exactly like the reference join. The join is an equi-join
    on ``id``: Spark broadcasts a side only if it is under the configured
    size threshold, otherwise it shuffles both sides by ``id``.
    """
    left = clean(apartments, "apartments")
    right = clean(attributes, "apartments_attributes")
    return _to_schema(left.join(right, on="id", how="inner"), CURATED_APARTMENTS)


def curated_bookings(bookings: DataFrame) -> DataFrame:
    """Cleaned bookings with ``stay_days`` (absolute) and ``booking_week`` (ISO)."""
    df = clean(bookings, "bookings").withColumns(
        {
            "stay_days": F.abs(signed_nights()),
            "booking_week": iso_week("booking_date"),
        }
    )
    return _to_schema(df, CURATED_BOOKINGS)


def curated_user_viewing(user_viewing: DataFrame) -> DataFrame:
    """Views with a parsed date, de-duplicated (no metric reads this table)."""
    return _to_schema(clean(user_viewing, "user_viewing"), CURATED_USER_VIEWING)


def curate_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "curated_apartments": curated_apartments(raw["apartments"], raw["apartments_attributes"]),
        "curated_bookings": curated_bookings(raw["bookings"]),
        "curated_user_viewing": curated_user_viewing(raw["user_viewing"]),
    }
