"""Cleaning steps applied to raw tables before curation.

Order matters and follows the reference job: currency overwrite, then date
parsing, then whole-row de-duplication, so rows that differ only in
currency or in an unparsable date collapse into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgepole.functions.dates import parse_date
from lodgepole.schemas import DATE_FORMAT, NORMALISED_CURRENCY, RAW_DATE_COLUMNS

# Tables whose currency column is overwritten with the normalised currency.
CURRENCY_TABLES = ("apartments", "bookings")


def normalise_currency(df: DataFrame, currency: str = NORMALISED_CURRENCY) -> DataFrame:
    return df.withColumn("currency", F.lit(currency))


def parse_dates(df: DataFrame, columns: list[str], fmt: str = DATE_FORMAT) -> DataFrame:
    if not columns:
        return df
    return df.withColumns({c: parse_date(c, fmt) for c in columns})


def dedupe(df: DataFrame) -> DataFrame:
    """Exact whole-row de-duplication.

    Planned as a hash aggregate on all columns with a map-side partial
    aggregate, so a row repeated millions of times collapses inside each
    task before the shuffle instead of piling up in one reducer.
    """
    return df.dropDuplicates()


def clean(df: DataFrame, table: str, fmt: str = DATE_FORMAT) -> DataFrame:
    """Currency → dates → de-duplication for one raw table."""
    if table in CURRENCY_TABLES:
        df = normalise_currency(df)
    df = parse_dates(df, RAW_DATE_COLUMNS.get(table, []), fmt)
    return dedupe(df)


def clean_without_dedupe(df: DataFrame, table: str, fmt: str = DATE_FORMAT) -> DataFrame:
    """Currency and dates only (the frame the duplicate profile looks at)."""
    if table in CURRENCY_TABLES:
        df = normalise_currency(df)
    return parse_dates(df, RAW_DATE_COLUMNS.get(table, []), fmt)
