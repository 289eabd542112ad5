"""Numeric helpers: exact money, safe ratios, NaN normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Exact money: 18 digits before and 10 after the point; a sum of 10**10 such
# values still fits DECIMAL(38,10).
EXACT = T.DecimalType(28, 10)


def exact(col: str | Column) -> Column:
    """A double as an exact decimal of its shortest decimal form.

    Digits past the tenth decimal are rounded. NULL for NaN, an infinity or a
    value of 10**18 and over, none of which has such a form; ``exact_sum``
    adds those as doubles.
    """
    return (F.col(col) if isinstance(col, str) else col).try_cast(EXACT)


def inexact(col: str | Column) -> Column:
    """The values that ``exact`` cannot hold; NULL for all others."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(exact(c).isNull(), c)


def exact_sum(exact_total: Column, inexact_total: Column) -> Column:
    """The sum as DOUBLE from the sums of ``exact`` and ``inexact`` values.

    Without inexact values the exact sum is rounded once, so the result does
    not depend on the order of addition and no input digit is cut. With them
    it is what adding doubles gives: NaN if any value is NaN.
    """
    total = exact_total.cast(T.DoubleType())
    return F.when(inexact_total.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + inexact_total)


def exact_mean(total: Column, count: Column) -> Column:
    """``total / count`` as DOUBLE; NULL when count is 0."""
    return F.try_divide(total.cast(T.DoubleType()), count.cast(T.DoubleType()))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``round(numerator / denominator * 100, digits)``; NULL on a zero denominator.

    ``try_divide`` keeps the non-ANSI NULL result where Spark 4 would raise.
    """
    return F.round(F.try_divide(numerator, denominator) * F.lit(100), digits)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in float/double columns (NULL stays NULL)."""
    floating = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    targets = [c for c in (columns or df.columns) if c in floating]
    if not targets:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in targets})
