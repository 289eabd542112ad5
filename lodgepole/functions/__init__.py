from lodgepole.functions.dates import (
    epoch_window,
    format_date,
    iso_week,
    month_calendar,
    parse_date,
    signed_nights,
)
from lodgepole.functions.numeric import exact, exact_mean, exact_sum, inexact, nan_to_null, percent

__all__ = [
    "epoch_window",
    "exact",
    "exact_mean",
    "exact_sum",
    "format_date",
    "inexact",
    "iso_week",
    "month_calendar",
    "nan_to_null",
    "parse_date",
    "percent",
    "signed_nights",
]
