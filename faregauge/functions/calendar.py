"""Calendar and duration expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faregauge.settings import PEAK_HOURS


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Minutes between two timestamps with their fraction, as a 32-bit float."""
    return (F.timestamp_diff("MICROSECOND", start, end) / 1e6 / 60).cast("float")


def crossed_minutes(start: Column, end: Column) -> Column:
    """How many minute boundaries lie between two timestamps."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def day_number(day: Column) -> Column:
    """Day of the week counted from Sunday = 0."""
    return F.dayofweek(day) - 1


def day_name(moment: Column) -> Column:
    """Full English day name."""
    return F.date_format(F.to_date(moment), "EEEE")


def is_late_week(moment: Column) -> Column:
    """Weekend flag of trips and weather: day number 5 and above, so Friday and Saturday.

    The time dimension has another rule, see :func:`is_calendar_weekend`.
    """
    return day_number(moment) >= 5


def is_calendar_weekend(day: Column) -> Column:
    """Weekend flag of the time dimension: Saturday and Sunday."""
    return day_number(day).isin(0, 6)


def is_peak(hour: Column) -> Column:
    return hour.isin(*PEAK_HOURS)


def season(month: Column) -> Column:
    """Meteorological season of a month number."""
    quarter = F.floor((month % 12) / 3).cast("int")
    return F.element_at(F.array(*map(F.lit, ("Winter", "Spring", "Summer", "Fall"))), quarter + 1)


def month_label(moment: Column) -> Column:
    """``yyyy-MM`` of a moment: the partition value of the stored trip tables."""
    return F.date_format(F.to_date(moment), "yyyy-MM")


def weekday_rank(number: Column) -> Column:
    """Sort position Monday = 1 … Sunday = 7 of a Sunday-based day number."""
    return F.when(number == 0, 7).otherwise(number)
