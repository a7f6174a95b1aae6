"""Category labels and guarded ratios."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from faregauge.settings import UNKNOWN, WEATHER_LABELS


def steps(value: Column, limits: Sequence[tuple[float, str]], last: str, closed: bool = False) -> Column:
    """Label of the first limit above ``value`` (or equal to it, when ``closed``), else ``last``.

    A NULL value compares with nothing and so falls through to ``last``.
    """
    tests = [(value <= limit if closed else value < limit, name) for limit, name in limits]
    label = F.when(*tests[0])
    for test, name in tests[1:]:
        label = label.when(test, name)
    return label.otherwise(last)


def tip_percentage(tip: Column, fare: Column) -> Column:
    """Tip as a share of the fare in percent; 0 when there is no positive fare."""
    share = (tip / fare * 100).cast("float")
    return F.when(fare > 0, share).otherwise(F.lit(0.0).cast("float"))


def duration_label(minutes: Column) -> Column:
    return steps(
        minutes, [(1, "Very short"), (5, "Short"), (15, "Medium"), (30, "Long")], "Very long"
    )


def tip_label(fare: Column, percentage: Column) -> Column:
    return (
        F.when(fare == 0, "No charge")
        .when(percentage.isNull() | (percentage == 0), "No tip")
        .otherwise(steps(percentage, [(10, "Low tip"), (20, "Standard tip")], "High tip"))
    )


def feel_label(celsius: Column) -> Column:
    """First temperature scale, on the mean temperature before clipping."""
    return F.when(celsius < 0, "Cold").otherwise(
        steps(celsius, [(15, "Cool"), (25, "Mild"), (35, "Warm")], "Hot", closed=True)
    )


def band_label(celsius: Column) -> Column:
    """Second temperature scale, the one the fact table carries."""
    return steps(celsius, [(0, "Freezing"), (10, "Cold"), (20, "Cool"), (30, "Warm")], "Hot")


def weather_label(code: Column) -> Column:
    """Weather label of a code; fractions are cut off, unlisted codes are 'Other'."""
    table = F.create_map(*map(F.lit, chain.from_iterable(WEATHER_LABELS.items())))
    known = F.try_element_at(table, code.cast("int"))
    return F.when(code.isNull(), UNKNOWN).otherwise(F.coalesce(known, F.lit("Other")))


def clip(value: Column, low: float, high: float) -> Column:
    """Value moved into [low, high]; NULL stays NULL."""
    return F.when(value < low, F.lit(float(low))).when(value > high, F.lit(float(high))).otherwise(value)


def peak_label(flag: Column, peak: str = "Peak Hour", other: str = "Non-Peak Hour") -> Column:
    return F.when(flag, peak).when(~flag, other)


def anomaly_label(distance: Column, passengers: Column) -> Column:
    """Names which of the two impossible values a trip shows."""
    still, empty = distance == 0, passengers == 0
    return (
        F.when(still & empty, "zero_distance_and_zero_passenger")
        .when(still, "zero_distance")
        .when(empty, "zero_passenger")
    )


def flag_count(condition: Column) -> Column:
    """Number of rows where ``condition`` holds; NULL on empty input, as SUM is."""
    return F.sum(F.when(condition, 1).otherwise(0))
