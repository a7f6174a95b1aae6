"""Exact medians by repeated histograms."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BINS = 1024


def exact_medians(
    table: DataFrame, columns: Sequence[str], only_gappy: bool = False
) -> dict[str, float | None]:
    """Median of every column, NULL and NaN aside; None for a column without values.

    Infinities count as the least and the greatest values.

    ``only_gappy`` leaves out columns without NULLs, which need no replacement.

    The built-in exact percentile keeps every distinct value of a column in one
    aggregation buffer. Here an approximate percentile gives a bracket around the
    middle, and each further pass counts the values of the bracket in equal bins
    for all columns at once, until the bin with the wanted rank holds a single
    value. A pass is one scan with map-side partials, and the driver sees at most
    a fixed number of bins per column.
    """
    if not columns:
        return {}
    wide = table.select([F.nullif(F.col(c).cast("double"), F.lit(math.nan)).alias(c) for c in columns])
    summary = wide.agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(columns)],
        *[
            F.percentile_approx(c, [0.49, 0.51], 1000).alias(f"q_{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    found: dict[str, list[float]] = {c: [] for c in columns}
    # An open search: column, rank among all values, bracket that may hold it.
    searches = []
    for i, c in enumerate(columns):
        n = summary[f"n_{i}"]
        if only_gappy and n == summary["rows"]:
            del found[c]
            continue
        for rank in sorted({(n - 1) // 2, n // 2}) if n else ():
            searches.append((c, rank, *summary[f"q_{i}"]))
    limits = {c: (summary[f"lo_{i}"], summary[f"hi_{i}"]) for i, c in enumerate(columns)}
    while searches:
        histograms = _histograms(wide, {(c, low, high) for c, _, low, high in searches})
        still_open = []
        for c, rank, low, high in searches:
            least, greatest = _narrow(histograms[c, low, high], rank, limits[c])
            if least == greatest:
                found[c].append(least)
            elif (least, greatest) == (low, high) and not _fresh(low, high):
                raise ArithmeticError(f"the search for a median of {c} does not narrow: {low} to {high}")
            else:
                still_open.append((c, rank, least, greatest))
        searches = still_open
    return {c: sum(v) / len(v) if v else None for c, v in found.items()}


def _fresh(low: float, high: float) -> bool:
    """Whether a bracket has values between its ends that a pass can still separate."""
    return math.isfinite(low) and math.isfinite(high) and math.nextafter(low, high) < high


def _narrow(bins: dict[int, tuple], rank: int, limits: tuple) -> tuple[float, float]:
    """Least and greatest value of the bin that holds ``rank``.

    Bins -1 and _BINS collect what lies outside the bracket. When the approximate
    percentiles missed the rank, the search goes on between them and the limits.
    """
    seen = 0
    for number, (count, least, greatest) in sorted(bins.items()):
        seen += count
        if rank < seen:
            if number == -1:
                return limits[0], greatest
            return (least, limits[1]) if number == _BINS else (least, greatest)
    raise ValueError("rank beyond the number of values")


def _histograms(wide: DataFrame, brackets: set[tuple]) -> dict[tuple, dict[int, tuple]]:
    """Count, least and greatest value per bin of each bracket, from one scan."""
    ordered = sorted(brackets)
    places = []
    for i, (name, low, high) in enumerate(ordered):
        value = F.col(name)
        # Infinite ends get bins of their own; halves keep the widest range from overflowing.
        below = max(low, -sys.float_info.max)
        above = min(high, sys.float_info.max)
        width = max(above / 2 - below / 2, 5e-324)
        share = (value / 2 - below / 2) / width
        step = F.least(F.floor(share * (_BINS - 2)).cast("int") + 1, F.lit(_BINS - 2))
        number = (
            F.when(value < low, -1)
            .when(value > high, _BINS)
            .when(value <= below, 0)
            .when(value >= above, _BINS - 1)
            .otherwise(step)
        )
        places.append(F.struct(F.lit(i).alias("i"), number.alias("bin"), value.alias("value")))
    placed = wide.select(F.explode(F.array(*places)).alias("p")).where("p.value IS NOT NULL")
    rows = (
        placed.groupBy("p.i", "p.bin")
        .agg(
            F.count("*").alias("n"),
            F.min("p.value").alias("least"),
            F.max("p.value").alias("greatest"),
        )
        .collect()
    )
    result: dict[tuple, dict[int, tuple]] = {bracket: {} for bracket in ordered}
    for row in rows:
        result[ordered[row["i"]]][row["bin"]] = (row["n"], row["least"], row["greatest"])
    return result
