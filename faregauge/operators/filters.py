"""Reusable row filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.operators.clean import ntz
from faregauge.settings import LATITUDE_BOX, LONGITUDE_BOX, UNKNOWN, Window

MONTH_PARTITION = "pickup_month"


def in_dates(table: DataFrame, window: Window, pickup: str = "pickup_datetime") -> DataFrame:
    """Trips picked up inside the half-open window.

    On a table stored by month the window is repeated on the partition column,
    so months outside it are never listed.
    """
    start, end = (datetime.combine(day, time()) for day in (window.start, window.end))
    kept = table.where((F.col(pickup) >= ntz(start)) & (F.col(pickup) < ntz(end)))
    if MONTH_PARTITION in table.columns:
        last_day = window.end - timedelta(days=1)
        kept = kept.where(
            F.col(MONTH_PARTITION).between(f"{window.start:%Y-%m}", f"{last_day:%Y-%m}")
        )
    return kept


def outside_dates(table: DataFrame, window: Window, pickup: str) -> DataFrame:
    """Trips picked up before the window or at its end and later."""
    start, end = (datetime.combine(day, time()) for day in (window.start, window.end))
    return table.where((F.col(pickup) < ntz(start)) | (F.col(pickup) >= ntz(end)))


def in_window(fact: DataFrame, window: Window = Window()) -> DataFrame:
    """The common report filter: date window and plausible tip share."""
    tip = F.col("tip_percentage")
    return in_dates(fact, window).where(tip.between(window.tip_low, window.tip_high))


def has_zones(trips: DataFrame) -> DataFrame:
    return trips.where(
        F.col("pickup_location_id").isNotNull() & F.col("dropoff_location_id").isNotNull()
    )


def plottable() -> Column:
    """True for zone centres inside the map box; NULL coordinates fail."""
    return F.col("latitude").between(*LATITUDE_BOX) & F.col("longitude").between(*LONGITUDE_BOX)


def known_temperature() -> Column:
    return F.col("temperature_category") != UNKNOWN


def positive_total() -> Column:
    return F.col("total_amount") > 0


def pickup_in_boroughs(fact: DataFrame, locations: DataFrame, boroughs: Sequence[str]) -> DataFrame:
    """Trips that start in one of the boroughs: a semi join on the location key."""
    chosen = locations.where(F.col("borough").isin(*boroughs)).select(
        F.col("location_key").alias("pickup_location_key")
    )
    return fact.join(chosen, "pickup_location_key", "left_semi")


@dataclass(frozen=True)
class TripFilter:
    """A user's selection.

    ``None`` means no restriction. An empty list of weather or temperature labels
    selects nothing, while an empty list of boroughs restricts nothing.
    """

    window: Window = field(default_factory=Window)
    weather: Sequence[str] | None = None
    temperature: Sequence[str] | None = None
    boroughs: Sequence[str] | None = None

    def on_fact(self, fact: DataFrame) -> DataFrame:
        """Window, weather and temperature selection."""
        kept = in_window(fact, self.window)
        for column, chosen in (
            ("weather_description", self.weather),
            ("temperature_category", self.temperature),
        ):
            if chosen is not None:
                kept = kept.where(F.col(column).isin(*chosen) if chosen else F.lit(False))
        return kept

    def apply(self, fact: DataFrame, locations: DataFrame) -> DataFrame:
        """All selections on the fact table."""
        kept = self.on_fact(fact)
        return pickup_in_boroughs(kept, locations, self.boroughs) if self.boroughs else kept

    def apply_joined(self, fact: DataFrame, locations: DataFrame) -> DataFrame:
        """All selections on the fact table joined with its pickup location."""
        chosen = locations
        if self.boroughs:
            chosen = locations.where(F.col("borough").isin(*self.boroughs))
        return with_pickup_location(self.on_fact(fact), chosen)


def with_pickup_location(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Trips with the attributes of the pickup zone; trips without one are left out.

    Both tables are stored, so the size of the location files decides whether
    it is broadcast; beyond the threshold the join shuffles and adaptive
    execution splits hot zones.
    """
    place = locations.select(
        F.col("location_key").alias("pickup_location_key"),
        "location_id",
        "borough",
        "zone_name",
        "latitude",
        "longitude",
    )
    return fact.join(place, "pickup_location_key")
