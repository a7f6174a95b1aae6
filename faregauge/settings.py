"""Default values of the rules and windows; every operator takes them as parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# --- fixed values: codes, labels and bounds that define the results -------------

# WMO weather codes of the hourly feed and the label of each.
WEATHER_LABELS = {
    0: "Clear",
    1: "Mostly Clear",
    2: "Cloudy",
    3: "Overcast",
    51: "Drizzle",
    53: "Drizzle",
    55: "Drizzle",
    61: "Rain",
    63: "Rain",
    65: "Rain",
    66: "Freezing Rain",
    67: "Freezing Rain",
    71: "Snow",
    73: "Snow",
    75: "Snow",
    77: "Snow",
    80: "Rain",
    81: "Rain",
    82: "Rain",
    85: "Snow",
    86: "Snow",
    95: "Thunderstorm",
    96: "Thunderstorm",
    99: "Thunderstorm",
}

PEAK_HOURS = (7, 8, 9, 17, 18, 19)

# Box that a plottable zone centre lies in, and the valid zone numbers.
LATITUDE_BOX = (40.4, 41.0)
LONGITUDE_BOX = (-74.4, -73.5)
ZONE_ID_RANGE = (1, 265)

# Stand-ins for the weather of trips on days without an observation.
NO_WEATHER_KEY = -1
NO_WEATHER = {
    "temperature_2m": -999.0,
    "relative_humidity_2m": -1.0,
    "precipitation": 0.0,
    "wind_speed_10m": -1.0,
}
UNKNOWN = "Unknown"

# --- end of fixed values --------------------------------------------------------


@dataclass(frozen=True)
class CleanRules:
    """Which raw trips are kept."""

    year: int = 2025
    min_fare: float = 0.0
    max_minutes: float = 300.0


@dataclass(frozen=True)
class Window:
    """Half-open reporting window and the tip range that counts as plausible."""

    start: date = date(2025, 1, 1)
    end: date = date(2025, 7, 1)
    tip_low: float = 0.0
    tip_high: float = 100.0
