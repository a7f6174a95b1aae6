"""The stored star schema."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faregauge.operators import dimensions, fact, features, keys
from faregauge.operators.clean import clean_trips
from faregauge.operators.filters import MONTH_PARTITION
from faregauge.operators.weather import forward_fill, transform_weather
from faregauge.settings import CleanRules
from faregauge.sources.sinks import write_mart


class TableStore:
    """Tables written once under a shared folder and read back from there.

    A written table cuts the lineage, survives lost executors and carries file
    sizes, from which the optimizer decides about broadcasts.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, write: Callable[[str], None]) -> DataFrame:
        """The stored table ``name``, written by ``write(path)`` on first use."""
        if name not in self._tables:
            path = self.path(name)
            write(path)
            self._tables[name] = self.spark.read.parquet(path)
        return self._tables[name]


class StarSchema:
    """Cleaned trips, dimensions and fact of one set of inputs, built on demand."""

    FACT_RANGES = [MONTH_PARTITION, "part_no"]

    def __init__(
        self,
        store: TableStore,
        raw: Callable[[], DataFrame],
        weather_days: Callable[[], DataFrame],
        zones: Callable[[], DataFrame],
        rules: CleanRules = CleanRules(),
    ):
        self.store = store
        self._raw = raw
        self._weather_days = weather_days
        self._zones = zones
        self.rules = rules

    def _stored(self, name: str, table: Callable[[], DataFrame]) -> DataFrame:
        return self.store.table(name, lambda path: write_mart(table(), path))

    def cleaned(self) -> DataFrame:
        """Cleaned trips: read, filtered and written in one stage without a shuffle."""
        return self._stored("cleaned", lambda: clean_trips(self._raw(), self.rules))

    def weather(self) -> DataFrame:
        """Filled and labelled days."""
        return self._stored(
            "weather_transformed", lambda: transform_weather(forward_fill(self._weather_days()))
        )

    def dim_time(self) -> DataFrame:
        return self._stored("dim_time", lambda: dimensions.dim_time(self.cleaned()))

    def dim_location(self) -> DataFrame:
        staging = self.store.path("_dim_location")
        return self._stored(
            "dim_location",
            lambda: dimensions.dim_location(self.cleaned(), self._zones(), staging),
        )

    def dim_weather(self) -> DataFrame:
        staging = self.store.path("_dim_weather")
        return self._stored("dim_weather", lambda: dimensions.dim_weather(self.weather(), staging))

    def _staged_fact(self) -> DataFrame:
        """Fact rows in trip order, partitioned by pickup month.

        The offsets of its ranges are stored first: they are known before any row is written,
        unless a single minute is larger than a range.
        """

        def write(path: str) -> None:
            scratch = self.store.path(f"_fact_ranges-{uuid.uuid4().hex[:12]}")
            dims = (self.dim_time(), self.dim_location(), self.dim_weather())
            rows, offsets = fact.ordered_fact(self.cleaned(), *dims, scratch)
            if offsets is not None:
                self._stored("fact_offsets", lambda: offsets)
            keys.write_staged(rows, path, MONTH_PARTITION)

        return self.store.table("fact", write)

    def fact_rows(self) -> DataFrame:
        """The fact table without key and load time, which no report needs."""
        return self._staged_fact().drop("part_no", "row_no")

    def fact(self, first: int | None = None) -> DataFrame:
        """The fact table with the dense ``trip_id``, or its first rows in key order.

        The key is kept as an offset per written range, so that reloading one
        month rewrites that month and this small table only.
        """
        staged = self._staged_fact()
        offsets = self._stored("fact_offsets", lambda: keys.key_offsets(staged, self.FACT_RANGES))
        stamped = fact.with_load_time(staged)
        if first is not None:
            return keys.first_numbered(stamped, offsets, self.FACT_RANGES, "trip_id", first)
        return keys.numbered(stamped, offsets, self.FACT_RANGES, "trip_id")

    def features(self) -> DataFrame:
        """Feature matrix with a stable ``feature_id``."""

        def keyed() -> DataFrame:
            matrix = self._stored(
                "features",
                lambda: features.build_features(
                    self.cleaned(), self.weather(), self._zones(), self.store.path("_boroughs")
                ),
            )
            return features.keyed_features(matrix, self.store.path("_features"))

        return self._stored("keyed_features", keyed)
