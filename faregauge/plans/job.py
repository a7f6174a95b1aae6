"""One month per run: load its file, extend the dimensions, rebuild what it touches."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.operators import dimensions, keys
from faregauge.operators.clean import clean_trips
from faregauge.operators.fact import ordered_fact, with_load_time
from faregauge.operators.filters import MONTH_PARTITION
from faregauge.operators.weather import forward_fill, one_per_day, transform_weather
from faregauge.plans.star import StarSchema
from faregauge.schemas import WEATHER_DAILY, ZONE_LOOKUP
from faregauge.session import configure
from faregauge.settings import CleanRules
from faregauge.sources import snapshots
from faregauge.sources.files import empty_table
from faregauge.sources.snapshots import Change, Snapshot
from faregauge.streaming import months
from faregauge.streaming.loading import load_new_files, read_staging

BATCH = "batch_month"
FACT_OFFSETS = "fact_offsets"
SOURCES = "source_name string, state string, row_count long, detail string"


@dataclass
class MonthlyJob:
    """The incremental pipeline over one target folder.

    ``trip_file`` names the data set of a month. ``weather`` and ``zones`` give
    the daily observations and the zone table; when one of them can't be named or read to its
    end, or is empty, the run goes on with what its dimension holds, or with an empty table in the first run.
    Table ``sources`` says which. Their later versions reach stored months: keys stay,
    attributes follow the source, and months whose weather days changed are built again.

    All tables of a run are shown by one commit. Before it, and after a run that broke
    anywhere, readers get the tables of the last one.
    """

    spark: SparkSession
    root: str
    trip_file: Callable[[date], str]
    weather: Callable[[], DataFrame]
    zones: Callable[[], DataFrame]
    rules: CleanRules = CleanRules()
    first: date = months.FIRST_MONTH
    last: date = months.LAST_MONTH

    def __post_init__(self) -> None:
        configure(self.spark)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def snapshot(self) -> Snapshot:
        """All tables as of the last complete run; what is read from it stays as it is."""
        return snapshots.snapshot(self.spark, self.root)

    def read(self, name: str) -> DataFrame:
        """A table as of the last complete run."""
        return self.snapshot().read(name)

    def run_next(self) -> DataFrame:
        """Process the next month; returns the row that describes the step.

        After the last month nothing is loaded, but the marts are rebuilt. The month is
        marked after the commit: a run that fails before that is repeated as a whole, and
        repeating it changes nothing but the attempt's folders.
        """
        finished = months.read_months(self.spark, self.path("months"))
        step = months.next_batch_month(finished, self.first, self.last)
        plan = step.first()
        change = snapshots.begin(self.spark, self.root)
        if not plan["is_valid"]:
            self.refresh_dimensions(change, change.read("cleaned"))
            self.rebuild_fact(change, None)
            change.commit()
            return self.spark.createDataFrame([plan], step.schema)
        month = date(plan["year"], plan["month"], 1)
        load_new_files(
            self.spark, [self.trip_file(month)], self.path("staging"), self.path("files")
        )
        batch = self.clean_month(change, month)
        changed = self.refresh_dimensions(change, batch)
        first = F.trunc("pickup_datetime", "month")
        own = {row[0] for row in batch.select(first).distinct().collect()}
        self.rebuild_fact(change, None if changed is None else own | changed)
        change.commit()
        months.mark_batch_complete(self.spark, self.path("months"), month)
        return self.spark.createDataFrame([plan], step.schema)

    def clean_month(self, change: Change, month: date) -> DataFrame:
        """Clean and store the rows of one file, in place of that month's earlier ones."""
        name = self.trip_file(month)
        raw = read_staging(self.spark, self.path("staging"), name)
        if raw.isEmpty():
            raise ValueError(f"no trips were loaded from {name}")
        label = f"{month:%Y-%m}"
        cleaned = clean_trips(raw, self.rules).withColumn(BATCH, F.lit(label))
        change.write_parts("cleaned", cleaned, BATCH, replaces=[label])
        if not change.has("cleaned"):
            raise ValueError(f"no trip of {name} passes the cleaning rules")
        return change.read("cleaned").where(F.col(BATCH) == label)

    def _source(self, change: Change, name: str, read: Callable[[], DataFrame]) -> tuple[DataFrame | None, tuple]:
        """Stored rows of an optional source, None when it can't be read, and its state.

        The source is read to its end here, as a file may prove broken only then. What fails
        later is an error.
        """
        table, dimension = f"{name}_source", {"zones": "dim_location"}.get(name, f"dim_{name}")
        state = "stale" if change.has(dimension) else "empty"
        try:
            change.write(table, read())
        except Exception as error:  # noqa: BLE001  sources raise what they like
            warnings.warn(f"{name} not refreshed: {error}", stacklevel=2)
            return None, (name, state, 0, str(error).strip().split("\n")[0][:500])
        rows = change.read(table)
        count = rows.count()
        # No rows tell nothing about the members that are there: they keep what they have.
        return (rows, (name, "fresh", count, None)) if count else (None, (name, state, 0, "no rows"))

    def refresh_dimensions(self, change: Change, batch: DataFrame) -> set[date] | None:
        """Bring all dimensions up to date; the months whose trips look different now.

        None stands for all months. Weather days concern their own month, a moved
        zone may concern any.
        """
        dates = dimensions.calendar_columns(dimensions.distinct_dates(batch))
        self.refresh(change, "dim_time", "time_key", "date_key", dates, one_per_day=True)
        zones, zones_state = self._source(change, "zones", self.zones)
        known = zones if zones is not None else empty_table(self.spark, ZONE_LOOKUP)
        used = dimensions.union_locations(batch)
        if change.has("dim_location"):
            used = used.unionByName(change.read("dim_location").select(*used.columns)).distinct()
        places = dimensions.zone_attributes(used, known)
        moved = self.refresh(change, "dim_location", "location_key", "location_id", places, replace=zones is not None)
        weather, weather_state = self._source(change, "weather", self.weather)
        days = weather if weather is not None else empty_table(self.spark, WEATHER_DAILY)
        days = one_per_day(dimensions.weather_attributes(transform_weather(forward_fill(days))), "date_key")
        changed = self.refresh(change, "dim_weather", "weather_key", "date_key", days, replace=weather is not None)
        change.write("sources", self.spark.createDataFrame([zones_state, weather_state], SOURCES).coalesce(1))
        if moved is not None and not moved.isEmpty():
            return None
        if changed is None:
            return set()
        return {row[0] for row in changed.select(F.trunc("date_key", "month")).distinct().collect()}

    def refresh(
        self,
        change: Change,
        name: str,
        key: str,
        member: str,
        current: DataFrame,
        one_per_day: bool = False,
        replace: bool = True,
    ) -> DataFrame | None:
        """Present members keep their keys, new ones are numbered after them.

        With ``replace`` present members take the attributes of ``current``; those it
        lacks stay as they are. Returns the present members whose attributes changed
        and, for a dimension that trips may lack, the new ones; None in the first run.
        """
        stamp = {"dim_location": "created_at", "dim_weather": "loaded_at"}.get(name)
        stamped = current.withColumn(stamp, F.current_timestamp()) if stamp else current
        present = change.read(name) if change.has(name) else None
        fresh = stamped if present is None else stamped.join(present.select(member), member, "left_anti")
        highest = 0 if present is None else present.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        if one_per_day:
            numbered = keys.dimension_key(fresh, member, key)
        else:
            numbered = keys.dense_key(fresh, [member], key, change.scratch(name))
        added = numbered.withColumn(key, F.col(key) + highest)
        if present is None:
            change.write(name, added)
            return None
        attributes = [c for c in current.columns if c != member]
        kept, changed = present, None
        if replace:
            newer = current.select(member, F.struct(*attributes).alias("_new"))
            both = present.join(newer, member, "left").withColumn("_old", F.struct(*attributes))
            changed = both.where("_new IS NOT NULL AND NOT (_new <=> _old)").select(member)
            taken = F.col("_new").isNotNull()
            kept = both.select(
                *[F.when(taken, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c) for c in present.columns]
            )
        change.write(name, kept.unionByName(added))
        if name != "dim_weather":
            return changed
        gained = added.select(member)
        return gained if changed is None else changed.unionByName(gained)

    def rebuild_fact(self, change: Change, touched: set[date] | None) -> None:
        """Build the given pickup months anew, or all of them, and the offsets of all ranges.

        A batch touches at most twelve months, as the clean rules keep one year.
        Months are read back as time ranges, which file statistics can answer.
        """
        cleaned = change.read("cleaned").drop(BATCH)
        labels = None
        if touched is not None:
            labels = [f"{m:%Y-%m}" for m in touched]
            pickup = F.col("pickup_datetime")
            ranges = [
                (pickup >= F.lit(m).cast("timestamp_ntz"))
                & (pickup < F.add_months(F.lit(m), 1).cast("timestamp_ntz"))
                for m in sorted(touched)
            ]
            cleaned = cleaned.where(reduce(or_, ranges, F.lit(False)))
        dims = [change.read(name) for name in ("dim_time", "dim_location", "dim_weather")]
        rows, offsets = ordered_fact(cleaned, *dims, change.scratch("fact_ranges"))
        before = change.read(FACT_OFFSETS) if change.has(FACT_OFFSETS) else None
        written = change.write_parts("fact", rows, MONTH_PARTITION, replaces=labels)
        if not change.has("fact"):
            raise ValueError(f"no trip has both zones in {self.root}")
        by = StarSchema.FACT_RANGES
        if offsets is None:
            offsets = keys.range_counts(change.read("fact").where(F.col(MONTH_PARTITION).isin(written)), by)
        counts = offsets.select(*by, "_n", "_first")
        if labels is not None and before is not None:
            others = before.where(~F.col(MONTH_PARTITION).isin(labels)).select(*counts.columns)
            counts = others.unionByName(counts)
        change.write(FACT_OFFSETS, keys.offsets_of(counts, by))

    def fact(self, at: Snapshot | None = None) -> DataFrame:
        """The fact table with dense trip keys, as of the last complete run or of ``at``."""
        at = at or self.snapshot()
        staged = with_load_time(at.read("fact"))
        return keys.numbered(staged, at.read(FACT_OFFSETS), StarSchema.FACT_RANGES, "trip_id")
