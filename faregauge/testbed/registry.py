"""One query per operator, each over whole tables."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.functions import calendar, labels
from faregauge.operators import clean, dimensions, fact, features, filters, keys, weather, zones
from faregauge.plans import models, quality, reports
from faregauge.plans.job import MonthlyJob
from faregauge.schemas import WEATHER_DAILY, ZONE_LOOKUP
from faregauge.sources import files, sinks, snapshots
from faregauge.sources import weather as weather_source
from faregauge.sources import zones as zone_source
from faregauge.streaming import loading, months
from faregauge.testbed import tables
from faregauge.testbed.tables import RULES, WINDOW
from faregauge.testbed.workspace import FORESTS, Workspace

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}


def query(*names: str, digits: int | None = 4):
    """Register a function of a workspace; doubles are rounded for comparison."""

    def register(build: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = build(Workspace.open(spark, sf_dir))
            return result if digits is None else rounded(result, digits)

        run.__doc__ = build.__doc__
        for name in names:
            _queries[name] = run
        return build

    return register


def exact(*names: str):
    """Register rows that are equal bit by bit, without rounding."""
    return query(*names, digits=None)


def queries() -> dict[str, Query]:
    return dict(_queries)


def rounded(table: DataFrame, digits: int) -> DataFrame:
    return table.select(
        [
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in table.dtypes
        ]
    )


def raw_columns(table: DataFrame, *derived) -> DataFrame:
    return table.select(clean.PICKUP, clean.DROPOFF, *derived)


FILTER = filters.TripFilter(
    WINDOW,
    weather=["Clear", "Rain", "Snow", "Unknown"],
    temperature=["Cold", "Cool", "Freezing", "Unknown"],
    boroughs=["ASIA", "EUROPE"],
)
BOROUGHS = ["AMERICA", "ASIA"]

# --- sources --------------------------------------------------------------------


@exact("scan_trips")
def _(w: Workspace):
    return files.scan_trips(w.spark, [f"{w.landing}/trip_month=*"])


@exact("discover_files")
def _(w: Workspace):
    return files.discover_files(w.spark, w.landing, "trip_month=*").select("file_name")


@exact("route_files_hourly_daily")
def _(w: Workspace):
    key = F.col("o_orderkey")
    kind = F.when(key % 3 == 0, "Weather_HOURLY_").when(key % 3 == 1, "weather_daily_")
    name = F.concat(kind.otherwise("hourly/weather_"), key.cast("string"), F.lit(".parquet"))
    orders = tables.read(w.spark, w.sf_dir, "orders")
    return weather_source.file_interval(orders.select(F.concat(F.lit("/landing/"), name).alias("path")))


@query("scan_weather_daily")
def _(w: Workspace):
    path = w.fresh(sinks.weather_file_name("daily", "1997-01-01", "1997-12-31"))
    sinks.write_parquet(w.weather_daily().withColumn("station", F.lit(1)), path)
    return weather_source.scan_weather_daily(w.spark, [path])


@exact("scan_weather_hourly")
def _(w: Workspace):
    path = w.fresh(sinks.weather_file_name("hourly", "1997-01-01", "1997-12-31"))
    sinks.write_parquet(w.weather_hourly(), path)
    return weather_source.scan_weather_hourly(w.spark, [path])


@exact("flatten_weather_payload")
def _(w: Workspace):
    """Each observation becomes a response of two hours, written as JSON and read back."""
    first = F.col("datetime")
    later = F.timestamp_add("HOUR", F.lit(1), first)
    times = [F.date_format(t, "yyyy-MM-dd'T'HH:mm") for t in (first, later)]
    pairs = {
        name: F.array(F.col(name), F.col(name) + 1)
        for name in ("temperature_2m", "relative_humidity_2m", "precipitation")
    }
    winds = {
        name: F.array(F.col(name), F.col(name) / 2) for name in ("wind_speed_10m", "wind_direction_10m")
    }
    codes = {"weather_code": F.array(F.col("weathercode"), F.lit(96.0))}
    arrays = {"time": F.array(*times), **pairs, **codes, **winds}
    body = F.struct(*[array.alias(name) for name, array in arrays.items()])
    path = w.fresh("responses")
    w.weather_hourly().select(body.alias("hourly")).write.json(path)
    return weather_source.flatten_payload(weather_source.scan_payloads(w.spark, path))


@exact("scan_zone_lookup_raw")
def _(w: Workspace):
    return zone_source.scan_zone_lookup_raw(w.spark, w.zone_csv_raw)


@query("scan_zone_lookup")
def _(w: Workspace):
    return zone_source.scan_zone_lookup(w.spark, w.zone_csv)


@query("zone_coverage")
def _(w: Workspace):
    return zone_source.zone_coverage(zone_source.scan_zone_lookup(w.spark, w.zone_csv))


@exact("empty_table_fallback")
def _(w: Workspace):
    """Every zone in use and its trips when the zone file is missing and the weather file breaks
    while it is read: attributes and weather are NULL or stand-ins, no trip is lost."""
    unreadable = F.raise_error(F.lit("unreadable block")).cast("double")
    job = MonthlyJob(
        w.spark,
        w.fresh("fallback"),
        lambda month: f"{w.landing}/trip_month={month:%Y-%m}",
        lambda: w.weather_daily().withColumn("precipitation_sum", unreadable),
        lambda: zone_source.scan_zone_lookup(w.spark, w.store.path("no_such_zones")),
        RULES,
    )
    change = snapshots.begin(w.spark, job.root)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        job.refresh_dimensions(change, w.star.cleaned())
    dims = [change.read(name) for name in ("dim_time", "dim_location", "dim_weather")]
    trips = fact.build_fact(w.star.cleaned(), *dims).groupBy(F.col("pickup_location_key").alias("location_key")).agg(
        F.count("*").alias("trips"),
        F.count_if(F.col("weather_key") == -1).alias("trips_without_weather"),
        F.min("temperature_2m").alias("least_temperature"),
        F.max("weather_description").alias("weather_description"),
    )
    states = change.read("sources").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "source_name", "state"))), ",").alias("s"))
    places = dims[1].drop("created_at").join(trips, "location_key", "left").drop("location_key")
    return places.withColumn("trips", F.coalesce("trips", F.lit(0))).withColumn("sources", F.lit(states.first()["s"]))


@exact("scan_zone_vertices")
def _(w: Workspace):
    path = w.fresh("vertices")
    sinks.write_parquet(tables.zone_vertices(w.spark, w.sf_dir), path)
    return zone_source.scan_zone_vertices(w.spark, path)


@exact("audit_files")
def _(w: Workspace):
    """Audit of all part files, summed up per month."""
    audit = files.audit_files(w.spark, f"{w.landing}/trip_month=*")
    month = F.regexp_extract("path", "trip_month=([0-9-]+)", 1).alias("trip_month")
    return audit.groupBy(month).agg(
        F.sum("row_count").alias("row_count"), F.bool_and("is_readable").alias("is_readable")
    )


@query("scan_features", "build_features")
def _(w: Workspace):
    return w.star.features().drop("feature_id")


@query("feature_importance", digits=6)
def _(w: Workspace):
    """Both importances of every feature, on the stand-in that SQL can compute as well."""
    return w.correlation_results()


@query("scan_ml_results", digits=6)
def _(w: Workspace):
    """The stored table of importances, read back by its declared schema."""
    stored = w.store.table("stand_in_results", lambda path: sinks.write_mart(w.correlation_results(), path))
    return w.spark.read.schema(stored.schema).parquet(w.store.path("stand_in_results"))


@exact("describe_table")
def _(w: Workspace):
    return files.describe_table(w.trips(), "trips_raw")


# --- sinks ----------------------------------------------------------------------


@exact("sink_mart")
def _(w: Workspace):
    path = w.fresh("mart")
    sinks.write_mart(w.star.fact(), path, filters.MONTH_PARTITION, laid_out=True)
    return w.spark.read.parquet(path).drop("loaded_at")


@exact("sink_cleaned_parquet")
def _(w: Workspace):
    path = w.fresh("cleaned.parquet")
    sinks.write_parquet(w.star.cleaned(), path)
    return w.spark.read.parquet(path)


@query("sink_weather_parquet")
def _(w: Workspace):
    path = w.fresh(sinks.weather_file_name("daily", "1997-01-01", "1997-12-31"))
    sinks.write_parquet(weather.daily_weather(w.weather_hourly()), path)
    return w.spark.read.schema(WEATHER_DAILY).parquet(path)


@query("sink_zone_csv")
def _(w: Workspace):
    path = w.fresh("zones.csv")
    sinks.write_zone_csv(w.enriched_zones(), path)
    return w.spark.read.schema(ZONE_LOOKUP).csv(path, header=True)


@exact("sink_fact_export_csv")
def _(w: Workspace):
    path = w.fresh("fact_export.csv")
    trips = w.star.fact(first=1_000_000).drop("loaded_at")
    sinks.write_csv(trips, path)
    return w.spark.read.schema(trips.schema).csv(path, header=True)


@query("sink_daily_stats_csv")
def _(w: Workspace):
    path = w.fresh("daily_stats.csv")
    stats = reports.q_daily_stats(w.star.fact_rows(), w.star.dim_time())
    sinks.write_csv(stats, path)
    return w.spark.read.schema(stats.schema).csv(path, header=True)


@query("sink_features")
def _(w: Workspace):
    path = w.fresh("features.parquet")
    sinks.write_parquet(w.star.features(), path)
    return w.spark.read.parquet(path)


@query("sink_ml_results", digits=6)
def _(w: Workspace):
    path = w.fresh("ml_results.parquet")
    sinks.write_parquet(w.correlation_results(), path)
    return w.spark.read.parquet(path)


@query("sink_metrics_json")
def _(w: Workspace):
    path = w.fresh("metrics.json")
    metrics = models.all_metrics(w.metrics)
    sinks.write_metrics(metrics, path)
    again = w.spark.read.schema(metrics.schema).json(path)
    lost = again.exceptAll(metrics).count() + metrics.exceptAll(again).count()
    return again.select("model", "n_train", "n_test", F.lit(lost == 0).alias("is_unchanged"))


@query("sink_models")
def _(w: Workspace):
    """Both saved models, loaded again, score the whole feature matrix: do they beat its mean?"""
    assert w.metrics

    def scored(forest: models.Forest) -> DataFrame:
        predicted = models.load_model(w.spark, w.model_path(forest)).transform(w.star.features())
        errors = predicted.agg(*models.error_measures(forest.target), F.count("prediction").alias("scored_rows"))
        return errors.select(F.lit(forest.name).alias("model"), "scored_rows", (F.col("r2") > 0).alias("beats_mean"))

    return scored(FORESTS[0]).unionByName(scored(FORESTS[1]))


# --- incremental loading --------------------------------------------------------


def landing_sets(w: Workspace) -> list[str]:
    """Data sets in the landing folder: one name per month."""
    found = files.discover_files(w.spark, w.landing, "trip_month=*")
    return [row["file_path"] for row in found.collect()]


@exact("load_new_files", "anti_files")
def _(w: Workspace):
    """Half of the months, then all, then all again: every trip once."""
    staging, ledger = w.fresh("staging"), w.fresh("files")
    sets = landing_sets(w)
    loading.load_new_files(w.spark, sets[::2], staging, ledger)
    loading.load_new_files(w.spark, sets, staging, ledger)
    assert loading.load_new_files(w.spark, sets, staging, ledger).isEmpty()
    return loading.read_staging(w.spark, staging)


@exact("stream_new_files")
def _(w: Workspace):
    """The stream, started twice on the same checkpoint."""
    target, checkpoint = w.fresh("stream"), w.fresh("checkpoint")
    for _ in range(2):
        trips = loading.stream_new_files(w.spark, f"{w.landing}/trip_month=*", target, checkpoint)
    return trips


@exact("ledger_guard")
def _(w: Workspace):
    """A staging folder without a ledger is refused; its rows are counted as they are."""
    staging, ledger = w.fresh("staging"), w.fresh("files")
    sinks.write_parquet(w.trips(), staging)
    try:
        loading.ledger_guard(w.spark, staging, ledger)
        refused = False
    except RuntimeError:
        refused = True
    return w.spark.read.parquet(staging).agg(
        F.count("*").alias("row_count"), F.lit(refused).alias("is_refused")
    )


def trip_months(w: Workspace) -> DataFrame:
    """Months with order dates, as a ledger of finished months would list them."""
    orders = tables.read(w.spark, w.sf_dir, "orders")
    return orders.select(F.trunc("o_orderdate", "month").alias("batch_month")).distinct()


FIRST, LAST = date(1997, 1, 1), date(1997, 6, 1)


@exact("next_batch_month")
def _(w: Workspace):
    """Next month after those before May, and after all months."""
    done = trip_months(w)
    partly = done.where(F.col("batch_month") < F.lit(date(1997, 5, 1)))
    return months.next_batch_month(partly, FIRST, LAST).unionAll(
        months.next_batch_month(done, FIRST, LAST)
    )


@exact("batch_date_range")
def _(w: Workspace):
    batches = trip_months(w).select(
        F.year("batch_month").alias("year"), F.month("batch_month").alias("month")
    )
    return months.batch_date_range(batches)


@exact("mark_batch_complete")
def _(w: Workspace):
    """Marks the first and the last month of the data."""
    ledger = w.fresh("months")
    ends = trip_months(w).agg(F.min("batch_month"), F.max("batch_month")).first()
    for month in ends:
        months.mark_batch_complete(w.spark, ledger, month)
    return months.read_months(w.spark, ledger).select("batch_month")


@exact("reset_batches")
def _(w: Workspace):
    """After a reset the first month of the data is due again."""
    ledger = w.fresh("months")
    first, last = trip_months(w).agg(F.min("batch_month"), F.max("batch_month")).first()
    months.mark_batch_complete(w.spark, ledger, last)
    months.reset_batches(w.spark, ledger)
    return months.next_batch_month(months.read_months(w.spark, ledger), first, last)


@query("process_one_batch")
def _(w: Workspace):
    """Half a year month by month, two runs past its end, and the fact per month.

    Zones arrive with the second run and weather with the third, so stored months are
    brought up to date by later ones.
    """
    runs = iter(range(1, 9))
    now = [0]

    def late(run: int, table):
        def read():
            if now[0] < run:
                raise FileNotFoundError(f"not there before run {run}")
            return table()

        return read

    job = MonthlyJob(
        w.spark,
        w.fresh("job"),
        lambda month: f"{w.landing}/trip_month={month:%Y-%m}",
        late(3, w.weather_daily),
        late(2, w.zones),
        RULES,
        FIRST,
        LAST,
    )

    def step() -> bool:
        now[0] = next(runs)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return job.run_next().first()["is_valid"]

    # Six months, then two runs past the end.
    valid = [step() for _ in range(8)]
    assert valid == [True] * 6 + [False] * 2, valid
    trips = job.fact()
    return trips.groupBy(filters.MONTH_PARTITION).agg(
        F.count("*").alias("trips"),
        F.min("trip_id").alias("first_trip_id"),
        F.max("trip_id").alias("last_trip_id"),
        F.sum("total_amount").alias("revenue"),
        F.sum("temperature_2m").alias("temperature_sum"),
    )


@exact("upsert_weather_days", "anti_dates")
def _(w: Workspace):
    return weather.first_file_per_day(tables.weather_reports(w.spark, w.sf_dir))


# --- projections ----------------------------------------------------------------


@exact("clean_trips")
def _(w: Workspace):
    return clean.clean_trips(w.trips(), RULES)


@exact("trip_duration_min")
def _(w: Workspace):
    return raw_columns(w.trips(), clean.raw_minutes().alias("trip_duration_min"))


@exact("trip_duration_whole_min")
def _(w: Workspace):
    return clean.whole_minutes(w.star.cleaned())


@exact("tip_percentage")
def _(w: Workspace):
    share = labels.tip_percentage(F.col("tip_amount"), F.col("fare_amount"))
    return w.trips().select("tip_amount", "fare_amount", share.alias("tip_percentage"))


@exact("temporal_features")
def _(w: Workspace):
    return w.trips().select(clean.PICKUP, *clean.temporal_columns(F.col(clean.PICKUP)))


@exact("cast_and_rename")
def _(w: Workspace):
    return w.trips().select(
        *clean.money_columns(),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("float").alias("trip_distance"),
        *clean.coordinate_columns(),
        *clean.zone_columns(),
    )


@query("clip_weather")
def _(w: Workspace):
    return w.weather_daily().select(
        "date",
        labels.clip(F.col("temperature_2m_mean"), -40, 50).alias("avg_temperature"),
        labels.clip(F.col("precipitation_sum"), 0, 500).alias("total_precipitation"),
    )


@exact("weather_temporal")
def _(w: Workspace):
    day = F.col("date")
    return w.weather_daily().select(
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        calendar.day_name(day).alias("day_of_week"),
        calendar.is_late_week(day).alias("is_weekend"),
    )


@query("temperature_category_clean")
def _(w: Workspace):
    label = labels.feel_label(F.col("temperature_2m")).alias("temperature_category")
    return w.weather_hourly().select("datetime", "temperature_2m", label)


@exact("weather_category_from_code")
def _(w: Workspace):
    code = F.col("weathercode")
    return w.weather_hourly().select(
        "datetime",
        code,
        labels.weather_label(code).alias("weather_category"),
        labels.weather_label(code + 0.9).alias("category_of_fraction"),
    )


@query("dim_weather_projection")
def _(w: Workspace):
    return dimensions.weather_attributes(w.star.weather())


@exact("dim_time_projection")
def _(w: Workspace):
    return dimensions.calendar_columns(dimensions.distinct_dates(w.star.cleaned()))


@query("dim_location_projection")
def _(w: Workspace):
    ids = dimensions.union_locations(w.star.cleaned())
    return dimensions.zone_attributes(ids, w.zones())


@exact("trip_duration_category")
def _(w: Workspace):
    label = labels.duration_label(F.col("trip_duration_min")).alias("trip_duration_category")
    return w.star.cleaned().select("pickup_datetime", "trip_duration_min", label)


@exact("tip_category")
def _(w: Workspace):
    label = labels.tip_label(F.col("fare_amount"), F.col("tip_percentage")).alias("tip_category")
    return w.star.cleaned().select("pickup_datetime", "fare_amount", "tip_percentage", label)


@query("weather_defaults")
def _(w: Workspace):
    columns = [c for c in w.star.fact_rows().columns if c in fact.NO_WEATHER]
    return w.star.fact_rows().select(
        "pickup_datetime", "weather_key", *columns, "weather_description", "temperature_category"
    )


@query("feature_projection", "join_features")
def _(w: Workspace):
    return features.join_features(w.star.cleaned(), w.star.weather(), w.zones())


@exact("impute_median")
def _(w: Workspace):
    columns = ("passenger_count", "trip_distance", "fare_amount")
    return features.impute_median(w.trips().select(clean.PICKUP, *columns), columns)


@exact("encode_borough")
def _(w: Workspace):
    rows = features.join_features(w.star.cleaned(), w.star.weather(), w.zones())
    return features.encode_borough(rows.select("pickup_datetime", "borough"), w.fresh("boroughs"))


@exact("flags_to_int")
def _(w: Workspace):
    flags = w.star.cleaned().select("pickup_datetime", "is_weekend", "is_peak_hour")
    return features.flags_to_int(flags)


@query("drop_empty_columns")
def _(w: Workspace):
    return features.drop_empty_columns(w.star.features().drop("feature_id"), "tip_percentage")


@exact("peak_label")
def _(w: Workspace):
    flag = F.col("is_peak_hour")
    return w.star.cleaned().select(
        "pickup_datetime",
        labels.peak_label(flag).alias("period"),
        labels.peak_label(flag, "Peak (7-9, 17-19)", "Off-peak").alias("time_period"),
    )


@exact("anomaly_type_label")
def _(w: Workspace):
    label = labels.anomaly_label(F.col("trip_distance"), F.col("passenger_count"))
    return raw_columns(w.trips(), "trip_distance", "passenger_count", label.alias("anomaly_type"))


@exact("scalar_functions")
def _(w: Workspace):
    """The remaining scalar functions side by side on every order."""
    moment, name = F.col("o_orderdate"), F.col("o_orderpriority")
    return tables.read(w.spark, w.sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.hour(moment).alias("hour"),
        F.year(moment).alias("year"),
        F.month(moment).alias("month"),
        F.dayofmonth(moment).alias("day"),
        F.quarter(moment).alias("quarter"),
        F.weekofyear(moment).alias("week"),
        calendar.day_number(moment).alias("day_number"),
        F.to_date(moment).alias("day_date"),
        F.substring(name, 1, 1).try_cast("int").alias("digit"),
        F.substring(name, 3, 3).try_cast("int").alias("no_digit"),
        F.lower(F.trim(name)).alias("clean_name"),
        name.contains("URG").alias("is_urgent"),
        F.round(F.col("o_totalprice") / 1000, 1).alias("thousands"),
        (moment >= clean.ntz(datetime(1996, 1, 1))).alias("is_late"),
    )


# --- filters --------------------------------------------------------------------


@exact("f_clean")
def _(w: Workspace):
    return raw_columns(w.trips().where(clean.is_clean(RULES)), "fare_amount", "passenger_count")


@exact("f_analysis_window")
def _(w: Workspace):
    kept = filters.in_window(w.star.fact_rows(), WINDOW)
    return kept.select("pickup_datetime", "tip_percentage", "total_amount")


@exact("f_not_null_locations")
def _(w: Workspace):
    kept = filters.has_zones(w.star.cleaned())
    return kept.select("pickup_datetime", "pickup_location_id", "dropoff_location_id")


@exact("f_valid_coords")
def _(w: Workspace):
    trips = filters.with_pickup_location(w.star.fact_rows(), w.star.dim_location())
    return trips.where(filters.plottable()).select("pickup_datetime", "location_id")


@exact("f_in_list")
def _(w: Workspace):
    """Chosen labels, and the two meanings of an empty choice."""
    trips, places = w.star.fact_rows(), w.star.dim_location()
    choices = {
        "chosen": FILTER,
        "no weather": filters.TripFilter(WINDOW, weather=[]),
        "no borough": filters.TripFilter(WINDOW, boroughs=[]),
    }
    return quality.labelled_counts(
        {name: choice.apply(trips, places) for name, choice in choices.items()}, "choice"
    )


@exact("f_in_subquery", "semi_borough")
def _(w: Workspace):
    kept = filters.pickup_in_boroughs(w.star.fact_rows(), w.star.dim_location(), BOROUGHS)
    return kept.select("pickup_datetime", "pickup_location_key", "total_amount")


@exact("f_out_of_range")
def _(w: Workspace):
    return raw_columns(filters.outside_dates(w.trips(), WINDOW, clean.PICKUP))


@exact("f_known_temperature")
def _(w: Workspace):
    kept = w.star.fact_rows().where(filters.known_temperature())
    return kept.select("pickup_datetime", "temperature_category")


@exact("f_positive_total")
def _(w: Workspace):
    return raw_columns(w.trips().where(filters.positive_total()), "total_amount")


@query("f_row_valid")
def _(w: Workspace):
    days = tables.weather_reports(w.spark, w.sf_dir)
    return days.where(F.col("date").isNotNull()).select("date", "temperature_2m_mean")


# --- joins ----------------------------------------------------------------------


@query("build_fact")
def _(w: Workspace):
    star = w.star
    return fact.build_fact(star.cleaned(), star.dim_time(), star.dim_location(), star.dim_weather())


@query("join_zone_attrs")
def _(w: Workspace):
    return w.star.dim_location().drop("created_at")


@exact("join_location_inner")
def _(w: Workspace):
    trips = filters.with_pickup_location(w.star.fact_rows(), w.star.dim_location())
    return trips.select("pickup_datetime", "borough", "zone_name", "total_amount")


@exact("join_time_inner")
def _(w: Workspace):
    trips = reports.with_time(w.star.fact_rows(), w.star.dim_time(), "date_actual", "season")
    return trips.select("pickup_datetime", "date_actual", "season")


@exact("join_weather_inner")
def _(w: Workspace):
    columns = ("weather_description", "temperature_description")
    trips = reports.with_weather(w.star.fact_rows(), w.star.dim_weather(), *columns)
    return trips.select("pickup_datetime", *columns)


@exact("join_time_weather")
def _(w: Workspace):
    columns = ("weather_description", "temperature_category")
    trips = reports.with_weather(w.star.fact_rows(), w.star.dim_weather(), *columns)
    trips = reports.with_time(trips, w.star.dim_time(), "day_of_week_name")
    return trips.select("pickup_datetime", "day_of_week_name", *columns)


@query("daily_weather", "join_daily_category")
def _(w: Workspace):
    return weather.daily_weather(w.weather_hourly())


@query("join_centroids", digits=6)
def _(w: Workspace):
    return w.enriched_zones()


@query("fk_integrity", "dq_fk")
def _(w: Workspace):
    return quality.fk_integrity(w.trips(), w.star.dim_location())


# --- aggregations ---------------------------------------------------------------


@query("zone_centroid", digits=6)
def _(w: Workspace):
    return zones.zone_centroid(w.vertices())


@query("mean_vertices")
def _(w: Workspace):
    return zones.mean_vertices(w.vertices())


@exact("distinct_dates")
def _(w: Workspace):
    return dimensions.distinct_dates(w.star.cleaned())


@exact("distinct_options")
def _(w: Workspace):
    return reports.options(w.star.fact_rows(), "weather_description")


@query("global_agg")
def _(w: Workspace):
    return reports.overview(w.star.fact_rows(), F.sum("total_amount").alias("total_revenue"))


@query("group_agg")
def _(w: Workspace):
    names = ("borough", "zone_name", "weather_description", "is_peak_hour")
    trips = filters.with_pickup_location(w.star.fact_rows(), w.star.dim_location())
    return reports.grouped(trips, names, reports.TIP, reports.TOTAL)


@exact("conditional_sum", "a10_outliers")
def _(w: Workspace):
    return reports.a10_outliers(w.star.fact_rows(), WINDOW)


@query("filtered_counts", "unpivot_counts", "dq_anomalies")
def _(w: Workspace):
    return quality.dq_anomalies(w.trips())


@exact("nunique", "d_map_kpis")
def _(w: Workspace):
    points = reports.d_map(w.star.fact_rows(), w.star.dim_location(), FILTER)
    return reports.d_map_kpis(points)


@query("weather_split_sum", digits=6)
def _(w: Workspace):
    return models.weather_split_sum(w.correlation_results())


# --- windows --------------------------------------------------------------------


@exact("surrogate_key_dim")
def _(w: Workspace):
    return w.star.dim_time()


@query("surrogate_key_fact")
def _(w: Workspace):
    return w.star.fact().drop("loaded_at", filters.MONTH_PARTITION)


@query("forward_fill")
def _(w: Workspace):
    return weather.forward_fill(w.weather_daily())


@query("transform_weather")
def _(w: Workspace):
    return w.star.weather()


@query("dim_weather")
def _(w: Workspace):
    return w.star.dim_weather().drop("loaded_at")


# --- sorts and limits -----------------------------------------------------------


@query("order_by", "a13_borough")
def _(w: Workspace):
    return reports.a13_borough(w.star.fact_rows(), w.star.dim_location(), WINDOW)


@query("order_by_case", "q_day_of_week")
def _(w: Workspace):
    return reports.q_day_of_week(w.star.fact_rows(), w.star.dim_time())


@exact("order_by_severity", "dq_logic_evidence")
def _(w: Workspace):
    return quality.dq_logic_evidence(w.trips())


@query("top_k", "a12_top_zones")
def _(w: Workspace):
    return reports.a12_top_zones(w.star.fact_rows(), w.star.dim_location(), WINDOW)


@query("n_largest", digits=6)
def _(w: Workspace):
    return models.top_weather_features(w.correlation_results())


@exact("limit_preview")
def _(w: Workspace):
    """The first ten trips; the dense key makes the limit a filter."""
    return clean.whole_minutes(w.star.fact(first=10))


@exact("mart_sort")
def _(w: Workspace):
    """Every stored range of the fact with its first and last pickup: no two overlap."""
    staged = w.store.path("fact")
    assert w.star.fact_rows() is not None
    ranges = w.spark.read.parquet(staged).groupBy(*w.star.FACT_RANGES).agg(
        F.min("pickup_datetime").alias("first"), F.max("pickup_datetime").alias("last")
    )
    before = F.lag("last").over(keys.Window.orderBy(*w.star.FACT_RANGES))
    return ranges.withColumn("_before", before).agg(
        F.min("first").alias("first_pickup"),
        F.max("last").alias("last_pickup"),
        F.bool_and(F.coalesce(F.col("_before") <= F.col("first"), F.lit(True))).alias("is_sorted"),
    )


@query("sort_result")
def _(w: Workspace):
    return reports.d_weather_summary(
        w.star.fact_rows(), w.star.dim_location(), FILTER, sort_by="avg_trip_duration_min"
    )


# --- set operations -------------------------------------------------------------


@exact("union_locations")
def _(w: Workspace):
    return dimensions.union_locations(w.star.cleaned())


@exact("union_all_counts", "dq_retention")
def _(w: Workspace):
    return quality.dq_retention(w.trips(), w.star.cleaned(), w.star.fact_rows())


@exact("append_files")
def _(w: Workspace):
    """Two halves of the trips whose columns differ in order, number and type."""
    trips = w.trips()
    odd = trips.where(F.col("VendorID") % 2 == 1)
    even = trips.where(F.col("VendorID") % 2 == 0)
    other = even.select(*reversed(even.columns)).drop("Airport_fee", "cbd_congestion_fee")
    other = other.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    return files.append_files([odd, other.withColumn("new_column", F.lit(1))])


@query("feature_union", digits=6)
def _(w: Workspace):
    """Each side lacks one feature of the other."""
    results = w.correlation_results()
    tip = results.where(F.col("feature_name") != "hour").select("feature_name", "importance_tip")
    duration = results.where(F.col("feature_name") != "borough_enc").select(
        "feature_name", "importance_duration"
    )
    return models.feature_union(tip, duration)


# --- reports --------------------------------------------------------------------


def _analysis(name: str, with_locations: bool = False) -> None:
    report = getattr(reports, name)

    @query(name)
    def _(w: Workspace):
        places = [w.star.dim_location()] if with_locations else []
        return report(w.star.fact_rows(), *places, WINDOW)


for _name in (
    "a01_overview",
    "a02_weather",
    "a03_temperature",
    "a04_tip_hour_weather",
    "a05_duration_hour_weather",
    "a06_peak_weather",
    "a07_tip_category",
    "a08_duration_category",
    "a09_quality",
):
    _analysis(_name)
for _name in ("a11_borough_weather", "a14_map"):
    _analysis(_name, with_locations=True)


@query("q_peak")
def _(w: Workspace):
    return reports.q_peak(w.star.fact_rows())


@query("q_weather_top10")
def _(w: Workspace):
    return reports.q_weather_top10(w.star.fact_rows(), w.star.dim_weather())


@query("q_top_locations")
def _(w: Workspace):
    return reports.q_top_locations(w.star.fact_rows(), w.star.dim_location())


@query("q_revenue")
def _(w: Workspace):
    return reports.q_revenue(w.star.fact_rows(), w.star.dim_time())


@query("q_daily_stats")
def _(w: Workspace):
    return reports.q_daily_stats(w.star.fact_rows(), w.star.dim_time())


@query("q_weekday_temperature")
def _(w: Workspace):
    return reports.q_weekday_temperature(w.star.fact_rows(), w.star.dim_time(), w.star.dim_weather())


@exact("d_filters")
def _(w: Workspace):
    return reports.d_filters(w.star.fact_rows(), w.star.dim_location(), WINDOW)


def _dashboard(name: str) -> None:
    report = getattr(reports, name)

    @query(name)
    def _(w: Workspace):
        return report(w.star.fact_rows(), w.star.dim_location(), FILTER)


for _name in (
    "d_overview",
    "d_weather_dist",
    "d_map",
    "d_borough",
    "d_top_zones",
    "d_weather_summary",
    "d_hourly",
    "d_peak",
):
    _dashboard(_name)


@query("s_schema_summary")
def _(w: Workspace):
    star = w.star
    return quality.s_schema_summary(
        star.fact_rows(), star.dim_time(), star.dim_location(), star.dim_weather()
    )


@query("s_clean_report")
def _(w: Workspace):
    return quality.s_clean_report(w.trips(), RULES)


@exact("s_weather_report")
def _(w: Workspace):
    """Daily records as read against those that the transformation leaves."""
    records = w.weather_daily()
    return quality.s_weather_report(records, weather.transform_weather(weather.forward_fill(records)))


def _audit(name: str, *arguments) -> None:
    audit = getattr(quality, name)

    @query(name)
    def _(w: Workspace):
        return audit(w.trips(), *arguments)


for _name in ("dq_null_rates", "dq_financial", "dq_money_summary", "dq_logic", "dq_location_range"):
    _audit(_name)
_audit("dq_temporal", WINDOW)


@exact("dq_temporal_rows")
def _(w: Workspace):
    return quality.dq_temporal_rows(w.trips(), WINDOW)


# --- models ---------------------------------------------------------------------


@query("sample_cap")
def _(w: Workspace):
    return features.sample_cap(w.star.features(), 1500)


@query("split_train_test")
def _(w: Workspace):
    return features.split_train_test(w.star.features()).select("feature_id", "is_training", "fold")


@query("evaluate")
def _(w: Workspace):
    """Errors of a simple predictor: the mean trip duration of the pickup hour."""
    rows = features.split_train_test(w.star.features())
    means = rows.where("is_training").groupBy("hour").agg(F.avg("trip_duration_min").alias("prediction"))
    scored = rows.join(means, "hour").withColumn("actual", F.col("trip_duration_min"))
    return models.evaluate(scored, "actual", "is_training")


def trained(w: Workspace, forest: models.Forest) -> DataFrame:
    """Rows of each part, number of inputs, and whether the fit beats the mean of its training part."""
    rows = features.split_train_test(w.star.features()).where("is_training")
    spread = rows.agg(F.stddev_pop(forest.target)).first()[0]
    used = len(models.load_model(w.spark, w.model_path(forest)).inputs) if w.metrics else 0
    beats = (F.col("train_rmse") < spread).alias("beats_mean")
    return w.metrics[forest.name].select("model", "n_train", "n_test", F.lit(used).alias("n_features"), beats)


@query("train_tip")
def _(w: Workspace):
    return trained(w, FORESTS[0])


@query("train_duration")
def _(w: Workspace):
    return trained(w, FORESTS[1])


@query("cross_validate")
def _(w: Workspace):
    """Rows that each fold fits and holds out, and whether the errors of all folds could be taken."""
    rows = features.split_train_test(w.star.features()).where("is_training")
    taken = models.all_metrics(w.metrics).select("model", ((F.col("cv_rmse") > 0) & (F.col("cv_mae") <= F.col("cv_rmse"))).alias("is_measured"))
    folds = rows.groupBy("fold").agg(F.count("*").alias("n_held_out"))
    total = rows.count()
    return folds.withColumn("n_fit", F.lit(total) - F.col("n_held_out")).crossJoin(F.broadcast(taken))


@query("model_metrics")
def _(w: Workspace):
    """All errors of both forests, cross-validated, on the training and on the test part."""
    return models.all_metrics(w.metrics)


@query("forest_importance")
def _(w: Workspace):
    """Importances of the fitted forests, which no SQL can state."""
    return w.ml_results()


@query("weather_impact")
def _(w: Workspace):
    """Share of the importance that weather carries, on the stand-in."""
    return models.weather_impact(w.correlation_results())
