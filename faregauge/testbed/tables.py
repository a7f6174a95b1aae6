"""Trips, weather and zones derived from the generated order tables.

One deterministic mapping; ``oracle.py`` states the same in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.functions.labels import weather_label
from faregauge.schemas import TRIPS_RAW, WEATHER_HOURLY, ZONE_LOOKUP
from faregauge.settings import CleanRules, Window
from faregauge.sources.files import path_size, spread_small

# The order dates lie in the nineties, so rules and window move there.
RULES = CleanRules(year=1997)
WINDOW = Window(date(1997, 1, 1), date(1997, 7, 1))
CODES = (0, 1, 2, 3, 51, 61, 63, 71, 80, 95, 66, 45)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Like :func:`read`, on all cores even if the table is one small file."""
    size = path_size(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_small(read(spark, sf_dir, name), size)


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item, in the schema of a monthly trip file plus its month.

    A shuffle join on the order key; adaptive execution splits hot orders.
    """
    lines, orders = read_spread(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    order, part, supplier, line = (
        F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    start = F.timestamp_add(
        "MINUTE", ((order * 37 + line * 101 + part * 7) % 1440).cast("int"), F.col("o_orderdate")
    )
    ride = ((part * 13 + line * 7 + supplier) % 360 - 20).cast("int")
    price = F.col("l_extendedprice") / 1000
    fare = F.when(part % 29 == 0, -price).when(part % 31 == 0, F.lit(0.0)).otherwise(price)
    joined = lines.join(orders, order == F.col("o_orderkey")).withColumns(
        {"_start": start, "_ride": ride, "_fare": fare}
    )
    fare = F.col("_fare")
    tip = (
        F.when(fare <= 0, F.lit(0.0)).when(part % 23 == 0, fare * 2.5).otherwise(fare * F.col("l_discount") * 3)
    )
    extra = F.col("l_tax") * 10
    tolls = F.when(line == 7, 6.5).otherwise(F.lit(0.0))
    columns = {
        "VendorID": line % 2 + 1,
        "tpep_pickup_datetime": F.col("_start"),
        "tpep_dropoff_datetime": F.timestamp_add("MINUTE", F.col("_ride"), F.col("_start")),
        "passenger_count": F.when(order % 50 != 0, line % 7),
        "trip_distance": F.col("l_quantity"),
        "RatecodeID": line,
        "store_and_fwd_flag": F.col("l_linestatus"),
        "PULocationID": F.when(order % 97 != 0, supplier % 25 + 1),
        "DOLocationID": part % 27 + 1,
        "payment_type": line % 4,
        "fare_amount": fare,
        "extra": extra,
        "mta_tax": F.lit(0.5),
        "tip_amount": tip,
        "tolls_amount": tolls,
        "improvement_surcharge": F.lit(1.0),
        "total_amount": fare + extra + 0.5 + tip + tolls,
        "congestion_surcharge": F.when(supplier % 2 == 0, 2.5).otherwise(0.0),
        "Airport_fee": F.when(part % 27 == 0, 1.75).otherwise(0.0),
        "cbd_congestion_fee": F.lit(0.75),
    }
    return joined.select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in TRIPS_RAW],
        F.date_format(F.to_date("o_orderdate"), "yyyy-MM").alias("trip_month"),
    )


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per order, with gaps in values, and days without any.

    Observations of every tenth day of a month count for the day before, so trips of
    these days lack weather. Days whose number from 1970 is a multiple of 23 have neither
    temperature nor code, and so do the first ones of the table.
    """
    ordered, key, customer = (F.col(c) for c in ("o_orderdate", "o_orderkey", "o_custkey"))
    code = F.element_at(F.array(*map(F.lit, CODES)), (key % len(CODES) + 1).cast("int"))
    day = F.when(F.dayofmonth(ordered) % 10 == 0, F.date_sub(F.to_date(ordered), 1)).otherwise(F.to_date(ordered))
    number = F.datediff(day, F.lit("1970-01-01").cast("date"))
    seen = (number % 23 != 0) & (day >= F.lit("1995-01-10").cast("date"))
    day = day.cast("timestamp_ntz")
    code = F.when((key % 31 != 0) & seen, code).cast("double")
    columns = {
        "datetime": F.timestamp_add("HOUR", (key * 7 % 24).cast("int"), day),
        "temperature_2m": F.when((key % 17 != 0) & seen, customer % 95 - 42),
        "relative_humidity_2m": customer % 100,
        "precipitation": key % 13 * 50 - 10,
        "weathercode": code,
        "wind_speed_10m": customer % 40,
        "wind_direction_10m": customer * 7 % 360,
        "weather_category": weather_label(code),
    }
    return read(spark, sf_dir, "orders").select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in WEATHER_HOURLY]
    )


def weather_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily record per order, from four files that overlap in dates.

    Dates repeat inside a file as well, and some records have no date.
    """
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, sf_dir, "orders").select(
        F.when(key % 101 != 0, F.to_date("o_orderdate")).alias("date"),
        (customer % 95 - 42).cast("double").alias("temperature_2m_mean"),
        (key % 13 * 50 - 10).cast("double").alias("precipitation_sum"),
        (key % 4 + 1).cast("int").alias("file_rank"),
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone per nation with its region as borough."""
    nations, regions = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    number = F.col("n_nationkey")
    columns = {
        "location_id": number + 1,
        "borough": F.col("r_name"),
        "zone": F.col("n_name"),
        "service_zone": F.concat(F.lit("Zone "), F.col("r_regionkey").cast("string")),
        "latitude": F.when(number % 11 != 10, F.lit(40.5) + number * F.lit(0.025)),
        "longitude": F.lit(-74.3) + number * F.lit(0.03),
    }
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in ZONE_LOOKUP]
    )


def zone_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw zone rows from customers: padded, plain and unusable ids."""
    key = F.col("c_custkey")
    number = key.cast("string")
    return read(spark, sf_dir, "customer").select(
        F.when(key % 5 == 0, F.concat(F.lit("x"), number))
        .when(key % 5 == 1, F.concat(F.lit(" "), number, F.lit(" ")))
        .otherwise(number)
        .alias("LocationID"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("Borough"),
        F.concat(F.col("c_name"), F.lit(" ")).alias("Zone"),
        F.concat(F.lit("Zone "), F.col("c_nationkey").cast("string")).alias("service_zone"),
    )


def zone_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary vertices in feet from customers: three shapes per nation."""
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        (F.col("c_nationkey") + 1).cast("int").alias("location_id"),
        (key % 3).cast("int").alias("shape_index"),
        key.cast("int").alias("vertex_index"),
        (key * 137 % 150000 + 913000).cast("double").alias("x"),
        (key * 61 % 150000 + 120000).cast("double").alias("y"),
    )
