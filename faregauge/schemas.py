"""Declared schemas of all inputs, so that no reader has to infer one."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


TRIPS_RAW = _struct(
    VendorID=IntegerType,
    tpep_pickup_datetime=TimestampNTZType,
    tpep_dropoff_datetime=TimestampNTZType,
    passenger_count=LongType,
    trip_distance=DoubleType,
    RatecodeID=LongType,
    store_and_fwd_flag=StringType,
    PULocationID=IntegerType,
    DOLocationID=IntegerType,
    payment_type=LongType,
    fare_amount=DoubleType,
    extra=DoubleType,
    mta_tax=DoubleType,
    tip_amount=DoubleType,
    tolls_amount=DoubleType,
    improvement_surcharge=DoubleType,
    total_amount=DoubleType,
    congestion_surcharge=DoubleType,
    Airport_fee=DoubleType,
    cbd_congestion_fee=DoubleType,
)

WEATHER_HOURLY = _struct(
    datetime=TimestampNTZType,
    temperature_2m=DoubleType,
    relative_humidity_2m=DoubleType,
    precipitation=DoubleType,
    weathercode=DoubleType,
    wind_speed_10m=DoubleType,
    wind_direction_10m=DoubleType,
    weather_category=StringType,
)

WEATHER_DAILY = _struct(
    date=DateType,
    temperature_2m_mean=DoubleType,
    temperature_2m_min=DoubleType,
    temperature_2m_max=DoubleType,
    relative_humidity_2m_mean=DoubleType,
    precipitation_sum=DoubleType,
    wind_speed_10m_mean=DoubleType,
    wind_direction_10m_mean=DoubleType,
    weathercode=DoubleType,
    weather_category=StringType,
)

WEATHER_TRANSFORMED = _struct(
    date_actual=DateType,
    avg_temperature=DoubleType,
    min_temperature=DoubleType,
    max_temperature=DoubleType,
    total_precipitation=DoubleType,
    avg_humidity=DoubleType,
    wind_speed=DoubleType,
    wind_direction=DoubleType,
    weather_code=DoubleType,
    weather_category=StringType,
    year=IntegerType,
    month=IntegerType,
    day_of_week=StringType,
    is_weekend=BooleanType,
    temperature_category=StringType,
)

# One API response: parallel arrays under "hourly".
WEATHER_PAYLOAD = StructType(
    [
        StructField(
            "hourly",
            StructType(
                [StructField("time", ArrayType(StringType()))]
                + [
                    StructField(name, ArrayType(DoubleType()))
                    for name in (
                        "temperature_2m",
                        "relative_humidity_2m",
                        "precipitation",
                        "weather_code",
                        "wind_speed_10m",
                        "wind_direction_10m",
                    )
                ]
            ),
        )
    ]
)

ZONE_CSV_RAW = _struct(
    LocationID=StringType, Borough=StringType, Zone=StringType, service_zone=StringType
)

ZONE_LOOKUP = _struct(
    location_id=IntegerType,
    borough=StringType,
    zone=StringType,
    service_zone=StringType,
    latitude=FloatType,
    longitude=FloatType,
)

ZONE_VERTICES = _struct(
    location_id=IntegerType,
    shape_index=IntegerType,
    vertex_index=IntegerType,
    x=DoubleType,
    y=DoubleType,
)

FILE_LEDGER = _struct(file_path=StringType, loaded_at=TimestampType)

BATCH_LEDGER = _struct(batch_month=DateType, completed_at=TimestampType)

ML_RESULTS = _struct(
    feature_name=StringType,
    importance_tip=DoubleType,
    importance_duration=DoubleType,
    importance_avg=DoubleType,
    is_weather=BooleanType,
)
