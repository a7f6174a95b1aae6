"""SQL twins of the registered queries.

``RELATIONS`` states each derived table once, in terms of the given tables and of
earlier relations; ``_sql`` puts those a query needs in front of it.
"""

from __future__ import annotations

import re

from faregauge.settings import WEATHER_LABELS

_CODES = "[0,1,2,3,51,61,63,71,80,95,66,45]"
_LABEL_LISTS: dict[str, list[int]] = {}
for _code, _label in WEATHER_LABELS.items():
    _LABEL_LISTS.setdefault(_label, []).append(_code)


def _weather_label(code: str) -> str:
    arms = " ".join(
        f"WHEN trunc({code}) IN ({', '.join(map(str, codes))}) THEN '{label}'"
        for label, codes in _LABEL_LISTS.items()
    )
    return f"CASE WHEN {code} IS NULL THEN 'Unknown' {arms} ELSE 'Other' END"


def _feel(t: str) -> str:
    return (
        f"CASE WHEN {t} < 0 THEN 'Cold' WHEN {t} <= 15 THEN 'Cool' WHEN {t} <= 25 THEN 'Mild'"
        f" WHEN {t} <= 35 THEN 'Warm' ELSE 'Hot' END"
    )


def _clipped(v: str, low: int, high: int) -> str:
    return f"CASE WHEN {v} IS NOT NULL THEN greatest({low}.0, least({high}.0, {v})) END"


def _minutes(start: str, end: str) -> str:
    return f"epoch_us({end} - {start}) / 1e6 / 60"


def _named(*columns: str, digits: int = 4) -> str:
    """``avg`` of each column, rounded, under its report name."""
    return ", ".join(f"round(avg({c}), {digits}) AS avg_{c}" for c in columns)


_RAW_MINUTES = _minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
_W = (
    "pickup_datetime >= TIMESTAMP '1997-01-01' AND pickup_datetime < TIMESTAMP '1997-07-01'"
    " AND tip_percentage >= 0 AND tip_percentage <= 100"
)
_CHOSEN = (
    f"{_W} AND weather_description IN ('Clear', 'Rain', 'Snow', 'Unknown')"
    " AND temperature_category IN ('Cold', 'Cool', 'Freezing', 'Unknown')"
)
_HERE = "borough IN ('ASIA', 'EUROPE')"
_ON_MAP = "latitude BETWEEN 40.4 AND 41.0 AND longitude BETWEEN -74.4 AND -73.5"
_CLEAN = (
    f"fare_amount >= 0 AND ({_RAW_MINUTES})::FLOAT BETWEEN 0 AND 300 AND passenger_count > 0"
    " AND year(tpep_pickup_datetime) = 1997"
)

TRIP_COLUMNS = (
    '"VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,'
    ' "RatecodeID", store_and_fwd_flag, "PULocationID", "DOLocationID", payment_type, fare_amount,'
    " extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,"
    ' congestion_surcharge, "Airport_fee", cbd_congestion_fee'
)

_MONEY = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount")
_NO_COORDINATES = ", ".join(
    f"NULL::FLOAT AS {end}_{axis}itude" for end in ("pickup", "dropoff") for axis in ("long", "lat")
)
_MONEY_CASTS = ", ".join(f"{c}::FLOAT AS {c}" for c in _MONEY)
_ZONE_CASTS = (
    '"PULocationID" AS pickup_location_id, "DOLocationID" AS dropoff_location_id,'
    ' "RatecodeID"::INT AS rate_code_id, store_and_fwd_flag'
)
_TIP_PERCENTAGE = "CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0 END::FLOAT"
_TEMPORAL = (
    "hour({0})::INT AS hour_of_day, dayname({0}) AS day_of_week, dayofweek({0})::INT AS dow_numeric,"
    " dayofweek({0}) IN (5, 6) AS is_weekend, hour({0}) IN (7, 8, 9, 17, 18, 19) AS is_peak_hour"
)
_DURATION_LABEL = (
    "CASE WHEN trip_duration_min < 1 THEN 'Very short' WHEN trip_duration_min < 5 THEN 'Short'"
    " WHEN trip_duration_min < 15 THEN 'Medium' WHEN trip_duration_min < 30 THEN 'Long'"
    " ELSE 'Very long' END"
)
_TIP_LABEL = (
    "CASE WHEN fare_amount = 0 THEN 'No charge' WHEN coalesce(tip_percentage, 0) = 0 THEN 'No tip'"
    " WHEN tip_percentage < 10 THEN 'Low tip' WHEN tip_percentage < 20 THEN 'Standard tip'"
    " ELSE 'High tip' END"
)
_FILLED = (
    "temperature_2m_mean",
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "relative_humidity_2m_mean",
    "wind_speed_10m_mean",
    "wind_direction_10m_mean",
    "weathercode",
)
_TRIP_ORDER = (
    "pickup_datetime, dropoff_datetime, pickup_location_key, dropoff_location_key, rate_code_id,"
    " passenger_count, trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,"
    " total_amount, tip_percentage, store_and_fwd_flag, weather_key"
)
_FEATURES = (
    "temperature_c",
    "precipitation_mm",
    "wind_speed",
    "weathercode",
    "hour",
    "is_weekend",
    "is_peak_hour",
    "trip_distance",
    "passenger_count",
    "borough_enc",
    "tip_percentage",
    "trip_duration_min",
)


def _nulls_last(columns) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns)


def _centre_rounds(rounds: int = 5) -> str:
    """The iterations for the latitude, one nested query each."""
    query = "SELECT *, pi() / 2 - 2 * atan(t) AS phi FROM started"
    for _ in range(rounds):
        query = (
            "SELECT * EXCLUDE (phi), pi() / 2 - 2 * atan(t * pow((1 - ecc * sin(phi))"
            f" / (1 + ecc * sin(phi)), ecc / 2)) AS phi FROM ({query})"
        )
    return query


RELATIONS = {
    "trips_raw": """
        SELECT (l_linenumber % 2 + 1)::INT AS "VendorID", start AS tpep_pickup_datetime,
          start + to_minutes(ride) AS tpep_dropoff_datetime,
          CASE WHEN l_orderkey % 50 <> 0 THEN l_linenumber % 7 END::BIGINT AS passenger_count,
          l_quantity AS trip_distance, l_linenumber::BIGINT AS "RatecodeID",
          l_linestatus AS store_and_fwd_flag,
          CASE WHEN l_orderkey % 97 <> 0 THEN l_suppkey % 25 + 1 END::INT AS "PULocationID",
          (l_partkey % 27 + 1)::INT AS "DOLocationID", (l_linenumber % 4)::BIGINT AS payment_type,
          fare AS fare_amount, l_tax * 10 AS extra, 0.5::DOUBLE AS mta_tax, tip AS tip_amount,
          toll AS tolls_amount, 1::DOUBLE AS improvement_surcharge,
          fare + l_tax * 10 + 0.5::DOUBLE + tip + toll AS total_amount,
          CASE WHEN l_suppkey % 2 = 0 THEN 2.5 ELSE 0 END::DOUBLE AS congestion_surcharge,
          CASE WHEN l_partkey % 27 = 0 THEN 1.75 ELSE 0 END::DOUBLE AS "Airport_fee",
          0.75::DOUBLE AS cbd_congestion_fee, strftime(o_orderdate, '%Y-%m') AS trip_month
        FROM (
          SELECT *, CASE WHEN fare <= 0 THEN 0 WHEN l_partkey % 23 = 0 THEN fare * 2.5::DOUBLE
              ELSE fare * l_discount * 3 END AS tip,
            CASE WHEN l_linenumber = 7 THEN 6.5 ELSE 0 END::DOUBLE AS toll
          FROM (
            SELECT *,
              o_orderdate + to_minutes((l_orderkey * 37 + l_linenumber * 101 + l_partkey * 7) % 1440) AS start,
              (l_partkey * 13 + l_linenumber * 7 + l_suppkey) % 360 - 20 AS ride,
              CASE WHEN l_partkey % 29 = 0 THEN -(l_extendedprice / 1000)
                WHEN l_partkey % 31 = 0 THEN 0 ELSE l_extendedprice / 1000 END AS fare
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey))""",
    "trips_clean": f"""
        SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
          ({_RAW_MINUTES})::FLOAT AS trip_duration_min, {_MONEY_CASTS},
          {_TIP_PERCENTAGE} AS tip_percentage, passenger_count::INT AS passenger_count,
          trip_distance::FLOAT AS trip_distance, {_TEMPORAL.format("tpep_pickup_datetime")},
          {_NO_COORDINATES}, {_ZONE_CASTS}
        FROM trips_raw WHERE {_CLEAN}""",
    "hours": f"""
        SELECT *, {_weather_label("weathercode")} AS weather_category FROM (
          SELECT observed + to_hours(o_orderkey * 7 % 24) AS datetime,
            CASE WHEN o_orderkey % 17 <> 0 AND seen THEN o_custkey % 95 - 42 END::DOUBLE AS temperature_2m,
            (o_custkey % 100)::DOUBLE AS relative_humidity_2m,
            (o_orderkey % 13 * 50 - 10)::DOUBLE AS precipitation,
            CASE WHEN o_orderkey % 31 <> 0 AND seen THEN {_CODES}[o_orderkey % 12 + 1] END::DOUBLE AS weathercode,
            (o_custkey % 40)::DOUBLE AS wind_speed_10m,
            (o_custkey * 7 % 360)::DOUBLE AS wind_direction_10m
          FROM (
            SELECT *, observed::DATE - DATE '1970-01-01' <> 23 * ((observed::DATE - DATE '1970-01-01') // 23)
              AND observed::DATE >= DATE '1995-01-10' AS seen
            FROM (
              SELECT *, date_trunc('day', o_orderdate) - to_days((day(o_orderdate) % 10 = 0)::INT) AS observed
              FROM orders)))""",
    "days": """
        SELECT * FROM (
          SELECT datetime::DATE AS date, avg(temperature_2m) AS temperature_2m_mean,
            min(temperature_2m) AS temperature_2m_min, max(temperature_2m) AS temperature_2m_max,
            avg(relative_humidity_2m) AS relative_humidity_2m_mean,
            coalesce(sum(precipitation), 0) AS precipitation_sum,
            avg(wind_speed_10m) AS wind_speed_10m_mean,
            avg(wind_direction_10m) AS wind_direction_10m_mean, avg(weathercode) AS weathercode
          FROM hours GROUP BY ALL)
        JOIN (
          SELECT DISTINCT ON (date) date, weather_category FROM (
            SELECT datetime::DATE AS date, weather_category, count(*) AS n FROM hours GROUP BY ALL)
          ORDER BY date, n DESC, weather_category) USING (date)""",
    "days_filled": "SELECT date, weather_category, "
    + ", ".join(f"last_value({c} IGNORE NULLS) OVER (ORDER BY date) AS {c}" for c in _FILLED)
    + " FROM days",
    "weather_days": f"""
        SELECT date AS date_actual, {_clipped("temperature_2m_mean", -40, 50)} AS avg_temperature,
          temperature_2m_min AS min_temperature, temperature_2m_max AS max_temperature,
          {_clipped("precipitation_sum", 0, 500)} AS total_precipitation,
          relative_humidity_2m_mean AS avg_humidity, wind_speed_10m_mean AS wind_speed,
          wind_direction_10m_mean AS wind_direction, weathercode AS weather_code, weather_category,
          year(date)::INT AS year, month(date)::INT AS month, dayname(date) AS day_of_week,
          dayofweek(date) IN (5, 6) AS is_weekend, {_feel("temperature_2m_mean")} AS temperature_category
        FROM days_filled""",
    "weather_records": """
        SELECT CASE WHEN o_orderkey % 101 <> 0 THEN o_orderdate::DATE END AS date,
          (o_custkey % 95 - 42)::DOUBLE AS temperature_2m_mean,
          (o_orderkey % 13 * 50 - 10)::DOUBLE AS precipitation_sum,
          (o_orderkey % 4 + 1)::INT AS file_rank
        FROM orders""",
    "first_records": """
        SELECT date, temperature_2m_mean, precipitation_sum FROM (
          SELECT *, min(file_rank) OVER (PARTITION BY date) AS best FROM weather_records
          WHERE date IS NOT NULL)
        WHERE file_rank = best""",
    "zone_rows": """
        SELECT n_nationkey + 1 AS location_id, r_name AS borough, n_name AS zone,
          'Zone ' || r_regionkey AS service_zone,
          CASE WHEN n_nationkey % 11 <> 10 THEN 40.5::DOUBLE + n_nationkey * 0.025::DOUBLE END::FLOAT
            AS latitude,
          (-74.3::DOUBLE + n_nationkey * 0.03::DOUBLE)::FLOAT AS longitude
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "csv_zones": """
        SELECT c_custkey::INT AS location_id, c_mktsegment AS borough, c_name AS zone,
          'Zone ' || c_nationkey AS service_zone
        FROM customer WHERE c_custkey % 5 <> 0""",
    "vertices": """
        SELECT c_nationkey + 1 AS location_id, (c_custkey % 3)::INT AS shape_index,
          c_custkey::INT AS vertex_index, (c_custkey * 137 % 150000 + 913000)::DOUBLE AS x,
          (c_custkey * 61 % 150000 + 120000)::DOUBLE AS y
        FROM customer""",
    "centre_feet": """
        SELECT DISTINCT ON (location_id) location_id, x, y FROM (
          SELECT location_id, shape_index, avg(x) AS x, avg(y) AS y FROM vertices GROUP BY ALL)
        ORDER BY location_id, shape_index DESC""",
    "ellipsoid": """
        SELECT sqrt(2 / 298.257222101::DOUBLE - pow(1 / 298.257222101::DOUBLE, 2)) AS ecc,
          radians(41 + 2 / 60::DOUBLE) AS p1, radians(40 + 40 / 60::DOUBLE) AS p2,
          radians(40 + 10 / 60::DOUBLE) AS p0""",
    "cone": """
        SELECT ecc, n, a * m1 / (n * pow(t1, n)) AS factor, a * m1 / (n * pow(t1, n)) * pow(t0, n) AS radius
        FROM (
          SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n, 6378137::DOUBLE AS a FROM (
            SELECT ecc, cos(p1) / sqrt(1 - pow(ecc * sin(p1), 2)) AS m1,
              cos(p2) / sqrt(1 - pow(ecc * sin(p2), 2)) AS m2,
              tan(pi() / 4 - p1 / 2) / pow((1 - ecc * sin(p1)) / (1 + ecc * sin(p1)), ecc / 2) AS t1,
              tan(pi() / 4 - p2 / 2) / pow((1 - ecc * sin(p2)) / (1 + ecc * sin(p2)), ecc / 2) AS t2,
              tan(pi() / 4 - p0 / 2) / pow((1 - ecc * sin(p0)) / (1 + ecc * sin(p0)), ecc / 2) AS t0
            FROM ellipsoid))""",
    "started": """
        SELECT *, pow(sqrt(east * east + north * north) / factor, 1 / n) AS t FROM (
          SELECT *, x * 1200 / 3937 - 300000 AS east, radius - y * 1200 / 3937 AS north
          FROM centre_feet CROSS JOIN cone)""",
    "centres": f"""
        SELECT location_id, round(degrees(phi), 6) AS latitude,
          round(degrees(atan2(east, north) / n) - 74, 6) AS longitude
        FROM ({_centre_rounds()})""",
    "used_zones": """
        SELECT DISTINCT unnest([pickup_location_id, dropoff_location_id]) AS location_id FROM trips_clean""",
    "zone_facts": """
        SELECT location_id, latitude, longitude, round(latitude, 4) AS latitude_rounded,
          round(longitude, 4) AS longitude_rounded, zone AS zone_name, borough, service_zone
        FROM used_zones LEFT JOIN zone_rows USING (location_id) WHERE location_id IS NOT NULL""",
    "places": "SELECT row_number() OVER (ORDER BY location_id) AS location_key, * FROM zone_facts",
    "dates": "SELECT DISTINCT pickup_datetime::DATE AS date_key FROM trips_clean",
    "date_facts": """
        SELECT date_key, date_key AS date_actual, year(date_key)::INT AS year, month(date_key)::INT AS month,
          day(date_key)::INT AS day, quarter(date_key)::INT AS quarter, week(date_key)::INT AS week_of_year,
          dayofweek(date_key)::INT AS day_of_week_number, dayname(date_key) AS day_of_week_name,
          dayofweek(date_key) IN (0, 6) AS is_weekend,
          CASE WHEN month(date_key) IN (12, 1, 2) THEN 'Winter' WHEN month(date_key) < 6 THEN 'Spring'
            WHEN month(date_key) < 9 THEN 'Summer' ELSE 'Fall' END AS season
        FROM dates""",
    "times": "SELECT row_number() OVER (ORDER BY date_key) AS time_key, * FROM date_facts",
    "weather_facts": """
        SELECT date_actual AS date_key, avg_temperature::FLOAT AS temperature_2m,
          avg_humidity::FLOAT AS relative_humidity_2m, total_precipitation::FLOAT AS precipitation,
          wind_speed::FLOAT AS wind_speed_10m, wind_direction::FLOAT AS wind_direction_10m,
          round_even(weather_code, 0)::INT AS weather_code,
          coalesce(weather_category, 'Unknown') AS weather_description,
          coalesce(temperature_category, 'Unknown') AS temperature_description,
          CASE WHEN avg_temperature::FLOAT < 0 THEN 'Freezing' WHEN avg_temperature::FLOAT < 10 THEN 'Cold'
            WHEN avg_temperature::FLOAT < 20 THEN 'Cool' WHEN avg_temperature::FLOAT < 30 THEN 'Warm'
            ELSE 'Hot' END AS temperature_category
        FROM weather_days""",
    "skies": "SELECT row_number() OVER (ORDER BY date_key) AS weather_key, * FROM weather_facts",
    "fact": f"""
        SELECT time_key, p.location_key AS pickup_location_key, d.location_key AS dropoff_location_key,
          coalesce(weather_key, -1) AS weather_key, rate_code_id, store_and_fwd_flag, pickup_datetime,
          dropoff_datetime, hour_of_day, day_of_week, t.is_weekend, is_peak_hour, trip_distance,
          trip_duration_min, passenger_count, {", ".join(_MONEY)}, tip_percentage,
          p.longitude AS pickup_longitude, p.latitude AS pickup_latitude,
          d.longitude AS dropoff_longitude, d.latitude AS dropoff_latitude,
          coalesce(temperature_2m, -999)::FLOAT AS temperature_2m,
          coalesce(relative_humidity_2m, -1)::FLOAT AS relative_humidity_2m,
          coalesce(precipitation, 0)::FLOAT AS precipitation,
          coalesce(wind_speed_10m, -1)::FLOAT AS wind_speed_10m,
          coalesce(weather_description, 'Unknown') AS weather_description,
          coalesce(temperature_category, 'Unknown') AS temperature_category,
          {_DURATION_LABEL} AS trip_duration_category, {_TIP_LABEL} AS tip_category
        FROM (SELECT * EXCLUDE (pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude)
              FROM trips_clean) t
        LEFT JOIN times c ON c.date_key = pickup_datetime::DATE
        LEFT JOIN places p ON p.location_id = pickup_location_id
        LEFT JOIN places d ON d.location_id = dropoff_location_id
        LEFT JOIN skies w ON w.date_key = pickup_datetime::DATE
        WHERE pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL""",
    "keyed": f"""
        SELECT row_number() OVER (ORDER BY {_nulls_last(_TRIP_ORDER.split(", "))}) AS trip_id, *
        FROM fact""",
    "located": """
        SELECT f.*, location_id, borough, zone_name, latitude, longitude
        FROM fact f JOIN places ON pickup_location_key = location_key""",
    "feature_rows": """
        SELECT pickup_datetime, trip_duration_min, tip_percentage, hour_of_day::BIGINT AS hour,
          t.is_weekend, is_peak_hour, trip_distance, passenger_count, avg_temperature AS temperature_c,
          total_precipitation AS precipitation_mm, NULL::DOUBLE AS wind_speed,
          NULL::DOUBLE AS weathercode, borough
        FROM trips_clean t LEFT JOIN weather_days ON date_actual = pickup_datetime::DATE
        LEFT JOIN zone_rows ON location_id = pickup_location_id""",
    "feature_matrix": """
        SELECT coalesce(temperature_c, (SELECT median(temperature_c) FROM feature_rows)) AS temperature_c,
          coalesce(precipitation_mm, (SELECT median(precipitation_mm) FROM feature_rows)) AS precipitation_mm,
          wind_speed, weathercode, hour, is_weekend::INT AS is_weekend, is_peak_hour::INT AS is_peak_hour,
          trip_distance, passenger_count,
          (dense_rank() OVER (ORDER BY coalesce(borough, 'UNKNOWN')) - 1)::INT AS borough_enc,
          tip_percentage, trip_duration_min
        FROM feature_rows""",
    "feature_keyed": f"""
        SELECT row_number() OVER (ORDER BY {_nulls_last(_FEATURES)}) AS feature_id, * FROM feature_matrix""",
    "drawn": """
        SELECT *, ('0x' || digest[1:8])::BIGINT % 10 < 8 AS is_training,
          (('0x' || digest[9:16])::BIGINT % 5)::INT AS fold
        FROM (SELECT *, md5(feature_id || ':42') AS digest FROM feature_keyed)""",
    "correlations": "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, pow(corr({c}::DOUBLE, tip_percentage::DOUBLE), 2) AS importance_tip,"
        f" pow(corr({c}::DOUBLE, trip_duration_min::DOUBLE), 2) AS importance_duration,"
        f" {str(c in ('temperature_c', 'precipitation_mm')).upper()} AS is_weather FROM feature_matrix"
        for c in _FEATURES[:10]
        if c not in ("wind_speed", "weathercode")
    )
    + ")",
}

_WORD = re.compile(r"\b(" + "|".join(RELATIONS) + r")\b")


def _sql(body: str) -> str:
    """``body`` with the relations it mentions, directly or through others."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        for name in _WORD.findall(todo.pop()):
            if name not in needed:
                needed.add(name)
                todo.append(RELATIONS[name])
    parts = [f"{name} AS ({text})" for name, text in RELATIONS.items() if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _report(keys: str, measures: str, source: str = "fact", where: str = _W, tail: str = "") -> str:
    head = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return f"SELECT {head}count(*) AS total_trips, {measures} FROM {source} WHERE {where}{group}{tail}"


_TIP, _DUR, _DIST, _TOT = "tip_percentage", "trip_duration_min", "trip_distance", "total_amount"
_PERIOD = "min(pickup_datetime) AS start_date, max(pickup_datetime) AS end_date"


def _tally(*pairs: tuple[str, str]) -> str:
    """``(condition, name)`` pairs as counting columns."""
    return ", ".join(f"count(CASE WHEN {test} THEN 1 END) AS {name}" for test, name in pairs)


def _money_rows() -> str:
    tests = {
        "negative_fare": ("fare_amount < 0", "fare_amount < 0 (refund/koreksi)"),
        "zero_fare": ("fare_amount = 0", "fare_amount = 0"),
        "non_positive_fare": ("fare_amount <= 0", "fare_amount <= 0"),
        "negative_total": ("total_amount < 0", "total_amount < 0"),
        "zero_total": ("total_amount = 0", "total_amount = 0"),
        "non_positive_total": ("total_amount <= 0", "total_amount <= 0"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS anomaly_type, count(*) FILTER ({test}) AS anomaly_count,"
        f" round(count(*) FILTER ({test}) / count(*) * 100, 4) AS anomaly_rate_pct,"
        f" '{text}' AS description FROM trips_raw"
        for name, (test, text) in tests.items()
    )


def _anomaly_rows() -> str:
    tests = {
        "Negative Fare (Fare < 0)": "fare_amount < 0",
        "Missing Passenger (NULL)": "passenger_count IS NULL",
        "Zero Passenger (Count = 0)": "passenger_count = 0",
        "Negative Duration": "tpep_dropoff_datetime < tpep_pickup_datetime",
        "Too Long Duration (> 5hr)": "tpep_dropoff_datetime > tpep_pickup_datetime + INTERVAL 5 HOUR",
        "Invalid Location ID": '"PULocationID" IS NULL OR "DOLocationID" IS NULL',
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS anomaly_type, count(*) FILTER ({test}) AS anomaly_count,"
        f" round(count(*) FILTER ({test}) / count(*) * 100, 4) AS pct_of_raw FROM trips_raw"
        for name, test in tests.items()
    )


def _anomaly(distance: str = "trip_distance", passengers: str = "passenger_count") -> str:
    return (
        f"CASE WHEN {distance} = 0 THEN CASE WHEN {passengers} = 0"
        " THEN 'zero_distance_and_zero_passenger' ELSE 'zero_distance' END"
        f" WHEN {passengers} = 0 THEN 'zero_passenger' END"
    )


_EVIDENCE = (
    "tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, fare_amount,"
    ' total_amount, "PULocationID", "DOLocationID"'
)
_OUTSIDE = "tpep_pickup_datetime < TIMESTAMP '1997-01-01' OR tpep_pickup_datetime >= TIMESTAMP '1997-07-01'"
_DAILY = (
    "date, round(temperature_2m_mean, 4) AS temperature_2m_mean, temperature_2m_min, temperature_2m_max,"
    " round(relative_humidity_2m_mean, 4) AS relative_humidity_2m_mean, precipitation_sum,"
    " round(wind_speed_10m_mean, 4) AS wind_speed_10m_mean,"
    " round(wind_direction_10m_mean, 4) AS wind_direction_10m_mean,"
    " round(weathercode, 4) AS weathercode, weather_category"
)
_ROUNDED_FEATURES = (
    "round(temperature_c, 4) AS temperature_c, round(precipitation_mm, 4) AS precipitation_mm,"
    " wind_speed, weathercode, hour, is_weekend, is_peak_hour, trip_distance, passenger_count,"
    " borough_enc, tip_percentage, trip_duration_min"
)


def _cents(column: str, name: str) -> str:
    return f"round(avg({column}), 2) AS {name}"


_FARES = f"{_cents(_TOT, 'avg_fare')}, {_cents(_TIP, 'avg_tip_pct')}"
_SKY = "temperature_category, weather_description"
_SKY_JOIN = "(SELECT * EXCLUDE (temperature_category, weather_description) FROM fact) JOIN skies USING (weather_key)"

def _parts(first: str, last: str) -> str:
    """Rows of the training and of the test part in one row."""
    return f"""SELECT {first}count(*) FILTER (is_training) AS n_train, count(*) FILTER (NOT is_training) AS n_test,
          {last} FROM drawn"""


_BODIES = {
    # sources
    "scan_trips": f"SELECT {TRIP_COLUMNS} FROM trips_raw",
    "discover_files": "SELECT DISTINCT 'trip_month=' || trip_month AS file_name FROM trips_raw",
    "route_files_hourly_daily": """
        SELECT path, CASE WHEN o_orderkey % 3 = 0 THEN 'hourly' ELSE 'daily' END AS interval FROM (
          SELECT o_orderkey, '/landing/' || CASE o_orderkey % 3 WHEN 0 THEN 'Weather_HOURLY_'
            WHEN 1 THEN 'weather_daily_' ELSE 'hourly/weather_' END || o_orderkey || '.parquet' AS path
          FROM orders)""",
    "scan_weather_daily": f"SELECT {_DAILY} FROM days",
    "scan_weather_hourly": "SELECT * FROM hours",
    "flatten_weather_payload": f"""
        SELECT *, {_weather_label("weathercode")} AS weather_category FROM (
          SELECT datetime, temperature_2m, relative_humidity_2m, precipitation, weathercode,
            wind_speed_10m, wind_direction_10m FROM hours
          UNION ALL
          SELECT datetime + INTERVAL 1 HOUR, temperature_2m + 1, relative_humidity_2m + 1,
            precipitation + 1, 96, wind_speed_10m / 2, wind_direction_10m / 2 FROM hours)""",
    "scan_zone_lookup_raw": "SELECT * FROM csv_zones",
    "scan_zone_lookup": "SELECT * REPLACE (latitude::FLOAT AS latitude, longitude::FLOAT AS longitude)"
    " FROM csv_zones LEFT JOIN centres USING (location_id)",
    "zone_coverage": """
        SELECT count(*) AS zones, count(*) FILTER (latitude IS NULL) AS without_coordinates
        FROM csv_zones LEFT JOIN centres USING (location_id)""",
    "empty_table_fallback": """
        SELECT location_id, NULL::FLOAT AS latitude, NULL::FLOAT AS longitude,
          NULL::FLOAT AS latitude_rounded, NULL::FLOAT AS longitude_rounded,
          NULL::VARCHAR AS zone_name, NULL::VARCHAR AS borough, NULL::VARCHAR AS service_zone,
          coalesce(n, 0) AS trips, n AS trips_without_weather,
          CASE WHEN n > 0 THEN -999::FLOAT END AS least_temperature,
          CASE WHEN n > 0 THEN 'Unknown' END AS weather_description, 'weather=empty,zones=empty' AS sources
        FROM used_zones LEFT JOIN (
          SELECT pickup_location_id AS location_id, count(*) AS n FROM trips_clean
          WHERE pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL GROUP BY ALL
        ) USING (location_id) WHERE location_id IS NOT NULL""",
    "scan_zone_vertices": "SELECT * FROM vertices",
    "audit_files": "SELECT trip_month, count(*) AS row_count, true AS is_readable FROM trips_raw GROUP BY ALL",
    "scan_features": f"SELECT {_ROUNDED_FEATURES} FROM feature_matrix",
    "sink_features": f"SELECT feature_id, {_ROUNDED_FEATURES} FROM feature_keyed",
    # sinks
    "sink_mart": "SELECT *, strftime(pickup_datetime, '%Y-%m') AS pickup_month FROM keyed",
    "sink_cleaned_parquet": "SELECT * FROM trips_clean",
    "sink_fact_export_csv": "SELECT *, strftime(pickup_datetime, '%Y-%m') AS pickup_month FROM keyed",
    # incremental loading
    "ledger_guard": "SELECT count(*) AS row_count, true AS is_refused FROM trips_raw",
    "next_batch_month": """
        SELECT month(due)::INT AS month, year(due)::INT AS year, true AS is_valid,
          'Processing batch: ' || strftime(due, '%m/%Y') AS reason, total_processed
        FROM (SELECT max(date_trunc('month', o_orderdate)) + INTERVAL 1 MONTH AS due,
            count(DISTINCT date_trunc('month', o_orderdate)) AS total_processed
          FROM orders WHERE o_orderdate < TIMESTAMP '1997-05-01')
        UNION ALL
        SELECT NULL, NULL, false, 'All batches completed (up to 6/1997)',
          count(DISTINCT date_trunc('month', o_orderdate)) FROM orders""",
    "batch_date_range": """
        SELECT DISTINCT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month,
          date_trunc('month', o_orderdate)::DATE AS start_date, last_day(o_orderdate) AS end_date
        FROM orders""",
    "mark_batch_complete": """
        SELECT unnest([min(m), max(m)]) AS batch_month
        FROM (SELECT date_trunc('month', o_orderdate)::DATE AS m FROM orders)""",
    "reset_batches": """
        SELECT month(m)::INT AS month, year(m)::INT AS year, true AS is_valid,
          'Processing batch: ' || strftime(m, '%m/%Y') AS reason, 0::BIGINT AS total_processed
        FROM (SELECT date_trunc('month', min(o_orderdate)) AS m FROM orders)""",
    "process_one_batch": """
        SELECT strftime(pickup_datetime, '%Y-%m') AS pickup_month, count(*) AS trips,
          min(n) AS first_trip_id, max(n) AS last_trip_id, round(sum(total_amount), 4) AS revenue,
          round(sum(temperature_2m), 4) AS temperature_sum
        FROM (
          SELECT *, row_number() OVER (ORDER BY pickup_datetime) AS n FROM (
            SELECT tpep_pickup_datetime AS pickup_datetime, total_amount::FLOAT AS total_amount,
              coalesce(temperature_2m, -999)::FLOAT AS temperature_2m
            FROM trips_raw LEFT JOIN skies ON date_key = tpep_pickup_datetime::DATE"""
    + f""" WHERE {_CLEAN} AND trip_month BETWEEN '1997-01' AND '1997-06'
              AND "PULocationID" IS NOT NULL AND "DOLocationID" IS NOT NULL))
        GROUP BY ALL""",
    "upsert_weather_days": "SELECT * FROM first_records",
    # projections
    "trip_duration_min": f"""
        SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
          ({_RAW_MINUTES})::FLOAT AS trip_duration_min FROM trips_raw""",
    "trip_duration_whole_min": """
        SELECT pickup_datetime, dropoff_datetime,
          date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_min FROM trips_clean""",
    "tip_percentage": f"SELECT tip_amount, fare_amount, {_TIP_PERCENTAGE} AS tip_percentage FROM trips_raw",
    "temporal_features": f"SELECT tpep_pickup_datetime, {_TEMPORAL.format('tpep_pickup_datetime')} FROM trips_raw",
    "cast_and_rename": f"""
        SELECT {_MONEY_CASTS}, passenger_count::INT AS passenger_count,
          trip_distance::FLOAT AS trip_distance, {_NO_COORDINATES}, {_ZONE_CASTS} FROM trips_raw""",
    "clip_weather": f"""
        SELECT date, round({_clipped("temperature_2m_mean", -40, 50)}, 4) AS avg_temperature,
          {_clipped("precipitation_sum", 0, 500)} AS total_precipitation FROM days""",
    "weather_temporal": """
        SELECT date, year(date)::INT AS year, month(date)::INT AS month, dayname(date) AS day_of_week,
          dayofweek(date) IN (5, 6) AS is_weekend FROM days""",
    "temperature_category_clean": f"""
        SELECT datetime, temperature_2m, {_feel("temperature_2m")} AS temperature_category FROM hours""",
    "weather_category_from_code": f"""
        SELECT datetime, weathercode, weather_category,
          {_weather_label("weathercode")} AS category_of_fraction FROM hours""",
    "dim_weather_projection": "SELECT * FROM weather_facts",
    "dim_time_projection": "SELECT * FROM date_facts",
    "dim_location_projection": "SELECT * FROM zone_facts",
    "trip_duration_category": f"""
        SELECT pickup_datetime, trip_duration_min, {_DURATION_LABEL} AS trip_duration_category
        FROM trips_clean""",
    "tip_category": f"""
        SELECT pickup_datetime, fare_amount, tip_percentage, {_TIP_LABEL} AS tip_category
        FROM trips_clean""",
    "weather_defaults": f"""
        SELECT pickup_datetime, weather_key, temperature_2m, relative_humidity_2m, precipitation,
          wind_speed_10m, {_SKY} FROM fact""",
    "feature_projection": """
        SELECT * REPLACE (round(temperature_c, 4) AS temperature_c,
          round(precipitation_mm, 4) AS precipitation_mm) FROM feature_rows""",
    "impute_median": """
        SELECT tpep_pickup_datetime,
          coalesce(passenger_count, (SELECT median(passenger_count) FROM trips_raw))::DOUBLE AS passenger_count,
          trip_distance, fare_amount FROM trips_raw""",
    "encode_borough": """
        SELECT pickup_datetime, borough,
          (dense_rank() OVER (ORDER BY borough) - 1)::INT AS borough_enc
        FROM (SELECT pickup_datetime, coalesce(borough, 'UNKNOWN') AS borough FROM feature_rows)""",
    "flags_to_int": """
        SELECT pickup_datetime, is_weekend::INT AS is_weekend, is_peak_hour::INT AS is_peak_hour
        FROM trips_clean""",
    "drop_empty_columns": f"""
        SELECT * EXCLUDE (wind_speed, weathercode) FROM (SELECT {_ROUNDED_FEATURES} FROM feature_matrix)
        WHERE tip_percentage IS NOT NULL""",
    "peak_label": """
        SELECT pickup_datetime, CASE WHEN is_peak_hour THEN 'Peak Hour' ELSE 'Non-Peak Hour' END AS period,
          CASE WHEN is_peak_hour THEN 'Peak (7-9, 17-19)' ELSE 'Off-peak' END AS time_period
        FROM trips_clean""",
    "anomaly_type_label": f"""
        SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, passenger_count,
          {_anomaly()} AS anomaly_type FROM trips_raw""",
    "scalar_functions": """
        SELECT o_orderkey, o_orderkey::VARCHAR AS as_text, hour(o_orderdate)::INT AS hour,
          year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day,
          quarter(o_orderdate)::INT AS quarter, week(o_orderdate)::INT AS week,
          dayofweek(o_orderdate)::INT AS day_number, o_orderdate::DATE AS day_date,
          try_cast(o_orderpriority[1:1] AS INT) AS digit, try_cast(o_orderpriority[3:5] AS INT) AS no_digit,
          lower(trim(o_orderpriority)) AS clean_name, contains(o_orderpriority, 'URG') AS is_urgent,
          round(o_totalprice / 1000, 1) AS thousands, o_orderdate >= DATE '1996-01-01' AS is_late
        FROM orders""",
    # filters
    "f_clean": f"""
        SELECT tpep_pickup_datetime, tpep_dropoff_datetime, fare_amount, passenger_count
        FROM trips_raw WHERE {_CLEAN}""",
    "f_analysis_window": f"SELECT pickup_datetime, tip_percentage, total_amount FROM fact WHERE {_W}",
    "f_not_null_locations": """
        SELECT pickup_datetime, pickup_location_id, dropoff_location_id FROM trips_clean
        WHERE pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL""",
    "f_valid_coords": f"SELECT pickup_datetime, location_id FROM located WHERE {_ON_MAP}",
    "f_in_list": f"""
        SELECT 'chosen' AS choice, count(*) AS row_count FROM located WHERE {_CHOSEN} AND {_HERE}
        UNION ALL SELECT 'no weather', 0 UNION ALL SELECT 'no borough', count(*) FROM fact WHERE {_W}""",
    "f_in_subquery": """
        SELECT pickup_datetime, pickup_location_key, total_amount FROM fact WHERE pickup_location_key IN
          (SELECT location_key FROM places WHERE borough IN ('AMERICA', 'ASIA'))""",
    "f_out_of_range": f"SELECT tpep_pickup_datetime, tpep_dropoff_datetime FROM trips_raw WHERE {_OUTSIDE}",
    "f_known_temperature": """
        SELECT pickup_datetime, temperature_category FROM fact WHERE temperature_category <> 'Unknown'""",
    "f_positive_total": """
        SELECT tpep_pickup_datetime, tpep_dropoff_datetime, total_amount FROM trips_raw
        WHERE total_amount > 0""",
    "f_row_valid": "SELECT date, temperature_2m_mean FROM weather_records WHERE date IS NOT NULL",
    # joins
    "build_fact": "SELECT * FROM fact",
    "join_zone_attrs": "SELECT * FROM places",
    "join_location_inner": "SELECT pickup_datetime, borough, zone_name, total_amount FROM located",
    "join_time_inner": "SELECT pickup_datetime, date_actual, season FROM fact JOIN times USING (time_key)",
    "join_weather_inner": f"""
        SELECT pickup_datetime, weather_description, temperature_description FROM {_SKY_JOIN}""",
    "join_time_weather": f"""
        SELECT pickup_datetime, day_of_week_name, {_SKY} FROM {_SKY_JOIN} JOIN times USING (time_key)""",
    "join_centroids": "SELECT * FROM csv_zones LEFT JOIN centres USING (location_id)",
    "fk_integrity": """
        SELECT join_key, count(*) AS total_rows, count(*) FILTER (p.location_id IS NULL) AS unmatched_rows,
          round(1 - count(*) FILTER (p.location_id IS NULL) / count(*), 4) AS match_rate
        FROM (SELECT 'PULocationID' AS join_key, "PULocationID" AS id FROM trips_raw
          UNION ALL SELECT 'DOLocationID', "DOLocationID" FROM trips_raw)
        LEFT JOIN places p ON p.location_id = id GROUP BY join_key""",
    # aggregations
    "zone_centroid": "SELECT * FROM centres",
    "mean_vertices": "SELECT location_id, round(x, 4) AS x, round(y, 4) AS y FROM centre_feet",
    "distinct_dates": "SELECT * FROM dates",
    "distinct_options": "SELECT DISTINCT weather_description FROM fact",
    "global_agg": _report(
        "", f"{_PERIOD}, {_named(_TIP, _DUR, _DIST)}, round(sum(total_amount), 4) AS total_revenue", where="true"
    ),
    "group_agg": _report(
        "borough, zone_name, weather_description, is_peak_hour", _named(_TIP, _TOT), "located", "true"
    ),
    "conditional_sum": "SELECT count(*) AS total_rows, "
    + _tally(*[(f"tip_percentage > {n}", f"tip_above_{n}") for n in (100, 200, 500, 1000)])
    + ", max(tip_percentage) AS max_tip_percentage FROM fact WHERE pickup_datetime >= TIMESTAMP"
    " '1997-01-01' AND pickup_datetime < TIMESTAMP '1997-07-01'",
    "dq_anomalies": _anomaly_rows(),
    "nunique": f"""
        WITH points AS (SELECT borough, zone_name, latitude, longitude, count(*) AS n FROM located
          WHERE {_CHOSEN} AND {_HERE} AND {_ON_MAP} GROUP BY ALL)
        SELECT count(*) AS active_zones, count(DISTINCT borough) AS active_boroughs,
          first(zone_name ORDER BY n DESC, borough, zone_name) AS busiest_zone FROM points""",
    "weather_split_sum": """
        SELECT is_weather, count(*) AS features, round(sum(importance_tip), 6) AS importance_tip,
          round(sum(importance_duration), 6) AS importance_duration
        FROM correlations GROUP BY is_weather""",
    # windows
    "surrogate_key_dim": "SELECT * FROM times",
    "surrogate_key_fact": "SELECT * FROM keyed",
    "forward_fill": f"SELECT {_DAILY} FROM days_filled",
    "transform_weather": """
        SELECT * REPLACE (round(avg_temperature, 4) AS avg_temperature,
          round(avg_humidity, 4) AS avg_humidity, round(wind_speed, 4) AS wind_speed,
          round(wind_direction, 4) AS wind_direction, round(weather_code, 4) AS weather_code)
        FROM weather_days""",
    "dim_weather": "SELECT * FROM skies",
    # sorts and limits
    "order_by_severity": f"""
        SELECT {_EVIDENCE}, {_anomaly()} AS anomaly_type FROM trips_raw
        WHERE trip_distance = 0 OR passenger_count = 0
        ORDER BY array_position(['zero_distance_and_zero_passenger', 'zero_distance', 'zero_passenger'],
          {_anomaly()}), {_nulls_last(_EVIDENCE.split(", "))} LIMIT 20""",
    "n_largest": """
        SELECT feature_name, round(importance_tip, 6) AS importance_tip,
          round(importance_duration, 6) AS importance_duration,
          round((importance_tip + importance_duration) / 2, 6) AS importance_avg
        FROM correlations WHERE is_weather
        ORDER BY importance_tip + importance_duration DESC, feature_name LIMIT 3""",
    "limit_preview": """
        SELECT pickup_datetime, dropoff_datetime,
          date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_min
        FROM keyed ORDER BY trip_id LIMIT 10""",
    "mart_sort": """
        SELECT min(pickup_datetime) AS first_pickup, max(pickup_datetime) AS last_pickup, true AS is_sorted
        FROM fact""",
    # set operations
    "union_locations": "SELECT location_id FROM used_zones WHERE location_id IS NOT NULL",
    "union_all_counts": """
        SELECT 'tlc_raw' AS stage, count(*) AS row_count FROM trips_raw
        UNION ALL SELECT 'tlc_cleaned', count(*) FROM trips_clean
        UNION ALL SELECT 'fact_trips', count(*) FROM fact""",
    "append_files": f"""
        SELECT * REPLACE (CASE WHEN "VendorID" = 1 THEN "Airport_fee" END AS "Airport_fee",
          CASE WHEN "VendorID" = 1 THEN cbd_congestion_fee END AS cbd_congestion_fee)
        FROM (SELECT {TRIP_COLUMNS} FROM trips_raw)""",
    "feature_union": """
        SELECT feature_name, CASE WHEN feature_name = 'hour' THEN 0 ELSE round(importance_tip, 6) END
            AS importance_tip,
          CASE WHEN feature_name = 'borough_enc' THEN 0 ELSE round(importance_duration, 6) END
            AS importance_duration
        FROM correlations""",
    # reports
    "a01_overview": _report(
        "", f"{_PERIOD}, {_named(_TIP, _DUR, _DIST)}, round(sum(total_amount), 4) AS total_revenue"
    ),
    "a02_weather": _report("weather_description", _named(_TIP, _DUR, _DIST, _TOT)),
    "a03_temperature": _report(
        "temperature_category", f"round(avg(temperature_2m), 4) AS avg_temperature, {_named(_TIP, _DUR)}"
    ),
    "a04_tip_hour_weather": _report("hour_of_day, weather_description", _named(_TIP)),
    "a05_duration_hour_weather": _report("hour_of_day, weather_description", _named(_DUR)),
    "a06_peak_weather": _report("is_peak_hour, weather_description", _named(_TIP, _DUR, _DIST)),
    "a07_tip_category": _report("tip_category", _named(_TIP, "fare_amount", _TOT)),
    "a08_duration_category": _report("trip_duration_category", _named(_DUR, _TIP)),
    "a09_quality": "SELECT count(*) AS total_rows, "
    + _tally(
        ("tip_percentage IS NULL", "null_tip_percentage"),
        ("trip_duration_min IS NULL", "null_trip_duration"),
        ("weather_description IS NULL", "null_weather_description"),
    )
    + ", min(tip_percentage) AS min_tip_percentage, max(tip_percentage) AS max_tip_percentage,"
    " min(trip_duration_min) AS min_trip_duration, max(trip_duration_min) AS max_trip_duration"
    f" FROM fact WHERE {_W}",
    "a11_borough_weather": _report("borough, weather_description", _named(_TIP, _DUR, _DIST, _TOT), "located"),
    "a12_top_zones": _report(
        "borough, zone_name",
        _named(_TIP, _DUR, _DIST),
        "located",
        tail=" ORDER BY total_trips DESC, borough, zone_name LIMIT 25",
    ),
    "a13_borough": _report("borough", _named(_TIP, _DUR, _DIST, _TOT), "located"),
    "a14_map": _report(
        "borough, zone_name, latitude, longitude", _named(_TIP, _DUR), "located", f"{_W} AND {_ON_MAP}"
    ),
    "q_day_of_week": f"""
        SELECT day_of_week_name, count(*) AS trip_count, {_FARES} FROM fact JOIN times USING (time_key)
        GROUP BY day_of_week_name""",
    "q_peak": f"""
        SELECT CASE WHEN is_peak_hour THEN 'Peak (7-9, 17-19)' ELSE 'Off-peak' END AS time_period,
          count(*) AS trip_count, {_cents(_TOT, "avg_fare")}, {_cents(_DUR, "avg_duration_min")},
          {_cents(_DIST, "avg_distance_miles")} FROM fact GROUP BY is_peak_hour""",
    "q_weather_top10": f"""
        SELECT {_SKY}, count(*) AS trip_count, {_FARES} FROM {_SKY_JOIN} GROUP BY {_SKY}
        ORDER BY trip_count DESC, {_SKY} LIMIT 10""",
    "q_top_locations": f"""
        SELECT location_id, round(latitude, 4) AS lat, round(longitude, 4) AS lon,
          count(*) AS pickup_count, {_cents(_TOT, "avg_fare")} FROM located
        GROUP BY location_id, latitude, longitude ORDER BY pickup_count DESC, location_id LIMIT 10""",
    "q_revenue": f"""
        SELECT month(pickup_datetime)::INT AS month, day_of_week_name, count(*) AS trips,
          round(sum(total_amount), 2) AS total_revenue, {_cents(_TOT, "avg_fare")},
          round(sum(tip_amount), 2) AS total_tips
        FROM fact JOIN times USING (time_key) GROUP BY ALL""",
    "q_daily_stats": f"""
        SELECT date_actual, count(*) AS trip_count, {_cents(_TOT, "avg_fare")},
          round(sum(total_amount), 2) AS total_revenue, {_cents(_DIST, "avg_distance")}
        FROM fact JOIN times USING (time_key) GROUP BY date_actual""",
    "q_weekday_temperature": f"""
        SELECT day_of_week_name, temperature_category, count(*) AS trip_count,
          round(avg(total_amount), 4) AS avg_fare, round(avg(tip_percentage), 4) AS avg_tip_pct
        FROM {_SKY_JOIN} JOIN times USING (time_key) GROUP BY day_of_week_name, temperature_category""",
    "d_filters": f"""
        SELECT DISTINCT unnest(['weather_description', 'temperature_category']) AS filter,
          unnest([weather_description, temperature_category]) AS option FROM fact WHERE {_W}
        UNION SELECT 'borough', borough FROM places WHERE borough IS NOT NULL""",
    "d_overview": _report(
        "", f"{_PERIOD}, {_named(_TIP, _DUR, _DIST)}", "located", f"{_CHOSEN} AND {_HERE}"
    ),
    "d_weather_dist": _report(
        "weather_description", _named(_TIP, _DUR), "located", f"{_CHOSEN} AND {_HERE}"
    ),
    "d_map": _report(
        "borough, zone_name, latitude, longitude",
        _named(_TIP, _DUR),
        "located",
        f"{_CHOSEN} AND {_HERE} AND {_ON_MAP}",
    ),
    "d_borough": _report("borough", _named(_TIP, _DUR), "located", f"{_CHOSEN} AND {_HERE}"),
    "d_top_zones": _report(
        "borough, zone_name",
        _named(_TIP, _DUR),
        "located",
        f"{_CHOSEN} AND {_HERE}",
        " ORDER BY total_trips DESC, borough, zone_name LIMIT 25",
    ),
    "d_weather_summary": _report(
        "weather_description", _named(_TIP, _DUR, _DIST, _TOT), "located", f"{_CHOSEN} AND {_HERE}"
    ),
    "d_hourly": f"""
        SELECT hour_of_day, round(avg(tip_percentage), 4) AS metric_value FROM located
        WHERE {_CHOSEN} AND {_HERE} GROUP BY hour_of_day""",
    "d_peak": f"""
        SELECT is_peak_hour, count(*) AS total_trips, {_named(_TIP, _DUR)},
          CASE WHEN is_peak_hour THEN 'Peak Hour' ELSE 'Non-Peak Hour' END AS period
        FROM located WHERE {_CHOSEN} AND {_HERE} GROUP BY is_peak_hour""",
    "s_schema_summary": """
        SELECT count(*) AS total_trips, min(pickup_datetime) AS min_date, max(pickup_datetime) AS max_date,
          round(sum(total_amount) FILTER (total_amount > 0), 4) AS total_revenue,
          round(avg(total_amount) FILTER (total_amount > 0), 4) AS avg_fare,
          round(avg(tip_percentage) FILTER (total_amount > 0), 4) AS avg_tip_pct,
          round(avg(trip_distance), 4) AS avg_distance, round(avg(trip_duration_min), 4) AS avg_duration,
          round(avg(passenger_count), 4) AS avg_passengers,
          (SELECT count(*) FROM times) AS dim_time_rows, (SELECT count(*) FROM places) AS dim_location_rows,
          (SELECT count(*) FROM skies) AS dim_weather_rows
        FROM fact""",
    "s_clean_report": f"""
        SELECT metric, round(value, 4) AS value FROM (
          SELECT unnest(['rows_before', 'rows_after', 'rows_removed', 'retention_rate', 'fare_negative',
              'duration_negative', 'duration_too_long', 'passenger_zero']) AS metric,
            unnest([n, kept, n - kept, kept / n * 100, a, b, c, d]::DOUBLE[]) AS value
          FROM (SELECT count(*) AS n, count(*) FILTER ({_CLEAN}) AS kept,
              count(*) FILTER (fare_amount < 0) AS a, count(*) FILTER ({_RAW_MINUTES} < 0) AS b,
              count(*) FILTER ({_RAW_MINUTES} > 300) AS c, count(*) FILTER (passenger_count = 0) AS d
            FROM trips_raw))
        WHERE value > 0 OR contains(metric, 'r_') OR metric LIKE 'rows%' OR metric LIKE 'ret%'""",
    "s_weather_report": """
        SELECT a.n AS rows_before, b.n AS rows_after, a.n - b.n AS anomalies_found
        FROM (SELECT count(*) AS n FROM days) a, (SELECT count(*) AS n FROM weather_days) b""",
    "dq_null_rates": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (\"{c}\" IS NULL) AS null_rows,"
        f" round(count(*) FILTER (\"{c}\" IS NULL) / count(*), 4) AS null_rate FROM trips_raw"
        for c in ("PULocationID", "DOLocationID", "tpep_pickup_datetime")
    ),
    "dq_financial": "SELECT "
    + _tally(("fare_amount <= 0", "non_positive_fare"), ("total_amount <= 0", "non_positive_total"))
    + " FROM trips_raw",
    "dq_money_summary": _money_rows(),
    "dq_logic": "SELECT "
    + _tally(
        ("trip_distance = 0", "zero_distance_rows"),
        ("passenger_count = 0", "zero_passenger_rows"),
        ("trip_distance = 0 AND passenger_count = 0", "both_conditions_rows"),
    )
    + " FROM trips_raw",
    "dq_location_range": "SELECT "
    + _tally(
        ('"PULocationID" < 1 OR "PULocationID" > 265', "invalid_pickup_id"),
        ('"DOLocationID" < 1 OR "DOLocationID" > 265', "invalid_dropoff_id"),
    )
    + " FROM trips_raw",
    "dq_temporal": f"SELECT count(*) AS out_of_range_rows FROM trips_raw WHERE {_OUTSIDE}",
    "dq_temporal_rows": f"""
        SELECT tpep_pickup_datetime, passenger_count, fare_amount, trip_distance, "PULocationID",
          "DOLocationID" FROM trips_raw WHERE {_OUTSIDE}""",
    # models
    "feature_importance": """
        SELECT feature_name, round(importance_tip, 6) AS importance_tip,
          round(importance_duration, 6) AS importance_duration,
          round((importance_tip + importance_duration) / 2, 6) AS importance_avg, is_weather
        FROM correlations""",
    "weather_impact": "SELECT "
    + ", ".join(
        f"""round(round(inside_{k} / (inside_{k} + outside_{k}) * 100, 2), 4) AS weather_impact_{k}_pct,
          round(round(inside_{k}, 6), 4) AS weather_importance_total_{k},
          round(round(outside_{k}, 6), 4) AS non_weather_importance_total_{k},
          inside_{k} / (inside_{k} + outside_{k}) * 100 > 15 AS is_{k}_significant"""
        for k in ("tip", "duration")
    )
    + """, inside AS weather_features_count, outside AS non_weather_features_count FROM (
        SELECT count(*) FILTER (is_weather) AS inside, count(*) FILTER (NOT is_weather) AS outside, """
    + ", ".join(
        f"sum(importance_{k}) FILTER ({'' if side == 'inside' else 'NOT '}is_weather) AS {side}_{k}"
        for k in ("tip", "duration")
        for side in ("inside", "outside")
    )
    + " FROM correlations)",
    "train_tip": _parts("'tip_model' AS model, ", "8 AS n_features, true AS beats_mean"),
    "train_duration": _parts("'duration_model' AS model, ", "8 AS n_features, true AS beats_mean"),
    "sink_metrics_json": _parts("unnest(['tip_model', 'duration_model']) AS model, ", "true AS is_unchanged"),
    "sink_models": """
        SELECT unnest(['tip_model', 'duration_model']) AS model, count(*) AS scored_rows, true AS beats_mean FROM drawn""",
    "cross_validate": """
        SELECT fold, count(*) AS n_held_out, (SELECT count(*) FROM drawn WHERE is_training) - count(*) AS n_fit,
          unnest(['tip_model', 'duration_model']) AS model, true AS is_measured
        FROM drawn WHERE is_training GROUP BY fold""",
    "sample_cap": f"""
        SELECT feature_id, {_ROUNDED_FEATURES} FROM drawn ORDER BY digest, feature_id LIMIT 1500""",
    "split_train_test": "SELECT feature_id, is_training, fold FROM drawn",
    "evaluate": """
        SELECT is_training, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
          round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 4) AS r2
        FROM (SELECT d.is_training, trip_duration_min::DOUBLE AS y, p FROM drawn d JOIN (
            SELECT hour, avg(trip_duration_min) AS p FROM drawn WHERE is_training GROUP BY hour)
          USING (hour))
        GROUP BY is_training""",
}

_SAME = {
    "scan_ml_results": "feature_importance",
    "sink_ml_results": "feature_importance",
    "build_features": "scan_features",
    "load_new_files": "scan_trips",
    "anti_files": "scan_trips",
    "stream_new_files": "scan_trips",
    "anti_dates": "upsert_weather_days",
    "clean_trips": "sink_cleaned_parquet",
    "sink_weather_parquet": "scan_weather_daily",
    "sink_zone_csv": "scan_zone_lookup",
    "sink_daily_stats_csv": "q_daily_stats",
    "join_features": "feature_projection",
    "semi_borough": "f_in_subquery",
    "daily_weather": "scan_weather_daily",
    "join_daily_category": "scan_weather_daily",
    "dq_fk": "fk_integrity",
    "a10_outliers": "conditional_sum",
    "filtered_counts": "dq_anomalies",
    "unpivot_counts": "dq_anomalies",
    "d_map_kpis": "nunique",
    "order_by": "a13_borough",
    "order_by_case": "q_day_of_week",
    "dq_logic_evidence": "order_by_severity",
    "top_k": "a12_top_zones",
    "sort_result": "d_weather_summary",
    "dq_retention": "union_all_counts",
}

_TYPES = {"BIGINT": "bigint", "INT": "int", "DOUBLE": "double", "VARCHAR": "string", "TS": "timestamp_ntz"}
_TRIP_TYPES = (
    "INT TS TS BIGINT DOUBLE BIGINT VARCHAR INT INT BIGINT" + " DOUBLE" * 10
).split()
_BODIES["describe_table"] = (
    "SELECT 'trips_raw' AS table_name, position::INT AS position, column_name, data_type, row_count FROM (VALUES "
    + ", ".join(
        f"({i}, '{name.strip(chr(34))}', '{_TYPES[kind]}')"
        for i, (name, kind) in enumerate(zip(TRIP_COLUMNS.split(", "), _TRIP_TYPES, strict=True), 1)
    )
    + ") AS v(position, column_name, data_type), (SELECT count(*) AS row_count FROM trips_raw)"
)


def oracle_sql() -> dict[str, str]:
    """SQL per query name. Queries that train a model have none."""
    bodies = _BODIES | {name: _BODIES[twin] for name, twin in _SAME.items()}
    return {name: _merge(body) for name, body in bodies.items()}


def _merge(body: str) -> str:
    """A body may start with a WITH of its own; both lists become one."""
    text = body.strip()
    if text.startswith("WITH "):
        full = _sql(text[5:])
        return re.sub(r"\)\s+points AS", "), points AS", full, count=1)
    return " ".join(_sql(text).split())
