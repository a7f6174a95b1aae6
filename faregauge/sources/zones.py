"""Zone tables and zone boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faregauge.schemas import ZONE_CSV_RAW, ZONE_LOOKUP, ZONE_VERTICES
from faregauge.sources.files import empty_table, path_exists

ID_SPELLINGS = ("locationid", "LocationID", "LOCATIONID")


def scan_zone_lookup_raw(spark: SparkSession, path: str) -> DataFrame:
    """Published zone CSV: rows with a numeric id, text fields trimmed."""
    rows = spark.read.schema(ZONE_CSV_RAW).csv(path, header=True)
    number = F.trim("LocationID")
    return rows.where(number.rlike("^[0-9]+$")).select(
        number.cast("int").alias("location_id"),
        F.trim("Borough").alias("borough"),
        F.trim("Zone").alias("zone"),
        F.trim("service_zone").alias("service_zone"),
    )


def scan_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV with coordinates; an empty table when there is no such file."""
    if not path_exists(spark, path):
        return empty_table(spark, ZONE_LOOKUP)
    return spark.read.schema(ZONE_LOOKUP).csv(path, header=True)


def zone_coverage(zones: DataFrame) -> DataFrame:
    """How many zones there are and how many of them lack coordinates."""
    return zones.agg(
        F.count("*").alias("zones"),
        F.count_if(F.col("latitude").isNull()).alias("without_coordinates"),
    )


def scan_zone_vertices(spark: SparkSession, path: str) -> DataFrame:
    """Boundary vertices, one row each."""
    return spark.read.schema(ZONE_VERTICES).parquet(path)


def geojson_schema() -> StructType:
    """Feature collection of polygons; the zone id may be spelled in three ways."""
    ids = ", ".join(f"`{name}`: string" for name in ID_SPELLINGS)
    return StructType.fromDDL(
        f"features array<struct<properties: struct<{ids}>,"
        " geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
    )


def scan_zone_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Vertices of a GeoJSON feature collection of polygons.

    JSON fields are matched in their exact case while Spark resolves names
    without it, so the three spellings are read from the raw text by path.
    """
    text = spark.read.text(path, wholetext=True)
    # Each feature is kept as text and split up by later, per-feature expressions.
    features = text.select(
        F.posexplode(F.from_json(F.get_json_object("value", "$.features"), "array<string>"))
    ).toDF("shape_index", "feature")
    ids = [F.get_json_object("feature", f"$.properties.{name}") for name in ID_SPELLINGS]
    rings = F.from_json(
        F.get_json_object("feature", "$.geometry.coordinates"), "array<array<array<double>>>"
    )
    return (
        features.select(
            F.coalesce(*ids).cast("int").alias("location_id"),
            "shape_index",
            F.posexplode(F.flatten(rings)).alias("vertex_index", "point"),
        )
        .select("location_id", "shape_index", "vertex_index", F.col("point")[0].alias("x"), F.col("point")[1].alias("y"))
    )
