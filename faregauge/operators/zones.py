"""Zone centres from boundary vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.functions.geo import Conic, to_latitude_longitude


def mean_vertices(vertices: DataFrame) -> DataFrame:
    """Plain mean of all vertices of each zone's last shape.

    First one row per shape, from map-side partial sums, then the last shape of
    every zone: no group of vertices is ever gathered.
    """
    shapes = vertices.groupBy("location_id", "shape_index").agg(
        F.avg("x").alias("x"), F.avg("y").alias("y")
    )
    last = F.max_by(F.struct("x", "y"), "shape_index").alias("centre")
    return (
        shapes.groupBy("location_id")
        .agg(last)
        .select("location_id", F.col("centre.x").alias("x"), F.col("centre.y").alias("y"))
    )


def zone_centroid(vertices: DataFrame, conic: Conic = Conic()) -> DataFrame:
    """Zone centres in degrees, six decimals."""
    latitude, longitude = to_latitude_longitude(F.col("x"), F.col("y"), conic)
    return mean_vertices(vertices).select(
        "location_id",
        F.round(latitude, 6).alias("latitude"),
        F.round(longitude, 6).alias("longitude"),
    )


def join_centroids(zones: DataFrame, centroids: DataFrame) -> DataFrame:
    """Zone rows with their centre; NULL where no boundary is known."""
    return zones.join(centroids, "location_id", "left").select(
        "location_id", "borough", "zone", "service_zone", "latitude", "longitude"
    )
