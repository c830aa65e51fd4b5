"""GeoJSON features, and features dealt to map tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.functions.geometry import parse_wkt
from rooftop.operators import serving


def geometry_json(wkt: Column) -> Column:
    """A GeoJSON geometry of a (multi)polygon text; null for null."""
    shapes = parse_wkt(wkt)
    pairs = F.transform(shapes, lambda s: F.transform(s, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))))
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(pairs, F.lit(0)).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), pairs.alias("coordinates")))
    return F.when(F.size(shapes) == 1, one).when(shapes.isNotNull(), many)


def features(layer: DataFrame) -> DataFrame:
    """feature: one GeoJSON text a row; nulls among the properties are kept."""
    names = [c for c in layer.columns if c != "geometry"]
    properties = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}) if names else F.lit("{}")
    body = F.concat(
        F.lit('{"type":"Feature","properties":'),
        properties,
        F.lit(',"geometry":'),
        F.coalesce(geometry_json(F.col("geometry")), F.lit("null")),
        F.lit("}"),
    )
    return layer.select(body.alias("feature"))


def save_geojson(layer: DataFrame, path: str) -> None:
    """A folder of text files with a feature a line."""
    features(layer).write.mode("overwrite").text(path)


def read_geojson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a folder of features; schema: the properties' columns and types."""
    parsed = F.from_json("value", f"struct<properties:struct<{schema}>>")
    return spark.read.text(path).select(parsed.alias("f")).select("f.properties.*")


def save_tiles(layer: DataFrame, path: str) -> None:
    """Rows by zoom and tile: a folder for each zoom, sorted by x and y, so that a tile's rows lie in few row groups."""
    tiles = serving.tiles(layer)
    tiles.repartitionByRange(64, "z", "x", "y").sortWithinPartitions("z", "x", "y").write.mode("overwrite").partitionBy("z").parquet(path)


def read_tile(spark: SparkSession, path: str, z: int, x: int, y: int) -> DataFrame:
    return spark.read.parquet(path).where((F.col("z") == z) & (F.col("x") == x) & (F.col("y") == y))
