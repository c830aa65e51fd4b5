"""Checks and repair of geometries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftop.functions import geometry, shapes
from rooftop.functions.values import flag
from rooftop.operators import matching


def diagnostics(df: DataFrame, column: str = "geometry", metric: bool = False) -> DataFrame:
    """row_idx and the report on a WKT column: missing, empty, valid and why not, type, area in m2, orientation.

    metric: coordinates are metres; otherwise degrees.
    """
    df = df.select("row_idx", F.col(column).alias("__w")).withColumn("__d", shapes.diagnose("__w"))
    df = df.withColumn("__s", F.coalesce(geometry.parse_wkt(F.col("__w")), geometry.parse_wkt(F.col("__d.inner"))))
    flat = F.col("__s").isNull() & F.col("__d.geom_type").isNotNull()  # points and lines
    area = F.when(flat, F.lit(0.0)).otherwise(geometry.area(F.col("__s") if metric else geometry.to_metres(F.col("__s"))))
    report = ["is_empty", "is_valid", "valid_reason", "geom_type"]
    df = df.select(
        "row_idx",
        F.col("__w").isNull().alias("is_missing"),
        *[f"__d.{c}" for c in report],
        area.alias("area_m2"),
        geometry.wrong_orientation(F.col("__s")).alias("wrong_ring_orientation"),
    )
    df = df.withColumn("zero_area", ~F.col("is_empty") & flag(F.col("area_m2") <= 1e-9))
    return df.withColumn("needs_attention", F.col("is_missing") | F.col("is_empty") | ~F.col("is_valid") | F.col("zero_area"))


def counters(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
        F.count_if("is_empty").alias("empty"),
        F.count_if("zero_area").alias("zero_area"),
        F.count_if("wrong_ring_orientation").alias("wrong_orientation"),
    )


def repair(df: DataFrame, column: str = "geometry") -> DataFrame:
    """Keeps the text in geometry_original and puts repaired, oriented polygons in its place."""
    return df.withColumn("geometry_original", F.col(column)).withColumn(column, shapes.repair(column))


def coverage(df: DataFrame, cell: float = 64.0) -> DataFrame:
    """Pairs idx_a < idx_b of footprints of one source that overlap: none in a coverage. Needs row_idx, geom_wkt and the box."""
    pairs = matching.candidates(df, df, cell, ["geom_wkt"]).where("idx_a < idx_b")
    return pairs.select("idx_a", "idx_b", shapes.overlap_area("geom_wkt_a", "geom_wkt_b").alias("overlap_m2")).where("overlap_m2 > 1e-9")


def coverage_edges(df: DataFrame, gap_width: float = 0.2, cell: float = 64.0) -> DataFrame:
    """row_idx, faulty_edges: a multi-line text of the edges of a footprint that break the coverage; no rows if it is one.

    Footprints may meet in edges that both have. An edge that crosses or lies in another footprint, or runs along
    one no farther off than gap_width, is faulty. Needs row_idx, geom_wkt and the box in metres.
    """
    grown = df.withColumns({f"{m}{c}": F.col(f"{m}{c}") + d for m, d in (("min", -gap_width), ("max", gap_width)) for c in "xy"})
    pairs = matching.candidates(grown, df, cell, ["geom_wkt"]).where("idx_a <> idx_b")
    edges = pairs.select(F.col("idx_a").alias("row_idx"), F.explode(shapes.faulty(gap_width)("geom_wkt_a", "geom_wkt_b")).alias("edge"))
    lines = F.array_join(F.transform(F.sort_array(F.collect_set("edge")), lambda e: F.concat(F.lit("("), e, F.lit(")"))), ", ")
    return edges.groupBy("row_idx").agg(F.concat(F.lit("MULTILINESTRING ("), lines, F.lit(")")).alias("faulty_edges"))


def run(df: DataFrame, column: str = "geometry", metric: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repaired rows, the report before, the report after."""
    fixed = repair(df, column)
    return fixed, diagnostics(df, column, metric), diagnostics(fixed, column, metric)
