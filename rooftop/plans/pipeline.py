"""The whole run: load, check, clean, match, choose heights, score, write. Also the command line."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions import geometry
from rooftop.operators import cleaning, heights, learning, matching, risk, serving, topology
from rooftop.session import written
from rooftop.sources import geojson, tables, vector_tiles


@dataclass
class Result:
    """Every table of a run."""

    a_prepared: DataFrame
    b_prepared: DataFrame
    strong_pairs: DataFrame
    matched_buildings: DataFrame
    final_results: DataFrame
    ml_cv_summary: DataFrame
    geometry_diag_a_before: DataFrame
    geometry_diag_a_after: DataFrame
    geometry_diag_b_before: DataFrame
    geometry_diag_b_after: DataFrame
    coverage_a: DataFrame
    coverage_b: DataFrame

    @property
    def frontend(self) -> DataFrame:
        return serving.frontend(self.final_results)


def located(df: DataFrame, metric: bool = False) -> DataFrame:
    """Adds geom_wkt in metres, box, area, perimeter and centroid of a WKT geometry; projects once."""
    shapes = geometry.shapes_of(df)
    df = df.withColumn("__s", shapes if metric else geometry.to_metres(shapes))
    s = F.col("__s")
    area = geometry.area(s)
    return df.withColumns(
        {
            "geom_wkt": geometry.write_wkt(s),
            **geometry.box(s),
            "area": F.when(area > 0, area),
            "perimeter": geometry.perimeter(s),
            **geometry.centroid(s),
        }
    ).drop("__s")


def clean_sources(a: DataFrame, b: DataFrame, settings: config.Settings) -> tuple[DataFrame, DataFrame]:
    return cleaning.clean_a(a, settings), cleaning.clean_b(b, settings)


def spatial_matching(a: DataFrame, b: DataFrame, settings: config.Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Strong pairs, membership, and the component table with metrics, addresses, review flags and geometry."""
    strong = written(matching.strong_pairs(matching.match_pairs(a, b, settings, polygons=True), settings.iou, settings.overlap), "strong")
    members = written(matching.membership(a, b, strong), "members")
    table = matching.component_metrics(matching.component_table(members), members, strong)
    table = matching.review_flags(matching.address_validation(table, members, *matching.address_features(a, b)), settings.review_iou)
    return strong, members, matching.component_geometry(table, members, a, b, "geometry")


def height_recovery(
    components: DataFrame,
    members: DataFrame,
    a: DataFrame,
    b: DataFrame,
    settings: config.Settings,
    enable_ml: bool = True,
    metric: bool = False,
) -> tuple[DataFrame, DataFrame]:
    df = heights.select_height(heights.member_lists(components, members, a, b), settings)
    df = heights.baseline_features(heights.pipeline_flags(df, settings.review_confidence), members, a, b)
    df = located(df, metric).withColumn("row_idx", F.col("component_id"))
    return learning.fill_heights(written(df, "heights"), settings, enable_ml)


def run(
    spark: SparkSession,
    path_a: str,
    path_b: str,
    settings: config.Settings = config.Settings(),
    enable_ml: bool = True,
    metric: bool = False,
) -> Result:
    """All stages over two CSV sources. metric: their coordinates are metres already."""
    a, b = tables.load_sources(spark, path_a, path_b)
    (a, a_before, a_after), (b, b_before, b_after) = (topology.run(x, metric=metric) for x in (a, b))
    a, b = (written(located(x, metric), "located") for x in (a, b))
    edges = [topology.coverage_edges(x, settings.gap_width, settings.grid_cell) for x in (a, b)]
    a, b = (written(x, "clean") for x in clean_sources(a, b, settings))
    strong, members, components = spatial_matching(a, b, settings)
    components = written(components, "components")
    filled, summary = height_recovery(components, members, a, b, settings, enable_ml, metric)
    scored = risk.risk_scoring(filled.withColumn("footprint_area_m2", F.col("area")), settings)
    return Result(a, b, strong, components, written(scored, "final"), summary, a_before, a_after, b_before, b_after, *edges)


def save(result: Result, folder: str) -> None:
    """Parquet of every table, CSV of the flat ones, GeoJSON of the map layer."""
    for name in config.OUTPUTS:
        df = getattr(result, name)
        if name == "frontend":
            geojson.save_geojson(df, f"{folder}/frontend.geojson")
            continue
        if name == "ml_cv_summary" and df.isEmpty():
            continue
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        tables.save_csv(df, f"{folder}/{name}.csv")


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Building heights from two sources of footprints")
    p.add_argument("--path-a", required=True)
    p.add_argument("--path-b", required=True)
    p.add_argument("--processed-dir", required=True)
    p.add_argument("--disable-ml", action="store_true")
    p.add_argument("--tiles-dir", help="write the map layer as vector tiles there")
    return p


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName("rooftop").getOrCreate()
    result = run(spark, args.path_a, args.path_b, enable_ml=not args.disable_ml)
    cleaning.summary(result.a_prepared, result.b_prepared).show(50, False)
    save(result, args.processed_dir)
    if args.tiles_dir:
        vector_tiles.save_vector_tiles(result.frontend, args.tiles_dir)


if __name__ == "__main__":
    main()
