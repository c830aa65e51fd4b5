"""Density of development and urban risk."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions.values import clip, flag, mapped
from rooftop.operators import spatial, statistics
from rooftop.session import written


def dense_development(points: DataFrame, settings: config.Settings = config.Settings()) -> DataFrame:
    """Adds neighbours, coverage, the thresholds' flags, dense_area and dense_score. Needs row_idx, cx, cy, footprint_area_m2.

    Rows without a centroid have no neighbours.
    """
    df = spatial.neighbour_sums(points, settings.dense_radius)
    df = written(df.withColumn("coverage_ratio_250m", F.col("neighbor_footprint_sum_250m") / (math.pi * settings.dense_radius**2)), "neighbours")
    columns = {"neighbors_250m": "dense_by_neighbors", "coverage_ratio_250m": "dense_by_coverage"}
    ranks = {c: statistics.value_ranks(df, c) for c in columns}
    limits = statistics.with_quantiles(df, {f"__{c}": (c, settings.dense_quantile) for c in columns}, ranks)
    limits = limits.withColumns({n: flag(F.col(c) >= F.col(f"__{c}")) for c, n in columns.items()}).drop(*[f"__{c}" for c in columns])
    ranked = written(statistics.with_rank_pct(limits, {c: f"__r_{c}" for c in columns}, ranks), "ranked")
    ranked = ranked.withColumns(
        {
            "dense_area": F.col("dense_by_neighbors") | F.col("dense_by_coverage"),
            "dense_score": F.col("__r_neighbors_250m") * 0.5 + F.col("__r_coverage_ratio_250m") * 0.5,
        }
    )
    return ranked.drop(*[f"__r_{c}" for c in columns])


def eco_level(score) -> F.Column:
    return F.when(score <= 0.33, "low").when(score <= 0.66, "medium").when(score.isNotNull(), "high")


def eco_risk(df: DataFrame) -> DataFrame:
    """Adds the risk's parts, eco_risk_score and eco_risk_level."""
    area = F.col("footprint_area_m2")
    df = df.withColumns({"footprint_area_m2": F.when(area > 0, area), "__height": F.col("height_final_full")})
    df = statistics.with_quantiles(df, {"__area": ("footprint_area_m2", 0.5), "__middle": ("height_final_full", 0.5)})
    filled = {"footprint_area_m2": F.coalesce("footprint_area_m2", "__area", F.lit(1.0)), "__height": F.coalesce("__height", "__middle", F.lit(0.0))}
    df = df.withColumns(
        {
            **filled,
            "dense_score_norm": clip(F.coalesce("dense_score", F.lit(0.0)), 0.0, 1.0),
            "__raw": F.coalesce("n_a", F.lit(0)) + F.coalesce("n_b", F.lit(0)),
            "match_risk_score": mapped(F.col("match_type"), config.MATCH_RISK, 0.5),
        }
    )
    df = written(df.drop("__area", "__middle"), "filled")
    df = statistics.with_rank_pct(df, {"__height": "height_score", "footprint_area_m2": "footprint_score", "__raw": "component_complexity_score"})
    df = df.withColumn("urban_complexity_score", F.col("match_risk_score") * 0.7 + F.col("component_complexity_score") * 0.3)
    score = F.col("dense_score_norm") * 0.45 + F.col("height_score") * 0.25 + F.col("footprint_score") * 0.15 + F.col("urban_complexity_score") * 0.15
    df = df.withColumn("eco_risk_score", clip(score, 0.0, 1.0)).drop("__height", "__raw")
    return df.withColumn("eco_risk_level", eco_level(F.col("eco_risk_score")))


def risk_scoring(points: DataFrame, settings: config.Settings = config.Settings()) -> DataFrame:
    """Density, then risk."""
    return eco_risk(dense_development(points, settings))
