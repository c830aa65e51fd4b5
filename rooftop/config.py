"""Every constant of the pipeline. Values are fixed by the task; change them through Settings."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Inclusive physical bounds of a good value.
BOUNDS = {
    "height": (2.0, 462.0),
    "stairs": (1.0, 87.0),
    "avg_floor_height": (2.5, 8.0),
    "gkh_floor_count_min": (1.0, 87.0),
    "gkh_floor_count_max": (1.0, 87.0),
    "area_sq_m": (30.0, 20000.0),
}
#: Largest cleaned values by city.
CITY_CAPS = {"spb": {"height": 462.0, "stairs": 87.0}}
#: Risk of a match type; others have 0.5.
MATCH_RISK = {"1:1": 0.2, "1:N": 0.7, "N:1": 0.7, "N:N": 1.0, "A_only": 0.5, "B_only": 0.5}
#: Columns of the map layer.
FRONTEND_COLUMNS = [
    "component_id",
    "match_type",
    "height_final_full",
    "confidence_score",
    "eco_risk_score",
    "eco_risk_level",
    "dense_area",
    "dense_score",
    "geometry",
]
#: Names of the tables that a run writes.
OUTPUTS = [
    "a_prepared",
    "b_prepared",
    "strong_pairs",
    "matched_buildings",
    "final_results",
    "frontend",
    "geometry_diag_a_before",
    "geometry_diag_a_after",
    "geometry_diag_b_before",
    "geometry_diag_b_after",
    "coverage_a",
    "coverage_b",
    "ml_cv_summary",
]


@dataclass(frozen=True)
class Settings:
    """Parameters of a run."""

    city: str = "spb"
    iqr_k: float = 1.5
    small_area: float = 20.0
    lisa_radius: float = 200.0
    lisa_p: float = 0.05
    permutations: int = 999
    iou: float = 0.3
    overlap: float = 0.8
    review_iou: float = 0.4
    floor_low: float = 2.8
    floor_high: float = 3.0
    tolerance: float = 3.0
    review_confidence: float = 0.65
    dense_radius: float = 250.0
    dense_quantile: float = 0.9
    group_cell: float = 2000.0
    neighbours: int = 5
    folds: int = 5
    trees: int = 300
    seed: int = 42
    grid_cell: float = 64.0
    gap_width: float = 0.2
    bounds: dict = field(default_factory=lambda: dict(BOUNDS))
