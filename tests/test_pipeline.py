import os

import pytest
from pyspark.sql import functions as F

from rooftop import config
from rooftop.plans import pipeline
from rooftop.plans.fixtures import buildings, with_wkt
from rooftop.sources import tables

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_run_from_csv_to_layer(spark, tmp_path):
    a, b = (with_wkt(x, "geometry").drop("minx", "miny", "maxx", "maxy", "area", "cx", "cy", "x0", "y0", "w", "h") for x in buildings(spark, DATA))
    for df, name in ((a, "a"), (b, "b")):
        tables.save_csv(df.orderBy("row_idx").drop("row_idx").coalesce(1), f"{tmp_path}/{name}.csv")
    settings = config.Settings(permutations=49, trees=3, folds=2, group_cell=400.0)
    result = pipeline.run(spark, f"{tmp_path}/a.csv", f"{tmp_path}/b.csv", settings, enable_ml=False, metric=True)
    final = result.final_results
    n = final.count()
    assert n == result.matched_buildings.count() and final.select("component_id").distinct().count() == n
    assert result.a_prepared.count() == a.count() and result.b_prepared.count() == b.count()
    assert final.where("eco_risk_level is null or eco_risk_score < 0 or eco_risk_score > 1").isEmpty()
    assert final.where("geometry is null or area is null").isEmpty()
    assert result.geometry_diag_a_after.where("needs_attention or wrong_ring_orientation").isEmpty()
    assert not result.geometry_diag_a_before.where("wrong_ring_orientation").isEmpty()
    assert result.frontend.columns == config.FRONTEND_COLUMNS
    pipeline.save(result, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/final_results.parquet").count() == n
    assert spark.read.text(f"{tmp_path}/out/frontend.geojson").count() == n
    assert not os.path.exists(f"{tmp_path}/out/ml_cv_summary.parquet")


def test_degrees_become_metres(spark):
    df = spark.createDataFrame([(0, "POLYGON ((30.3 59.9, 30.301 59.9, 30.301 59.901, 30.3 59.901, 30.3 59.9))")], "row_idx long, geometry string")
    r = pipeline.located(df).first()
    assert r.area == pytest.approx(55.9 * 111.4, rel=0.01) and r.maxx - r.minx == pytest.approx(60.45, abs=0.1)


def test_command_line():
    args = pipeline.arguments().parse_args(["--path-a", "a", "--path-b", "b", "--processed-dir", "out", "--disable-ml"])
    assert args.disable_ml and args.processed_dir == "out"
