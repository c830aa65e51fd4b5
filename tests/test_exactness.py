"""Operators against brute force where SQL doesn't reach, or only on tame data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions import shapes
from rooftop.operators import cleaning, learning, matching, serving, spatial, statistics, topology
from rooftop.sources import tables


def test_ranges_are_alike_under_an_outlier(spark):
    values = spark.range(40_000).select((F.rand(3) * F.rand(4) * 100).alias("v"), F.lit(1).cast("long").alias("c")).union(spark.createDataFrame([(1e12, 1), (-1e12, 1)], "v double, c long"))
    parts = sorted(r.n for r in statistics.in_ranges(values.dropDuplicates(["v"])).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    assert len(parts) > 1 and parts[-1] <= 2 * parts[len(parts) // 2]


@pytest.mark.parametrize("most", [0, 10**6], ids=["ranges", "one task"])
def test_ranks_with_outliers_ties_and_nulls(spark, most):
    rnd = random.Random(2)
    values = [rnd.choice([None, 1.0, 2.5, rnd.gauss(0, 1), 1e300, -1e12]) for _ in range(500)]
    got = {r.v: (r.c, r.before, r.n) for r in statistics.value_ranks(spark.createDataFrame([(v,) for v in values], "x double").repartition(5), "x", most).collect()}
    known = [v for v in values if v is not None]
    assert got == {v: (known.count(v), sum(w < v for w in known), len(known)) for v in known}
    assert statistics.value_ranks(spark.createDataFrame([(None,)], "x double"), "x", most).count() == 0


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("k", [1, 4, 500])
def test_nearest_with_far_and_equal_points(spark, k, exclude_self):
    rnd = random.Random(1)
    points = [(i, rnd.gauss(0, 30), rnd.gauss(0, 30)) for i in range(120)] + [(200 + i, 5000 + rnd.random(), 9000.0) for i in range(3)]
    points += [(300, 1e6, -1e6), (301, -4e5, 0.0), (302, 1.0, 1.0), (303, 1.0, 1.0), (304, None, 1.0)]
    trained = [p for p in points if p[0] % 3 == 0 or p[0] >= 300]
    queries = spark.createDataFrame(points, "row_idx long, cx double, cy double")
    train = spark.createDataFrame([(*p, float(p[0])) for p in trained], "row_idx long, cx double, cy double, height_final double")
    got = {}
    for r in spatial.nearest(queries, train, k, 200.0, exclude_self=exclude_self).collect():
        assert r.y == r.train_idx
        got.setdefault(r.row_idx, []).append((r.place, r.train_idx, round(r.d, 6)))
    pool = [p for p in trained if p[1] is not None]
    for i, x, y in points:
        if x is None:
            assert i not in got
            continue
        want = sorted((math.hypot(x - a, y - b), j) for j, a, b in pool if not (exclude_self and i == j))[: min(k, len(pool) - exclude_self)]
        assert sorted(got[i]) == [(n + 1, j, round(d, 6)) for n, (d, j) in enumerate(want)]
    assert spatial.nearest(queries, train.limit(0), k, 200.0).count() == 0 == spatial.nearest(queries.limit(0), train, k, 200.0).count()


def _components(spark, n=400):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        x, y, w, h = rnd.uniform(0, 3000), rnd.uniform(0, 3000), rnd.uniform(8, 30), rnd.uniform(8, 30)
        height = None if i % 7 == 0 else -1.0 if i == 50 else 3.0 + w / 2 + x / 300
        rows.append((i, rnd.choice(["1:1", "B_only", None]), 1, 1, rnd.random(), rnd.random(), rnd.random(), w * h, 2 * (w + h), x, y, x + w, y + h, x + w / 2, y + h / 2, height, "unknown" if height is None else "B_direct_high", height is None))
    names = "row_idx long, match_type string, n_a int, n_b int, max_iou double, max_overlap_a double, max_overlap_b double, area double, perimeter double, minx double, miny double, maxx double, maxy double, cx double, cy double, height_final double, height_source string, needs_ml boolean"
    return spark.createDataFrame(rows, names), rows


def test_folds_by_the_lightest_first(spark):
    df, rows = _components(spark)
    got = {r.spatial_group: (r["size"], r.fold) for r in learning.folds(learning.spatial_groups(df, 700.0), 3).collect()}
    sizes, loads, want = {}, [0, 0, 0], {}
    for r in rows:
        group = f"{math.floor(r[13] / 700)}_{math.floor(r[14] / 700)}"
        sizes[group] = sizes.get(group, 0) + 1
    for group in sorted(sizes, key=lambda g: (-sizes[g], g)):
        fold = min(range(3), key=lambda f: (loads[f], f))
        loads[fold] += sizes[group]
        want[group] = (sizes[group], fold)
    assert got == want


def test_cross_validation_and_fill(spark):
    df, rows = _components(spark)
    settings = config.Settings(trees=12, folds=3, group_cell=700.0)
    train = learning.shape_features(df).where("height_final > 0")
    summary = learning.spatial_cv(train, settings).collect()
    assert {r.model for r in summary} == {"GBT", "RandomForest"} and [r.RMSE for r in summary] == sorted(r.RMSE for r in summary)
    spread = np.std([r[15] for r in rows if r[15] is not None and r[15] > 0])
    assert all(0 < r.MAE <= r.RMSE < spread and 0.3 < r.R2 < 1 for r in summary)  # far better than the mean
    filled, again = learning.fill_heights(df, settings)
    assert {r.model for r in again.collect()} == {"GBT", "RandomForest"}
    best = again.first().model
    for r in filled.collect():
        if r.needs_ml:
            assert r.ml_model_name == best and r.height_source_full == "ML" and r.height_final_full == r.height_ml and 2 < r.height_ml < 35
        else:
            assert r.height_ml is None and r.ml_model_name is None and r.height_final_full == r.height_final and r.height_source_full == r.height_source
    for few in (df.limit(8), df.where("not needs_ml")):
        same, none = learning.fill_heights(few, settings)
        assert none.count() == 0 and same.where("height_ml is not null or ml_model_name is not null").count() == 0
    assert learning.spatial_cv(train, config.Settings(trees=2, group_cell=1e9)).count() == 0


def test_clean_for_model_nulls_what_is_not_positive(spark):
    df = spark.createDataFrame([(1, -1.0, 0.0, "a", 5), (2, 0.0, 4.0, None, -5)], "row_idx long, x double, height_final double, kind string, other int")
    assert [tuple(r) for r in learning.clean_for_model(df, ["x", "kind"], others=["other"]).orderBy("row_idx").collect()] == [(1, None, "a", None, 5), (2, 0.0, None, 4.0, -5)]


def test_survey_cleaning_with_the_real_autocorrelation(spark):
    rnd = random.Random(11)
    rows = [(i, 28.0 * (i % 12) + rnd.random(), 28.0 * (i // 12) + rnd.random(), 10 + rnd.gauss(0, 1)) for i in range(144)]
    rows[77] = (*rows[77][:3], 16.0)
    rows[30], rows[31], rows[32] = (*rows[30][:3], 120.0), (*rows[31][:3], 900.0), (*rows[32][:3], None)
    rows.append((144, 9000.0, 9000.0, 10.5))  # an island
    df = spark.createDataFrame([(*r, 3.0, 3.0) for r in rows], "row_idx long, cx double, cy double, height double, stairs double, avg_floor_height double")
    settings = config.Settings(lisa_radius=60.0, permutations=199)
    got = {r.row_idx: r for r in cleaning.clean_b(df, settings).collect()}
    h = np.array([np.nan if r[3] is None else r[3] for r in rows])
    q1, q3 = np.nanquantile(h, [0.25, 0.75])
    phys, iqr = (h < 2) | (h > 462), (h < q1 - 1.5 * (q3 - q1)) | (h > q3 + 1.5 * (q3 - q1))
    clean = np.where(phys | iqr, np.nan, h)
    z = (h - np.nanmean(clean)) / np.nanstd(clean, ddof=1)
    xy = np.array([r[1:3] for r in rows])
    close = (np.hypot(*(xy[:, None] - xy[None]).transpose(2, 0, 1)) <= 60) & ~np.eye(len(rows), dtype=bool)
    island = ~close.any(1)
    inside = ~island & ~np.isnan(z)
    z = np.where(inside, z - z[inside].mean(), np.nan)
    places = np.flatnonzero(inside)
    for i in range(len(rows)):
        r, lisa = got[i], False
        assert r.is_island == island[i]
        if not inside[i]:
            assert r.lisa_p is None
        else:
            near = close[i] & inside
            lag = z[near].mean()
            assert r.lisa_I == pytest.approx((inside.sum() - 1) * z[i] * lag / (z[inside] ** 2).sum())
            others = z[places[places != i]]
            # the permutations: what the operator draws, and independent ones for the size of p
            drawn = np.concatenate([others[p].sum(axis=1) for p in spatial._picks(np.random.default_rng([settings.seed, i]), 199, int(near.sum()), len(others))]) / near.sum()
            larger = (z[i] * drawn >= z[i] * lag).sum()
            assert r.lisa_p == pytest.approx((min(larger, 199 - larger) + 1) / 200)
            own = np.array([np.random.default_rng(1000 * i + j).permutation(others)[: near.sum()].mean() for j in range(199)])
            more = (z[i] * own >= z[i] * lag).sum()
            assert abs(r.lisa_p - (min(more, 199 - more) + 1) / 200) < 0.16
            lisa = bool(r.lisa_p < 0.05 and z[i] > 0 and lag <= 0)
        assert r.lisa_flag == lisa
        group = "physical_bad" if phys[i] else "iqr_and_lisa" if iqr[i] and lisa else "lisa_only" if lisa else "iqr_only" if iqr[i] else "clean"
        reason = "iqr_and_lisa" if iqr[i] and lisa else "physical_bounds" if phys[i] else None
        assert (r.review_group, r.height_drop_reason) == (group, reason)
        assert r.height_clean_final == (None if reason or np.isnan(h[i]) else h[i])


def test_members_in_the_order_of_texts(spark):
    members = spark.createDataFrame([("A", i, 4) for i in (2, 10, 1)] + [("B", i, 4) for i in (30, 4, 200)] + [("B", 7, 15)], "source string, row_idx long, label long")
    got = {r.component_id: (r.a_idxs, r.b_idxs) for r in matching.component_table(members, compat=True).collect()}
    assert got == {0: ([1, 10, 2], [200, 30, 4]), 1: ([], [7])}
    assert matching.component_table(members).first().a_idxs == [1, 2, 10]


def test_csv_places_in_split_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f'{i},"POLYGON ((0 0, {i} 0, 1 1, 0 0))",{i / 2}' for i in range(6000)]
    for n, part in enumerate((lines[:3500], lines[3500:])):
        (folder / f"{n}.csv").write_text("id,geometry,height\n" + "\n".join(part) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        raw = tables.read_csv(spark, str(folder), multi_line=False)
        assert sorted((r.row_idx, r.id) for r in raw.collect()) == [(i, str(i)) for i in range(6000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.row_idx, r.height) for r in tables.load_b(spark, str(folder)).collect()) == [(i, i / 2) for i in range(6000)]


def test_edges_that_break_a_coverage():
    square = lambda x, y, s=4.0: [[[(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]]]
    count = lambda a, b, gap=0.2: (len(shapes.faulty_edges(a, b, gap)), len(shapes.faulty_edges(b, a, gap)))
    assert count(square(0, 0), square(4, 0)) == (0, 0)  # one common edge
    assert count(square(0, 0), square(4.1, 0)) == (1, 1) and count(square(0, 0), square(4.3, 0)) == (0, 0)  # a gap, an open space
    assert count(square(0, 0), square(4.1, 0), 0.05) == (0, 0)
    assert count(square(0, 0), square(4, 0, 2.0)) == (1, 1)  # along each other, ends that don't match
    assert count(square(0, 0), square(4, 4)) == (0, 0)  # a corner
    assert count(square(0, 0), square(2, 2)) == (2, 2) and count(square(0, 0), square(1, 1, 2.0)) == (0, 4)


def test_coverage_edges_of_rows(spark):
    rows = [(i, f"POLYGON (({x} 0, {x + 4} 0, {x + 4} 4, {x} 4, {x} 0))", x, 0.0, x + 4, 4.0) for i, x in enumerate((0.0, 4.1, 8.1, 12.5))]
    df = spark.createDataFrame(rows, "row_idx long, geom_wkt string, minx double, miny double, maxx double, maxy double")
    assert {r.row_idx: r.faulty_edges for r in topology.coverage_edges(df).collect()} == {0: "MULTILINESTRING ((4.0 0.0, 4.0 4.0))", 1: "MULTILINESTRING ((4.1 4.0, 4.1 0.0))"}


def test_search_needs_three_letters(spark):
    df = spark.createDataFrame([(i, f"Тёплая улица, {i}") for i in range(9)] + [(9, None)], "row_idx long, address string")
    assert [r.row_idx for r in serving.search(df, "ТЁПЛ").collect()] == [0, 1, 2, 3, 4] and serving.search(df, "тё").count() == 0


def test_union_of_a_large_component_by_parts(spark, monkeypatch):
    monkeypatch.setattr(matching, "UNION_PARTS", 3)
    square = lambda i: f"POLYGON (({i} 0, {i + 2} 0, {i + 2} 2, {i} 2, {i} 0))"
    b = spark.createDataFrame([(i, square(i)) for i in range(20)], "row_idx long, geom_wkt string")
    a = spark.createDataFrame([(i, square(100 * i)) for i in range(3)], "row_idx long, geom_wkt string")
    members = spark.createDataFrame([("B", i, 0) for i in range(20)] + [("A", 0, 0), ("A", 1, 5), ("A", 2, 9)], "source string, row_idx long, label long")
    components = spark.createDataFrame([(0, 0), (1, 5), (2, 9), (3, 77)], "component_id long, label long")
    got = {r.component_id: r.geom_wkt for r in matching.component_geometry(components, members, a, b).collect()}
    assert shapes.union_area(shapes._polygons(got[0])) == 42.0 and len(shapes._polygons(got[0])) == 1
    assert (got[1], got[2], got[3]) == (square(100), square(200), None)


def test_geometry_columns_hold_texts_or_polygons(spark):
    from rooftop.functions import geometry

    df = spark.createDataFrame([(1, "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))")], "row_idx long, geometry string")
    made = df.withColumn("geometry", geometry.shapes_of(df))
    assert made.select(geometry.area(geometry.shapes_of(made)).alias("a")).first().a == 2.0
    with pytest.raises(TypeError):
        geometry.shapes_of(df, "row_idx")


def test_vector_tiles_round_trip(spark, tmp_path):
    from rooftop.functions.shapes import ring_area
    from rooftop.sources import vector_tiles as mvt

    whole = [[[(-100, -100), (5000, -100), (5000, 5000), (-100, 5000), (-100, -100)], [(10, 10), (10, 50), (50, 50), (50, 10), (10, 10)]]]
    assert mvt._clipped([p for p in whole[0][0][:-1]], -64, 4160) and {abs(v) for p in mvt._clipped(whole[0][0][:-1], -64, 4160) for v in p} == {64, 4160}
    made = [({"a": 1, "b": "é", "c": 2.5, "d": True, "e": None, "f": -7}, [[[(0, 0), (10, 0), (10, 10), (0, 10)], [(2, 2), (2, 4), (4, 4), (4, 2)]], [[(20, 20), (30, 20), (30, 40)]]]), ({"a": 1}, [[[(-64, 5), (9, 5), (9, 9)]]])]
    got = mvt.decode(mvt.encode(made))
    assert got == [({k: v for k, v in p.items() if v is not None}, [r for q in g for r in q]) for p, g in made]
    layer = spark.createDataFrame(
        [(1, 0.5, "POLYGON ((30.30 59.90, 30.32 59.90, 30.32 59.91, 30.30 59.91, 30.30 59.90), (30.305 59.902, 30.31 59.902, 30.31 59.905, 30.305 59.905, 30.305 59.902))"), (2, None, "MULTIPOLYGON (((30.4 59.9, 30.41 59.9, 30.41 59.91, 30.4 59.9)), ((30.5 59.9, 30.51 59.9, 30.51 59.91, 30.5 59.9)))"), (3, 1.0, None), (4, 1.0, "POLYGON EMPTY"), (5, 1.0, "POLYGON ((30.3 59.9, 30.3000001 59.9, 30.3 59.9000001, 30.3 59.9))")],
        "component_id long, score double, geometry string",
    )
    mvt.save_vector_tiles(layer, f"{tmp_path}/tiles", range(10, 13))
    tiles = spark.read.parquet(f"{tmp_path}/tiles").collect()
    assert {r.z for r in tiles} == {10, 11, 12} and {p["component_id"] for r in tiles for p, _ in mvt.decode(bytes(r.tile))} == {1, 2}
    for r in tiles:
        for p, rings in mvt.decode(bytes(r.tile)):
            assert all(-64 <= v <= 4160 for ring in rings for q in ring for v in q) and ring_area([*rings[0], rings[0][0]]) > 0
            assert ("score" in p) == (p["component_id"] == 1)
    one = next(r for r in tiles if r.z == 11)
    assert mvt.read_vector_tile(spark, f"{tmp_path}/tiles", 11, one.x, one.y) == bytes(one.tile) and mvt.read_vector_tile(spark, f"{tmp_path}/tiles", 11, 0, 0) is None


def test_boxes_of_all_sizes_meet_once(spark):
    rnd = random.Random(3)
    box = lambda i, w: (i, (x := rnd.uniform(-500, 500)), (y := rnd.uniform(-500, 500)), x + w * rnd.random(), y + w * rnd.random())
    a = [box(i, rnd.choice([0, 20, 64, 500, 1e6])) for i in range(150)] + [(900, None, None, None, None), (901, 0.0, 0.0, 64.0, 64.0)]
    b = [box(i, rnd.choice([0, 20, 300])) for i in range(150)] + [(902, 64.0, 64.0, 128.0, 128.0), (903, -1e9, -1e9, 1e9, 1e9)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, minx double, miny double, maxx double, maxy double")
    got = sorted((r.ia, r.ib) for r in spatial.box_join(frame(a, "ia"), frame(b, "ib")).collect())
    assert got == sorted((p[0], q[0]) for p in a for q in b if p[1] is not None and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert spatial.box_join(frame(a, "ia"), frame([], "ib")).count() == 0


def test_neighbours_of_points_at_one_place(spark):
    rnd = random.Random(4)
    points = [(i, rnd.uniform(0, 300), rnd.uniform(0, 300), rnd.choice([None, 1.0, 7.0])) for i in range(60)] + [(100 + i, 50.0, 50.0, float(i)) for i in range(40)] + [(900, None, 2.0, 3.0), (901, 1e6, 0.0, 3.0)]
    df = spark.createDataFrame(points, "row_idx long, cx double, cy double, footprint_area_m2 double")
    got = {r.row_idx: r for r in spatial.neighbour_sums(df, 60.0).collect()}
    islands = {r.row_idx: r.is_island for r in spatial.with_islands(df, 60.0).collect()}
    assert got.keys() == islands.keys() == {p[0] for p in points}
    for i, x, y, _ in points:
        near = [p for p in points if x is not None and p[1] is not None and p[0] != i and math.hypot(p[1] - x, p[2] - y) <= 60]
        assert got[i].neighbors_250m == len(near) and got[i].neighbor_footprint_sum_250m == pytest.approx(sum(p[3] or 0 for p in near))
        assert islands[i] == (not near)
