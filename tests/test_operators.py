import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rooftop import config
from rooftop.operators import cleaning, graph, heights, learning, matching, risk, serving, spatial
from rooftop.sources import geojson, tables
from rooftop.streaming import flags


@pytest.mark.parametrize("phys,iqr,lisa,group,reason", [
    (True, True, True, "physical_bad", "iqr_and_lisa"), (True, False, False, "physical_bad", "physical_bounds"), (False, True, True, "iqr_and_lisa", "iqr_and_lisa"),
    (False, True, False, "iqr_only", None), (False, False, True, "lisa_only", None), (False, False, False, "clean", None),
])
def test_precedence_of_faults(spark, phys, iqr, lisa, group, reason):
    df = spark.createDataFrame([(9.0, phys, iqr, lisa)], "height double, height_phys_bad boolean, height_iqr_bad boolean, lisa_flag boolean")
    r = cleaning.domain_cap(cleaning.height_clean_final(cleaning.review_groups(df))).first()
    assert (r.review_group, r.height_drop_reason, r.height_clean_final) == (group, reason, None if phys or (iqr and lisa) else 9.0)


def test_bounds_nulls_and_floors(spark):
    df = spark.createDataFrame([(9.0, 5.0, 30.0), (0.0, 5.0, 20.0), (None, 88.0, None)], "gkh_floor_count_min double, gkh_floor_count_max double, area_sq_m double")
    rows = cleaning.clean_a(df, config.Settings()).collect()
    assert [(r.gkh_floor_count_min_clean, r.gkh_floor_count_max_clean, r.gkh_floor_mid) for r in rows] == [(5.0, 9.0, 7.0), (None, 5.0, None), (None, None, None)]
    assert [r.gkh_min_gt_max for r in rows] == [True, False, False] and [r.area_sq_m_phys_bad for r in rows] == [False, True, False]


def _rule(spark, h, stairs, afh, low, high, areas=(1.0, 3.0), compat=False):
    df = spark.createDataFrame([(list(h), list(areas), list(areas)[: len(h)], list(stairs), list(afh), list(low), list(high))], "b_height_values array<double>, b_area_values array<double>, b_height_areas array<double>, b_stairs_values array<double>, b_afh_values array<double>, a_floor_min_values array<double>, a_floor_max_values array<double>")
    r = heights.select_height(df, compat=compat).first()
    return r.height_source, r.confidence_score, r.height_final, r.b_internal_ok, r.a_agree_with_b


def test_height_rule(spark):
    ok = ([4.0], [3.0])
    assert _rule(spark, [12.0], *ok, [4.0], [5.0]) == ("B_direct_high", 0.95, 12.0, True, True)
    assert _rule(spark, [12.0], *ok, [], []) == ("B_direct_high", 0.90, 12.0, True, None)
    assert _rule(spark, [40.0], *ok, [4.0], [5.0]) == ("B_conflict_with_A", 0.60, 40.0, False, False)
    assert _rule(spark, [12.0], [], [], [4.0], [5.0]) == ("B_direct_medium", 0.80, 12.0, None, True)
    assert _rule(spark, [10.0, 14.0], *ok, [9.0], [9.0]) == ("B_weighted_conflict_with_A", 0.55, 13.0, None, False)
    assert _rule(spark, [10.0, 14.0], *ok, [4.0], []) == ("B_weighted", 0.75, 13.0, None, None)
    source, confidence, height, *_ = _rule(spark, [], *ok, [4.0], [5.0])
    assert (source, confidence, height) == ("A_range_only", 0.45, pytest.approx(13.1))
    assert _rule(spark, [], *ok, [], [5.0]) == ("unknown", 0.0, None, None, None)
    assert _rule(spark, [40.0], *ok, [4.0], [5.0], compat=True)[:2] == ("B_direct_medium", 0.80)


def test_eco_levels(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.33, 0.330001, 0.66, 1.0, None)], "s double")
    assert [r[0] for r in df.select(risk.eco_level(F.col("s"))).collect()] == ["low", "low", "medium", "medium", "high", None]


def test_insight_cascade_and_labels(spark):
    df = spark.createDataFrame([(None, 0.9, None, "N:N"), (0.8, 0.1, "low", "odd"), (0.1, 0.1, "high", None), (0.1, 0.9, "high", "1:1"), (0.5, 0.9, "low", "1:1"), (0.1, 0.9, "low", "1:1")], "dense_score double, confidence_score double, eco_risk_level string, match_type string").withColumn("height_final_full", F.lit(2.25))
    rows = serving.tooltip(serving.insight(df)).collect()
    assert [r.insight_level for r in rows] == ["warning", "danger", "warning", "danger", "warning", "good"]
    assert [r.tip_match for r in rows[:3]] == [serving.MATCH_LABELS["N:N"], "odd", "—"] and rows[0].tip_height == "2.3 м" and rows[0].tip_density == "—"


def test_height_half_whose_last_bit_is_off(spark):
    df = spark.createDataFrame([(27.849999999999998, "27.9 м"), (27.85, "27.9 м"), (27.84, "27.8 м"), (0.05, "0.1 м"), (12.0, "12.0 м"), (None, "—")], "height_final_full double, want string")
    df = df.withColumns({"confidence_score": F.lit(0.5), "dense_score": F.lit(0.5), "match_type": F.lit("1:1"), "eco_risk_level": F.lit("low")})
    assert all(r.tip_height == r.want for r in serving.tooltip(df).collect())


def test_components_of_random_graphs(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {v: v for e in edges for v in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.v: r.label for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {v: find(v) for v in parent}


def test_no_pairs_gives_lone_components(spark):
    box = "row_idx long, minx double, miny double, maxx double, maxy double, area double"
    a, b = spark.createDataFrame([(0, 0.0, 0.0, 1.0, 1.0, 1.0)], box), spark.createDataFrame([(0, 5.0, 5.0, 6.0, 6.0, 1.0), (1, None, None, None, None, None)], box)
    strong = matching.strong_pairs(matching.match_pairs(a, b, config.Settings()))
    table = matching.component_table(matching.membership(a, b, strong)).collect()
    assert sorted((r.component_id, r.match_type) for r in table) == [(0, "A_only"), (1, "B_only"), (2, "B_only")]


def test_box_join_counts_touching_pairs_once(spark):
    rnd = random.Random(2)
    make = lambda n: [(i, x := rnd.uniform(-300, 300), y := rnd.uniform(-300, 300), x + rnd.choice([0, 64, 10, 200]), y + rnd.uniform(0, 150)) for i in range(n)]
    a, b = make(60), make(70)
    df = [spark.createDataFrame(x, f"i{s} long, minx double, miny double, maxx double, maxy double") for x, s in ((a, "a"), (b, "b"))]
    want = sorted((p[0], q[0]) for p, q in itertools.product(a, b) if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert sorted((r.ia, r.ib) for r in spatial.box_join(*df).collect()) == want


def test_nearest_equals_brute_force(spark):
    rnd = random.Random(3)
    train = [(i, rnd.gauss(0, 900), rnd.gauss(0, 900), float(i)) for i in range(80)]
    queries = [(i, rnd.gauss(0, 3000), rnd.gauss(0, 300)) for i in range(30)] + [(99, None, None)]
    got = spatial.nearest(spark.createDataFrame(queries, "row_idx long, cx double, cy double"), spark.createDataFrame(train, "row_idx long, cx double, cy double, height_final double"), 5, 50.0).collect()
    found = {}
    for r in got:
        found.setdefault(r.row_idx, []).append((r.place, r.train_idx))
    want = {q: [t for _, t in sorted(((x - a) ** 2 + (y - b) ** 2, t) for t, a, b, _ in train)[:5]] for q, x, y in queries[:-1]}
    assert {q: [t for _, t in sorted(v)] for q, v in found.items()} == want


def test_permutations_are_seeded_and_spread(spark):
    pts = spark.createDataFrame([(i, float(i % 20) * 10, float(i // 20) * 10, float((i * 37) % 11)) for i in range(200)], "row_idx long, cx double, cy double, height_z double").withColumn("is_island", F.lit(False))
    moran = spatial.local_moran(pts, 25.0)
    first = {r.row_idx: r.lisa_p for r in spatial.permutation_p(moran, 199).collect()}
    assert first == {r.row_idx: r.lisa_p for r in spatial.permutation_p(moran.repartition(3), 199).collect()}
    assert all(0 < p <= 0.51 for p in first.values()) and len(set(first.values())) > 20


def _brute_p(rows, at, permutations, seed=42):
    i, z, k, lag = rows[at]
    others, rng = np.array([r[1] for r in rows if r[0] != i]), np.random.default_rng([seed, i])
    picks = np.sort(rng.integers(0, len(others), (permutations, k)), axis=1)
    if k * 4 > len(others):
        picks = np.argsort(rng.random((permutations, len(others))), axis=1)[:, :k]
    else:
        while (again := np.diff(picks, axis=1, prepend=-1) == 0).any():
            picks[again] = rng.integers(0, len(others), int(again.sum()))
            picks.sort(axis=1)
    lags = others[picks].mean(axis=1)
    larger = int((z * lags >= z * lag).sum())
    return (min(larger, permutations - larger) + 1) / (permutations + 1)


@pytest.mark.parametrize("block", [spatial.BLOCK, 30_000])
def test_permutations_draw_from_all_rows(spark, block):
    rnd = random.Random(4)
    rated = {5: 7, 40_001: 40, 69_999: 300, 60_000: 68_000}  # neighbours of the rows that have any
    rows = [(i, rnd.gauss(0, 1), rated.get(i, 0), rnd.gauss(0, 0.2) if i in rated else None) for i in range(70_000)]
    df = spark.createDataFrame(rows, "row_idx long, z double, k long, lag double").repartition(3)
    out = spatial.permutation_p(df, 19, block=block)
    assert out.columns == [*df.columns, "lisa_p"]
    got = {r.row_idx: r.lisa_p for r in out.collect()}
    assert len(got) == len(rows) and all((p is None) == (i not in rated) for i, p in got.items())
    assert {i: got[i] for i in rated} == {i: _brute_p(rows, i, 19) for i in rated}


def test_duplicates_keep_the_first_row(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "a", "x"), (0, None, None), (5, None, None)], "row_idx long, id string, v string")
    assert sorted(r.row_idx for r in tables.drop_duplicates(df, []).collect()) == [0, 1, 2]
    assert sorted(r.row_idx for r in tables.drop_duplicates(df, ["id"]).collect()) == [0, 1]


def test_csv_in_and_out(spark, tmp_path):
    (tmp_path / "b.csv").write_text(',wkt,height,number,note\n0,"POLYGON ((0 0, 1 0, 1 1, 0 0))",12.5,5а,"two\nlines, ""quoted"""\n1,,NA,,\n1,,NA,,\n', encoding="utf-8")
    rows = sorted(tables.load_b(spark, str(tmp_path / "b.csv")).collect(), key=lambda r: r.row_idx)
    assert [(r.row_idx, r.height, r.number, r.stairs) for r in rows] == [(0, 12.5, "5а", None), (1, None, None, None)]
    assert rows[0].note == 'two\nlines, "quoted"' and rows[0].geometry.startswith("POLYGON")
    (tmp_path / "a.csv").write_text("id\n1\n")
    with pytest.raises(KeyError):
        tables.load_a(spark, str(tmp_path / "a.csv"))


def test_features_and_tiles(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "POLYGON ((0 0, 1 0, 1 1, 0 0))", 30.3, 59.9), (2, 3.5, None, 30.4, 59.9)], "component_id long, height_final_full double, geometry string, lon double, lat double")
    texts = [r.feature for r in geojson.features(df.drop("lon", "lat")).collect()]
    assert '"height_final_full":null' in texts[0] and '"coordinates":[[[0.0,0.0]' in texts[0] and texts[1].endswith('"geometry":null}')
    geojson.save_tiles(df, str(tmp_path / "tiles"))
    one = serving.tiles(df, range(12, 13)).first()
    assert geojson.read_tile(spark, str(tmp_path / "tiles"), 12, one.x, one.y).count() >= 1


def test_stream_counts_faults(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("2024-01-01 00:01:00", 500.0), ("2024-01-01 00:02:00", 10.0), ("2024-01-01 01:30:00", None)], "ts string, height double").select(F.to_timestamp("ts").alias("ts"), "height").write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, height double").parquet(str(tmp_path / "in"))
    q = flags.fault_counts(stream).writeStream.format("memory").queryName("faults").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.rows, r.faults) for r in spark.table("faults").collect()) == [(1, 0), (2, 1)]


def _places(spark, n):
    return spark.createDataFrame([(i, float(i % 7), float(i // 7), float(i)) for i in range(n)], "row_idx long, cx double, cy double, height_final double")


def test_pairs_within_a_radius_broadcast_no_copied_points(spark):
    pairs = spatial.radius_pairs(_places(spark, 50), 1.0)
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert {(r.id, r.other) for r in pairs.collect()} == {(i, j) for i in range(50) for j in range(50) if abs(i % 7 - j % 7) + abs(i // 7 - j // 7) == 1}


@pytest.mark.parametrize("most", [0, 100])
def test_nearest_broadcasts_only_counted_queries(spark, monkeypatch, most):
    plans, write = [], spatial.written

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(spatial, "written", seen)
    monkeypatch.setattr(spatial, "MOST_OPEN", most)
    points = _places(spark, 50).unionByName(spark.createDataFrame([(99, 500.0, 500.0, 1.0)], "row_idx long, cx double, cy double, height_final double"))
    out = learning.knn_features(points, _places(spark, 50), 5, 2.0)
    plans.append(("knn", out._jdf.queryExecution().executedPlan().toString()))
    assert sum(n == "nearest" for n, _ in plans) > 1
    assert all("BroadcastHashJoin" not in p for n, p in plans if not (most and n == "nearest"))
    got = {r.row_idx: r.knn_dist_mean for r in out.collect()}
    for i, x, y, _ in [*points.collect()]:
        want = sorted(math.dist((x, y), (j % 7, j // 7)) for j in range(50))[:5]
        assert got[i] == pytest.approx(sum(want) / 5)
