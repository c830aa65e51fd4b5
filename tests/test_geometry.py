import random

import pytest
from pyspark.sql import functions as F

from rooftop.functions import geometry, shapes, text

SQUARE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
HOLED = "POLYGON ((0 0, 6 0, 6 6, 0 6, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2))"


def polygons(wkt):
    return shapes.polygonal(*shapes.read(wkt))


@pytest.mark.parametrize("a,b,want", [
    ("POLYGON ((0 0, 4 0, 4 1, 1 1, 1 4, 0 4, 0 0))", "POLYGON ((.5 .5, 3 .5, 3 3, .5 3, .5 .5))", 2.25),
    (HOLED, "POLYGON ((1 1, 5 1, 5 5, 1 5, 1 1))", 12.0),
    (SQUARE, "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))", 0.0),
    (SQUARE, "POLYGON ((0 0, 2 4, 4 0, 0 0))", 8.0),
    (SQUARE, "MULTIPOLYGON (((1 1, 2 1, 2 2, 1 2, 1 1)), ((3 3, 9 3, 9 9, 3 9, 3 3)))", 2.0),
])
def test_intersection_area(a, b, want):
    assert shapes.intersection_area(polygons(a), polygons(b)) == pytest.approx(want)
    assert shapes.intersection_area(polygons(b), polygons(a)) == pytest.approx(want)


def test_areas_of_random_triangles():
    rnd = random.Random(4)
    for _ in range(60):
        a, b = ([[[*(t := [(rnd.random(), rnd.random()) for _ in range(3)]), t[0]]]] for _ in range(2))
        whole = sum(abs(shapes.ring_area(p[0][0])) for p in (a, b))
        both, union = shapes.intersection_area(a, b), shapes.union_area(a + b)
        assert both + union == pytest.approx(whole)
        outline = shapes.union(a + b)
        assert sum(shapes.ring_area(r) for p in outline for r in p) == pytest.approx(union, abs=1e-6)


def test_union_shapes():
    assert shapes.joined([SQUARE, "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))"]).count(",") == 4
    ring = ["POLYGON ((0 0, 3 0, 3 1, 0 1, 0 0))", "POLYGON ((0 2, 3 2, 3 3, 0 3, 0 2))", "POLYGON ((0 0, 1 0, 1 3, 0 3, 0 0))", "POLYGON ((2 0, 3 0, 3 3, 2 3, 2 0))"]
    (outer, hole), = shapes.union([p for w in ring for p in polygons(w)])
    assert shapes.ring_area(outer) == pytest.approx(9) and shapes.ring_area(hole) == pytest.approx(-1)
    assert len(shapes.union(polygons(SQUARE) + [[[(x + 9, y) for x, y in polygons(SQUARE)[0][0]]]])) == 2


@pytest.mark.parametrize("wkt,valid", [
    (SQUARE, True), (HOLED, True), ("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))", False), ("POLYGON ((0 0, 1 0, 1 1, 0 1))", False),
    ("POLYGON ((0 0, 1 0, 0 0))", False), ("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (5 5, 6 5, 6 6, 5 6, 5 5))", False),
])
def test_validity(wkt, valid):
    assert (shapes.fault(polygons(wkt)) is None) == valid


def test_repair():
    bow = polygons(shapes.repaired("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"))
    assert len(bow) == 2 and sum(shapes.ring_area(p[0]) for p in bow) == pytest.approx(2) and shapes.fault(bow) is None
    assert shapes.repaired("POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0))") == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
    assert shapes.fault(polygons(shapes.repaired("POLYGON ((0 0, 1 0, 1 1, 0 1))"))) is None
    assert shapes.repaired("LINESTRING (0 0, 1 1)") is None and shapes.repaired(None) is None and shapes.repaired("junk") is None
    assert shapes.repaired("POLYGON EMPTY") == "POLYGON EMPTY"
    assert len(polygons(shapes.repaired(f"GEOMETRYCOLLECTION (POINT (1 1), {SQUARE}, POLYGON ((9 9, 10 9, 10 10, 9 9)))"))) == 2


def test_columns(spark):
    moved = "MULTIPOLYGON (((0 0, 3 0, 3 2, 0 2, 0 0)), ((10 10, 10 12, 12 12, 12 10, 10 10)))"
    df = spark.createDataFrame([(1, SQUARE), (2, HOLED), (3, moved), (4, None), (5, "POLYGON EMPTY"), (6, "POINT (1 1)")], "i int, wkt string")
    s = F.col("s")
    df = df.select("i", geometry.parse_wkt(F.col("wkt")).alias("s")).select("i", geometry.area(s).alias("area"), geometry.perimeter(s).alias("around"), geometry.wrong_orientation(s).alias("wrong"), geometry.write_wkt(s).alias("wkt"), *[v.alias(k) for k, v in {**geometry.centroid(s), **geometry.box(s)}.items()])
    got = {r.i: r for r in df.collect()}
    assert [got[i].area for i in range(1, 7)] == [16.0, 32.0, 10.0, None, 0.0, None]
    assert (got[1].cx, got[1].cy, got[1].around, got[1].maxx) == (2.0, 2.0, 16.0, 4.0)
    assert (got[2].cx, got[2].cy) == (3.0, 3.0) and got[2].around == 32.0
    assert got[3].cx == pytest.approx((1.5 * 6 + 11 * 4) / 10) and got[3].wrong and not got[1].wrong and got[4].wrong is False
    assert [got[i].wkt for i in (1, 3, 4, 5)] == [SQUARE, moved, None, "POLYGON EMPTY"]
    assert got[5].cx is None and got[5].minx is None


def test_utm(spark):
    df = spark.createDataFrame([(33.0, 0.0), (30.3141, 59.9386)], "lon double, lat double")
    x, y = geometry.utm(F.col("lon"), F.col("lat"))
    rows = [tuple(r) for r in df.select(x, y).collect()]
    assert rows[0] == pytest.approx((500000, 0), abs=1e-6) and rows[1] == pytest.approx((349936.584, 6647618.287), abs=1e-2)


@pytest.mark.parametrize("raw,norm,house", [
    ("дом 5а-б, корп.", "дом 5а б корп", "5а"), ("пр 5а", "пр 5а", "5а"), ("12к", "12к", "12к"), ("12к1", "12к1", ""), (None, "", ""), ("  Ёлка\t 7 ", "елка 7", "7"),
])
def test_addresses(spark, raw, norm, house):
    df = spark.createDataFrame([(raw,)], "x string")
    assert tuple(df.select(text.norm_text(F.col("x")), text.house_number(F.col("x"))).first()) == (norm, house)
