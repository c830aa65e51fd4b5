"""Polygons as columns: WKT, area, perimeter, box, centroid, ring order, projection to metres, map tiles.

A geometry is ARRAY<ARRAY<ARRAY<STRUCT<x, y>>>>: polygons, their rings (the outer first), points; rings are closed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def parse_wkt(wkt: Column) -> Column:
    """Polygons of a POLYGON or MULTIPOLYGON text; null for any other text, an empty array for EMPTY."""
    text = F.upper(F.trim(wkt))
    body = F.regexp_replace(F.regexp_replace(text, r"^(MULTI)?POLYGON\s*Z?M?\s*", ""), r"\s*([(),])\s*", "$1")
    multi = text.startswith("MULTIPOLYGON")
    inner = F.when(multi, F.regexp_replace(body, r"^\(\(\(|\)\)\)$", "")).otherwise(F.regexp_replace(body, r"^\(\(|\)\)$", ""))

    def point(p: Column) -> Column:
        xy = F.split(F.trim(p), r"\s+")
        return F.struct(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y"))

    rings = lambda s: F.transform(F.split(s, r"\),\("), lambda r: F.transform(F.split(r, ","), point))
    shapes = F.transform(F.when(multi, F.split(inner, r"\)\),\(\(")).otherwise(F.array(inner)), rings)
    empty = F.array().cast(POLYGONS)
    return F.when(text.rlike(r"^(MULTI)?POLYGON\s*Z?M?\s*EMPTY$"), empty).when(text.rlike(r"^(MULTI)?POLYGON\s*Z?M?\s*\("), shapes)


def shapes_of(df: DataFrame, column: str = "geometry") -> Column:
    """The polygons of a column of WKT texts, or of polygons already; TypeError for any other type."""
    kind = df.schema[column].dataType.simpleString()
    if kind not in ("string", POLYGONS):
        raise TypeError(f"{column} must hold WKT texts or polygons, not {kind}")
    return parse_wkt(F.col(column)) if kind == "string" else F.col(column)


def write_wkt(shapes: Column) -> Column:
    """POLYGON text for one polygon, MULTIPOLYGON for several, POLYGON EMPTY for none; null for null."""
    number = lambda v: F.when((v == F.floor(v)) & (F.abs(v) < 1e15), F.floor(v).cast("string")).otherwise(v.cast("string"))
    ring = lambda r: F.concat(
        F.lit("("),
        F.array_join(F.transform(r, lambda p: F.concat_ws(" ", number(p["x"]), number(p["y"]))), ", "),
        F.lit(")"),
    )
    polygon = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))
    whole = F.array_join(F.transform(shapes, polygon), ", ")
    return F.when(F.size(shapes) == 0, "POLYGON EMPTY").when(F.size(shapes) == 1, F.concat(F.lit("POLYGON "), whole)).when(
        shapes.isNotNull(),
        F.concat(F.lit("MULTIPOLYGON ("), whole, F.lit(")")),
    )


def _over_edges(ring: Column, term, zero=0.0) -> Column:
    """Sum over a ring's edges of term(p, q, first); points are taken relative to the first one by the caller."""
    steps = F.when(F.size(ring) >= 2, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.lit(zero), lambda a, i: a + term(F.get(ring, i), F.get(ring, i + 1), F.get(ring, F.lit(0))))


def signed_area(ring: Column) -> Column:
    """Above 0 for rings that run counter-clockwise."""
    return _over_edges(ring, lambda p, q, o: ((p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])) / 2)


def _first_and_holes(shape: Column, of) -> Column:
    return of(F.get(shape, F.lit(0))) - F.aggregate(F.slice(shape, 2, 1 << 20), F.lit(0.0), lambda a, r: a + of(r))


def area(shapes: Column) -> Column:
    """Outer rings less holes, whatever way the rings run."""
    return F.aggregate(shapes, F.lit(0.0), lambda a, s: a + _first_and_holes(s, lambda r: F.abs(signed_area(r))))


def perimeter(shapes: Column) -> Column:
    length = lambda r: _over_edges(
        r,
        lambda p, q, _: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])),
    )
    return F.aggregate(F.flatten(shapes), F.lit(0.0), lambda a, r: a + length(r))


def box(shapes: Column) -> dict[str, Column]:
    """minx, miny, maxx, maxy; null for no points."""
    points = F.flatten(F.flatten(shapes))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}


def centroid(shapes: Column) -> dict[str, Column]:
    """cx, cy of the area; null where the area is 0."""
    whole = area(shapes)

    def along(v: str) -> Column:
        def moment(p: Column, q: Column, o: Column) -> Column:
            return (p[v] - o[v] + q[v] - o[v]) * ((p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])) / 6

        def of_ring(r: Column) -> Column:
            return F.signum(signed_area(r)) * _over_edges(r, moment) + F.abs(signed_area(r)) * F.get(r, F.lit(0))[v]

        return F.try_divide(F.aggregate(shapes, F.lit(0.0), lambda a, s: a + _first_and_holes(s, of_ring)), F.when(whole != 0, whole))

    return {"cx": along("x"), "cy": along("y")}


def wrong_orientation(shapes: Column) -> Column:
    """Whether an outer ring runs clockwise or a hole counter-clockwise; false for null and empty geometries."""
    bad = lambda s: (signed_area(F.get(s, F.lit(0))) < 0) | F.exists(F.slice(s, 2, 1 << 20), lambda r: signed_area(r) > 0)
    return F.coalesce(F.exists(shapes, bad), F.lit(False))


def oriented(shapes: Column) -> Column:
    """Outer rings counter-clockwise, holes clockwise."""
    turn = lambda r, outer: F.when((signed_area(r) < 0) == F.lit(outer), F.reverse(r)).otherwise(r)
    return F.transform(shapes, lambda s: F.transform(s, lambda r, i: F.when(i == 0, turn(r, True)).otherwise(turn(r, False))))


# The WGS 84 ellipsoid, and UTM zone 36 north.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
ZONE_LON, SCALE, FALSE_EAST = 33.0, 0.9996, 500000.0


def utm(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres: transverse Mercator by Krueger's series in the third flattening, order 4."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    c = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - ZONE_LON)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - c * F.atanh(c * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EAST + SCALE * radius * east, SCALE * radius * north


def to_metres(shapes: Column) -> Column:
    """Degrees to metres, point by point."""
    def moved(p: Column) -> Column:
        x, y = utm(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(shapes, lambda s: F.transform(s, lambda r: F.transform(r, moved)))


def tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """x and y of the map tile that holds a point at a zoom."""
    n = float(1 << zoom)
    s = F.sin(F.radians(lat))
    x, y = (lon + 180) / 360 * n, (0.5 - F.log((1 + s) / (1 - s)) / (4 * math.pi)) * n
    last = F.lit(float((1 << zoom) - 1))
    return tuple(F.least(F.greatest(F.floor(v).cast("double"), F.lit(0.0)), last).cast("int") for v in (x, y))
