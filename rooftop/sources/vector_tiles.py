"""Vector tiles: polygons of a layer clipped to map tiles and encoded as Mapbox vector tiles (version 2), a row a tile."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.functions import geometry, shapes

# The format's numbers, and the layer's name and zooms.
EXTENT, VERSION, POLYGON = 4096, 2, 3
MOVE, LINE, CLOSE = 1, 2, 7
LAYER, ZOOMS = "buildings", range(10, 17)
#: Units around a tile that are kept, so that outlines don't show at its sides.
BUFFER = 64


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def _packed(number: int, values: list[int]) -> bytes:
    return _field(number, b"".join(map(_varint, values)))


def _zigzag(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def _value(v) -> bytes:
    if isinstance(v, bool):
        return _number(7, int(v))
    if isinstance(v, int):
        return _number(6, _zigzag(v))
    if isinstance(v, float):
        return _varint(3 << 3 | 1) + struct.pack("<d", v)
    return _field(1, str(v).encode())


def _clipped(ring: shapes.Ring, low: float, high: float) -> shapes.Ring:
    """The part of an open ring within a square, side by side."""
    for axis, limit, sign in ((0, low, 1), (0, high, -1), (1, low, 1), (1, high, -1)):
        out = []
        for p, q in zip([*ring[-1:], *ring], ring, strict=False):
            a, b = (p[axis] - limit) * sign, (q[axis] - limit) * sign
            if (a < 0) != (b < 0):
                t = a / (a - b)
                out.append(tuple(limit if i == axis else p[i] + (q[i] - p[i]) * t for i in (0, 1)))
            if b >= 0:
                out.append(q)
        ring = out
    return ring


def placed(polygons: list[shapes.Polygon], z: int, x: int, y: int) -> list[list[list[tuple[int, int]]]]:
    """Polygons of degrees in the units of a tile, y downwards, clipped; rings without an area are left out."""
    n = float(1 << z)

    def unit(p: tuple[float, float]) -> tuple[float, float]:
        s = math.sin(math.radians(p[1]))
        return ((p[0] + 180) / 360 * n - x) * EXTENT, ((0.5 - math.log((1 + s) / (1 - s)) / (4 * math.pi)) * n - y) * EXTENT

    out = []
    for polygon in polygons:
        rings = []
        for i, ring in enumerate(polygon):
            points = [(round(a), round(b)) for a, b in _clipped([unit(p) for p in ring[:-1]], -BUFFER, EXTENT + BUFFER)]
            points = [p for k, p in enumerate(points) if p != points[k - 1]] if len(points) > 1 else []
            area = shapes.ring_area([*points, points[0]]) if len(points) > 2 else 0
            if not area and not i:
                break
            if area:
                rings.append(points if (area > 0) == (i == 0) else points[::-1])
        if rings:
            out.append(rings)
    return out


def _commands(polygons: list) -> list[int]:
    out, at = [], (0, 0)
    for ring in (r for p in polygons for r in p):
        for k, p in enumerate(ring):
            if k < 2:
                out.append((MOVE if k == 0 else LINE) | (1 if k == 0 else len(ring) - 1) << 3)
            out += [_zigzag(p[0] - at[0]), _zigzag(p[1] - at[1])]
            at = p
        out.append(CLOSE | 1 << 3)
    return out


def encode(features: list[tuple[dict, list]], name: str = LAYER) -> bytes:
    """A tile of one layer from (properties, polygons in units); nulls among the properties are left out."""
    keys: dict[str, int] = {}
    values: dict[tuple, int] = {}
    body = b""
    for number, (properties, polygons) in enumerate(features, 1):
        tags = []
        for k, v in properties.items():
            if v is not None and v == v:
                tags += [keys.setdefault(k, len(keys)), values.setdefault((type(v), v), len(values))]
        body += _field(2, _number(1, number) + _packed(2, tags) + _number(3, POLYGON) + _packed(4, _commands(polygons)))
    body = _field(1, name.encode()) + body + b"".join(_field(3, k.encode()) for k in keys) + b"".join(_field(4, _value(v)) for _, v in values)
    return _field(3, body + _number(5, EXTENT) + _number(15, VERSION))


def _read(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    at = 0
    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = 8 if key & 7 == 1 else 4 if key & 7 == 5 else varint()
        yield key >> 3, data[at : at + size]
        at += size


def _numbers(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for b in data:
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append(n)
            n = shift = 0
    return out


def decode(data: bytes) -> list[tuple[dict, list]]:
    """(properties, rings in units) of the features of a tile that encode made."""
    signed = lambda n: n >> 1 if n % 2 == 0 else -(n + 1 >> 1)
    out = []
    for _, layer in (f for f in _read(data) if f[0] == 3):
        fields = list(_read(layer))
        keys = [b.decode() for k, b in fields if k == 3]
        values = []
        for _, body in (f for f in fields if f[0] == 4):
            kind, v = next(_read(body))
            values.append(v.decode() if kind == 1 else struct.unpack("<d", v)[0] if kind == 3 else signed(v) if kind == 6 else bool(v))
        for _, body in (f for f in fields if f[0] == 2):
            feature = dict(_read(body))
            tags, steps = _numbers(feature[2]), iter(_numbers(feature[4]))
            rings, at = [], (0, 0)
            for command in steps:
                if command & 7 == CLOSE:
                    continue
                for _ in range(command >> 3):
                    at = (at[0] + signed(next(steps)), at[1] + signed(next(steps)))
                    rings.append([at]) if command & 7 == MOVE else rings[-1].append(at)
            out.append(({keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2], strict=True)}, rings))
    return out


def vector_tiles(layer: DataFrame, zooms: range = ZOOMS) -> DataFrame:
    """z, x, y, features, tile: the encoded tile of all polygons (WKT in degrees) whose boxes touch it.

    The other columns become properties. Null and empty geometries are in no tile; a polygon without an area in the
    units of a tile isn't in that one, and a tile without polygons gives no row. A tile is one value, so one task
    makes it; tiles are dealt by key.
    """
    names = [c for c in layer.columns if c != "geometry"]
    box = geometry.box(geometry.parse_wkt(F.col("geometry")))
    rows = layer.select(F.struct(*names).alias("properties"), "geometry", *[v.alias(f"__{k}") for k, v in box.items()])
    rows = rows.where("__minx is not null").select("*", F.explode(F.array(*map(F.lit, zooms))).alias("z"))
    low, high = [], []
    for z in zooms:
        a, b = geometry.tile(F.col("__minx"), F.col("__maxy"), z), geometry.tile(F.col("__maxx"), F.col("__miny"), z)
        low.append((z, a))
        high.append((z, b))
    pick = lambda ends, i: F.coalesce(*[F.when(F.col("z") == z, c[i]) for z, c in ends])
    rows = rows.withColumns({f"__{n}{s}": pick(ends, i) for i, n in enumerate("xy") for s, ends in (("0", low), ("1", high))})
    rows = rows.withColumn("x", F.explode(F.sequence("__x0", "__x1"))).withColumn("y", F.explode(F.sequence("__y0", "__y1")))

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        z, x, y = (int(rows[c].iloc[0]) for c in "zxy")
        rows = rows.sort_values("order")
        features = [(p, made) for p, g in zip(rows["properties"], rows["geometry"], strict=True) if (made := placed(shapes._polygons(g), z, x, y))]
        return pd.DataFrame([(z, x, y, len(features), encode(features))] if features else [], columns=["z", "x", "y", "features", "tile"])

    keyed = rows.select("z", "x", "y", "properties", "geometry", F.xxhash64("properties", "geometry").alias("order"))
    return keyed.groupBy("z", "x", "y").applyInPandas(make, "z int, x int, y int, features long, tile binary")


def save_vector_tiles(layer: DataFrame, path: str, zooms: range = ZOOMS) -> None:
    """A Parquet table of tiles, a folder a zoom, sorted by x and y."""
    vector_tiles(layer, zooms).repartitionByRange("z", "x", "y").sortWithinPartitions("z", "x", "y").write.mode("overwrite").partitionBy("z").parquet(path)


def read_vector_tile(spark: SparkSession, path: str, z: int, x: int, y: int) -> bytes | None:
    """The encoded tile, None where there is none; only its row group is read."""
    row = spark.read.parquet(path).where((F.col("z") == z) & (F.col("x") == x) & (F.col("y") == y)).select("tile").first()
    return bytes(row.tile) if row else None
