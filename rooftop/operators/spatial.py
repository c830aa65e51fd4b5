"""Spatial joins on grids: boxes that touch, points within a radius, nearest points; and local autocorrelation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions.values import flag
from rooftop.operators.statistics import numbered
from rooftop.session import scratch_path, written

#: Rows whose z a task holds at a time, numbers it draws at a time, and rows it rates at a time.
BLOCK, DRAWS, SLICE = 1 << 22, 1 << 22, 1000
#: Queries that are still open, counted before, are broadcast with their nine cells if they are at most so many.
MOST_OPEN = 20_000


def _cells(low: Column, high: Column, size: Column) -> Column:
    return F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))


def _shuffled(df: DataFrame) -> DataFrame:
    """A side that is never broadcast by its estimated size, which counts a file's compressed bytes and no copies to cells."""
    return df.hint("merge")


def _leveled(df: DataFrame, s: str, size: float) -> DataFrame:
    """Rows with a box, and the level of the grid whose cells are as wide as the box: 0 up to size, one more for each doubling."""
    wide = F.greatest(F.col(f"{s}_maxx") - F.col(f"{s}_minx"), F.col(f"{s}_maxy") - F.col(f"{s}_miny"), F.lit(size))
    return df.where(F.col(f"{s}_minx").isNotNull()).withColumn(f"{s}_level", F.ceil(F.log2(wide / size)).cast("int"))


def box_join(a: DataFrame, b: DataFrame, size: float = 64.0) -> DataFrame:
    """Rows of a and b whose boxes touch. Both need minx, miny, maxx, maxy and no other column in common.

    Boxes go to all grid cells that they touch; an equi-join on the cell finds the pairs, and a pair counts only in
    the cell of its boxes' common lower corner, so no distinct follows. Cells double in width from level to level: a pair
    meets on the level of its larger box, so that a box is in four cells at most of each level that the other side
    has, however large it is. Rows with null boxes join nothing.
    """
    box = ("minx", "miny", "maxx", "maxy")
    a, b = (_leveled(df.withColumnsRenamed({c: f"{s}_{c}" for c in box}), s, size) for df, s in ((a, "a"), (b, "b")))
    # A few dozen levels at most, since each doubles the width.
    levels_a, levels_b = (sorted(r[0] for r in df.select(f"{s}_level").distinct().collect()) for df, s in ((a, "a"), (b, "b")))

    def celled(df: DataFrame, s: str, others: list[int]) -> DataFrame:
        own = F.col(f"{s}_level")
        larger = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda n: n > own)
        df = df.withColumn(f"{s}_at", F.explode(F.concat(F.array(own), larger)))
        width = F.pow(F.lit(2.0), F.col(f"{s}_at")) * size
        df = df.withColumn(f"{s}_gx", _cells(F.col(f"{s}_minx"), F.col(f"{s}_maxx"), width))
        return df.withColumn(f"{s}_gy", _cells(F.col(f"{s}_miny"), F.col(f"{s}_maxy"), width))

    for_a, for_b = celled(a, "a", levels_b), celled(b, "b", levels_a)
    x, y, width = F.greatest("a_minx", "b_minx"), F.greatest("a_miny", "b_miny"), F.pow(F.lit(2.0), F.col("a_at")) * size
    touch = (x <= F.least("a_maxx", "b_maxx")) & (y <= F.least("a_maxy", "b_maxy"))
    once = (F.col("a_gx") == F.floor(x / width)) & (F.col("a_gy") == F.floor(y / width))
    same = (F.col("a_at") == F.col("b_at")) & (F.col("a_gx") == F.col("b_gx")) & (F.col("a_gy") == F.col("b_gy"))
    found = for_a.join(for_b, same & (F.col("a_at") == F.greatest("a_level", "b_level")) & touch & once)
    return found.drop(*[f"{s}_{c}" for s in "ab" for c in ("level", "at", "gx", "gy")])


def radius_pairs(points: DataFrame, radius: float, payload: list[str] = ()) -> DataFrame:
    """id, other, d2 and the other's payload for points (row_idx, cx, cy) within radius; a point isn't its own neighbour.

    Cells are as wide as the radius; one side is copied to the nine cells around it.
    """
    cell = [F.floor(F.col(c) / radius) for c in ("cx", "cy")]
    here = points.where("cx is not null and cy is not null").select(
        F.col("row_idx").alias("id"),
        F.col("cx").alias("x"),
        F.col("cy").alias("y"),
        cell[0].alias("gx"),
        cell[1].alias("gy"),
    )
    near = points.where("cx is not null and cy is not null").select(
        F.col("row_idx").alias("other"),
        F.col("cx").alias("ox"),
        F.col("cy").alias("oy"),
        *[F.col(p).alias(f"other_{p}") for p in payload],
        cell[0].alias("hx"),
        cell[1].alias("hy"),
    )
    near = near.select(
        "*",
        F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)])).alias("i"),
    ).select("*", F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)])).alias("j"))
    near = near.withColumns({"hx": F.col("hx") + F.col("i"), "hy": F.col("hy") + F.col("j")}).drop("i", "j")
    d2 = (F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy"))
    found = here.join(_shuffled(near), (F.col("gx") == F.col("hx")) & (F.col("gy") == F.col("hy")) & (F.col("id") != F.col("other")) & (d2 <= radius * radius))
    return found.select("id", "other", d2.alias("d2"), *[f"other_{p}" for p in payload])


def radius_sums(points: DataFrame, radius: float, value: str | None = None) -> DataFrame:
    """row_idx, n, s of points with a place: the neighbours within radius and the sum of their values, 0 for none.

    Points of one place are one row with their count and sum when neighbours are paired, so a place with many points
    costs no more than another.
    """
    here = points.where("cx is not null and cy is not null")
    here = here.select("row_idx", "cx", "cy", F.coalesce(value, F.lit(0.0)).alias("v") if value else F.lit(0.0).alias("v"))
    places = here.groupBy("cx", "cy").agg(F.min("row_idx").alias("row_idx"), F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    places = written(places, "places")
    sums = radius_pairs(places, radius, ["n", "s"]).groupBy(F.col("id").alias("row_idx")).agg(F.sum("other_n").alias("on"), F.sum("other_s").alias("os"))
    sums = places.join(sums, "row_idx", "left").drop("row_idx")
    n, s = F.col("n") - 1 + F.coalesce("on", F.lit(0)), F.col("s") - F.col("v") + F.coalesce("os", F.lit(0.0))
    return here.join(sums, ["cx", "cy"]).select("row_idx", n.alias("n"), s.alias("s"))


def neighbour_sums(points: DataFrame, radius: float, area: str = "footprint_area_m2") -> DataFrame:
    """Adds the number of neighbours within radius and the sum of their areas, 0 for none."""
    sums = radius_sums(points, radius, area).select("row_idx", F.col("n").alias("__n"), F.col("s").alias("__s"))
    out = points.join(sums, "row_idx", "left")
    known = {"neighbors_250m": F.coalesce("__n", F.lit(0)), "neighbor_footprint_sum_250m": F.coalesce("__s", F.lit(0.0))}
    return out.withColumns(known).drop("__n", "__s")


def with_islands(points: DataFrame, radius: float) -> DataFrame:
    """Adds is_island: no other point within radius."""
    linked = radius_sums(points, radius).where("n > 0").select("row_idx", F.lit(True).alias("__near"))
    return points.join(linked, "row_idx", "left").withColumn("is_island", F.col("__near").isNull()).drop("__near")


def local_moran(points: DataFrame, radius: float) -> DataFrame:
    """row_idx, z, k, lag, lisa_I, lisa_quad of rows with a height_z that aren't islands; weights are of that subset.

    z is centred on the subset; I = (n - 1) z lag / sum of z squared; quadrants are 1 HH, 2 LH, 3 LL, 4 HL. A row
    whose neighbours all lack a z has no lag, I or quadrant.
    """
    subset = points.where(~F.col("is_island") & F.col("height_z").isNotNull()).select("row_idx", "cx", "cy", "height_z")
    mean = subset.agg(F.avg("height_z").alias("mean"))
    subset = subset.crossJoin(F.broadcast(mean)).select("row_idx", "cx", "cy", (F.col("height_z") - F.col("mean")).alias("z"))
    subset = written(subset, "moran")
    scale = subset.agg(F.sum(F.col("z") * F.col("z")).alias("ss"), F.count(F.lit(1)).alias("n"))
    lags = radius_sums(subset, radius, "z").where("n > 0").select("row_idx", F.col("n").alias("k"), (F.col("s") / F.col("n")).alias("lag"))
    out = subset.select("row_idx", "z").join(lags, "row_idx", "left").crossJoin(F.broadcast(scale))
    i = F.try_divide((F.col("n") - 1) * F.col("z") * F.col("lag"), F.col("ss"))
    high, above = F.col("z") > 0, F.col("lag") > 0
    quad = F.when(high & above, 1).when(~high & above, 2).when(~high & ~above, 3).when(high & ~above, 4)
    return out.select(
        "row_idx",
        "z",
        F.coalesce("k", F.lit(0)).alias("k"),
        "lag",
        i.alias("lisa_I"),
        F.when(F.col("lag").isNotNull(), quad).alias("lisa_quad"),
    )


def _picks(rng: np.random.Generator, permutations: int, k: int, m: int) -> Iterator[np.ndarray]:
    """Neighbourhoods: in each row k distinct numbers below m; at most about DRAWS numbers at a time."""
    dense = k * 4 > m
    part = max(1, DRAWS // (m if dense else k))
    for n in [part] * (permutations // part) + [permutations % part] * (permutations % part > 0):
        picks = np.sort(rng.integers(0, m, (n, k)), axis=1)
        if dense:
            yield np.argsort(rng.random((n, m)), axis=1)[:, :k]
            continue
        while (again := np.diff(picks, axis=1, prepend=-1) == 0).any():  # draw again what came twice, until nothing does
            picks[again] = rng.integers(0, m, int(again.sum()))
            picks.sort(axis=1)
        yield picks


def permutation_p(moran: DataFrame, permutations: int = 999, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """Adds lisa_p: the share of random neighbourhoods as extreme as the lag, a generator seeded by each row's id.

    Neighbourhoods are drawn without replacement from all other rows' z. Rows are numbered by id and their z written
    to the shared folder in blocks; a task holds one block at a time and repeats its rows' draws for each, so its
    memory is bounded at every size.
    """
    placed = written(numbered(moran, "row_idx", "__place"), "placed")
    total, at = placed.count(), scratch_path(moran.sparkSession, "z")
    placed.select("__place", "z", F.floor(F.col("__place") / block).alias("block")).repartition("block").write.partitionBy("block").parquet(at)

    def values(low: int) -> np.ndarray:
        files, root = fs.FileSystem.from_uri(at if "://" in at or at.startswith("file:") else f"file://{at}")
        part = pq.read_table(f"{root}/block={low // block}", columns=["__place", "z"], filesystem=files, partitioning=None)
        z = np.empty(len(part))
        z[part.column("__place").to_numpy() - low] = part.column("z").to_numpy()
        return z

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for whole in batches:
            for start in range(0, len(whole), SLICE):
                rows = whole.iloc[start : start + SLICE]
                sums = np.zeros((len(rows), permutations))
                for low in range(0, total, block):
                    if held is None or total > block:
                        held = values(low)
                    for i, r in enumerate(rows.itertuples(index=False, name=None)):
                        r = dict(zip(rows.columns, r, strict=True))
                        if not r["k"]:
                            continue
                        rng, done = np.random.default_rng([seed, int(r["row_idx"])]), 0
                        for picks in _picks(rng, permutations, int(r["k"]), total - 1):
                            picks += picks >= r["__place"]  # the others without the row itself
                            if total > block:
                                inside = (picks >= low) & (picks < low + len(held))
                                sums[i, done : done + len(picks)] += np.where(inside, held[np.where(inside, picks - low, 0)], 0.0).sum(axis=1)
                            else:
                                sums[i, done : done + len(picks)] = held[picks].sum(axis=1)
                            done += len(picks)
                k, z, lag = (rows[c].to_numpy(dtype="float64") for c in ("k", "z", "lag"))
                with np.errstate(invalid="ignore", divide="ignore"):
                    larger = (z[:, None] * (sums / k[:, None]) >= (z * lag)[:, None]).sum(axis=1)
                p = (np.minimum(larger, permutations - larger) + 1) / (permutations + 1)
                yield rows.assign(lisa_p=np.where(k > 0, p, np.nan))

    schema = placed.schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", lisa_p double"
    return placed.mapInPandas(draw, schema).withColumn("lisa_p", F.nanvl("lisa_p", F.lit(None))).drop("__place")


def with_lisa(points: DataFrame, settings: config.Settings) -> DataFrame:
    """Adds is_island, lisa_I, lisa_p, lisa_quad and lisa_flag: a high value among low ones, p below the limit."""
    points = written(with_islands(written(points, "points"), settings.lisa_radius), "islands")
    rated = permutation_p(written(local_moran(points, settings.lisa_radius), "lags"), settings.permutations, settings.seed)
    out = points.join(rated.select("row_idx", "lisa_I", "lisa_p", "lisa_quad"), "row_idx", "left")
    return out.withColumn("lisa_flag", flag((F.col("lisa_p") < settings.lisa_p) & (F.col("lisa_quad") == 4)))


def _apart(low: Column, high: Column, at: Column) -> Column:
    """Distance along an axis from a point to a stretch, 0 within it."""
    return F.greatest(low - at, at - high, F.lit(0.0))


def _far(low: Column, high: Column, at: Column) -> Column:
    """Distance along an axis from a point to the farther end of a stretch."""
    return F.greatest(F.abs(low - at), F.abs(high - at))


def _around(points: DataFrame, width: float) -> DataFrame:
    """Copies each query to the nine cells (gx, gy) around it."""
    offsets = F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))
    cells = points.withColumns({"gx": F.floor(F.col("query_x") / width), "gy": F.floor(F.col("query_y") / width)})
    cells = cells.select("*", offsets.alias("i")).select("*", offsets.alias("j"))
    return cells.withColumns({"gx": F.col("gx") + F.col("i"), "gy": F.col("gy") + F.col("j")}).drop("i", "j")


def _pooled(pool: DataFrame, width: float) -> DataFrame:
    return pool.withColumns({"gx": F.floor(F.col("train_x") / width), "gy": F.floor(F.col("train_y") / width)})


def _far_pairs(around: DataFrame, pool: DataFrame, width: float, want: Column, by: list[str]) -> DataFrame:
    """Pairs of queries and points that can be among the nearest, of the points in the nine cells around a query.

    A cell is parted in 64, and only parts with points are there, with the box of theirs. A query's parts are taken
    by the distance of their farthest corner until they hold enough points: that distance bounds the search, and only
    parts whose box begins within it are opened.
    """
    part = width / 8
    parts = pool.withColumns({"px": F.floor(F.col("train_x") / part), "py": F.floor(F.col("train_y") / part)})
    boxes = parts.groupBy("px", "py", *by).agg(
        F.count(F.lit(1)).alias("n"),
        *[f(f"train_{c}").alias(f"{f.__name__}_{c}") for c in "xy" for f in (F.min, F.max)],
    )
    boxes = boxes.withColumns({"gx": F.floor(F.col("px") / 8), "gy": F.floor(F.col("py") / 8)})
    side = lambda f: [f(F.col(f"min_{c}"), F.col(f"max_{c}"), F.col(f"query_{c}")) for c in "xy"]
    dx, dy = side(_apart)
    ex, ey = side(_far)
    seen = around.join(_shuffled(boxes), ["gx", "gy", *by]).withColumns({"low": F.sqrt(dx * dx + dy * dy), "high": F.sqrt(ex * ex + ey * ey)})
    upto = F.sum("n").over(Window.partitionBy("query_idx").orderBy("high", "px", "py"))
    bound = F.min(F.when(F.col("upto") >= want, F.col("high"))).over(Window.partitionBy("query_idx"))
    seen = seen.withColumn("upto", upto).withColumn("bound", bound).where(F.col("bound").isNull() | (F.col("low") <= F.col("bound")))
    return seen.select("query_idx", "query_x", "query_y", "px", "py", *by).join(_shuffled(parts), ["px", "py", *by])


def nearest(queries: DataFrame, train: DataFrame, k: int, cell: float, target: str = "height_final", exclude_self: bool = False, by: str | None = None) -> DataFrame:
    """row_idx, train_idx, d, y, place of the k nearest training points of each query (row_idx, cx, cy), ties by id.

    With `by`, a column of few values that both have, only points of a query's own value are searched.

    The nine cells around a query hold all points within a cell's width: if its k nearest there are within it, they
    are certain. Such queries leave; the others go on with cells four times as wide, of which only the occupied parts
    that matter are opened. Rounds are written, and end when no query is left. Cells are at most `cell` wide at first,
    less where points are dense. All k nearest are exact.
    """
    planes = [by] if by else []
    point = lambda df, s: df.where("cx is not null and cy is not null").select(
        F.col("row_idx").alias(f"{s}_idx"),
        F.col("cx").alias(f"{s}_x"),
        F.col("cy").alias(f"{s}_y"),
        *planes,
        *([F.col(target).alias("y")] if s == "train" else []),
    )
    left, pool = written(point(queries, "query"), "queries"), written(point(train, "train"), "pool")
    sizes = pool.groupBy(*planes).agg(
        F.count(F.lit(1)).alias("n"),
        (F.max("train_x") - F.min("train_x")).alias("w"),
        (F.max("train_y") - F.min("train_y")).alias("h"),
    ).collect()
    at, done = max(sizes, key=lambda r: r.n, default=None), None
    wants = {r[by] if by else None: min(k, max(0, r.n - exclude_self)) for r in sizes}
    want = F.coalesce(*[F.when(F.col(by) == v, n) for v, n in wants.items()], F.lit(0)) if by and wants else F.lit(wants.get(None, 0))
    empty = left.select(
        F.col("query_idx").alias("row_idx"),
        F.lit(0).cast("long").alias("train_idx"),
        F.lit(0.0).alias("d"),
        F.lit(0.0).alias("y"),
        F.lit(1).alias("place"),
    ).limit(0)
    if not any(wants.values()):
        return empty
    left = left.where(want > 0)
    # Of points at one place only the first by id can be among the nearest.
    first = F.row_number().over(Window.partitionBy("train_x", "train_y", *planes).orderBy("train_idx"))
    pool = written(pool.withColumn("__n", first).where(F.col("__n") <= want + int(exclude_self)).drop("__n"), "pool")
    width = min(cell, max(cell / 64, math.sqrt(max(at.w, 1.0) * max(at.h, 1.0) * max(wants.values()) / at.n)))
    first = True
    while n := left.count():
        around = _around(left, width)
        around = F.broadcast(around) if n <= MOST_OPEN else around
        pairs = around.join(_shuffled(_pooled(pool, width)), ["gx", "gy", *planes]) if first else _far_pairs(around, pool, width, want + int(exclude_self), planes)
        dx, dy = F.col("query_x") - F.col("train_x"), F.col("query_y") - F.col("train_y")
        pairs = pairs.where(F.col("query_idx") != F.col("train_idx")) if exclude_self else pairs
        place = F.row_number().over(Window.partitionBy("query_idx").orderBy("d", "train_idx"))
        found = pairs.select(
            "query_idx",
            "train_idx",
            F.sqrt(dx * dx + dy * dy).alias("d"),
            "y",
            *planes,
        ).withColumn("place", place).where(F.col("place") <= want)
        last = F.max(F.when(F.col("place") == want, F.col("d"))).over(Window.partitionBy("query_idx"))
        sure = written(
            found.withColumn("last", last).where(F.col("last") <= width).select(F.col("query_idx").alias("row_idx"), "train_idx", "d", "y", "place"),
            "nearest",
        )
        done = sure if done is None else done.unionByName(sure)
        settled = sure.where("place = 1").select(F.col("row_idx").alias("query_idx"))
        left = written(left.join(_shuffled(settled), "query_idx", "left_anti"), "queries")
        width, first = width * 4, False
    return empty if done is None else done
