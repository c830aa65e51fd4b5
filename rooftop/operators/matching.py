"""Footprint pairs, components of matching footprints, and what is known about a component."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions import shapes, text
from rooftop.functions.values import flag, ratio
from rooftop.operators import graph, spatial, statistics
from rooftop.session import written


def rectangle(df: DataFrame) -> DataFrame:
    """Box columns, area and centroid of rows that have a rectangle x0, y0, w, h."""
    box = {"minx": F.col("x0"), "miny": F.col("y0"), "maxx": F.col("x0") + F.col("w"), "maxy": F.col("y0") + F.col("h")}
    return df.withColumns({**box, "area": F.col("w") * F.col("h"), "cx": F.col("x0") + F.col("w") / 2, "cy": F.col("y0") + F.col("h") / 2})


#: Footprints that one task joins at a time.
UNION_PARTS = 16
_BOX = ["minx", "miny", "maxx", "maxy"]


def candidates(a: DataFrame, b: DataFrame, cell: float = 64.0, carry: list[str] = ()) -> DataFrame:
    """idx_a, idx_b, boxes a_*, b_* and the carried columns with a suffix, of all pairs whose boxes touch."""
    side = lambda df, s: df.select(F.col("row_idx").alias(f"idx_{s}"), *_BOX, *[F.col(c).alias(f"{c}_{s}") for c in carry])
    return spatial.box_join(side(a, "a"), side(b, "b"), cell)


def box_overlap() -> Column:
    """Area that the boxes of a candidate share; the whole overlap where footprints are rectangles."""
    wide = F.least("a_maxx", "b_maxx") - F.greatest("a_minx", "b_minx")
    high = F.least("a_maxy", "b_maxy") - F.greatest("a_miny", "b_miny")
    return F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))


def pair_metrics(pairs: DataFrame, inter: Column) -> DataFrame:
    """idx_a, idx_b, inter_area, area_a, area_b, iou, overlap_a, overlap_b of pairs with a common area."""
    pairs = pairs.withColumn("inter_area", inter).where("inter_area > 0")
    i, a, b = F.col("inter_area"), F.col("area_a"), F.col("area_b")
    return pairs.select(
        "idx_a",
        "idx_b",
        "inter_area",
        "area_a",
        "area_b",
        ratio(i, a + b - i).alias("iou"),
        ratio(i, a).alias("overlap_a"),
        ratio(i, b).alias("overlap_b"),
    )


def strong_pairs(pairs: DataFrame, iou: float = 0.3, overlap: float = 0.8) -> DataFrame:
    """Pairs with a large enough share, and which of the three shares it is."""
    flags = {
        "strong_by_iou": flag(F.col("iou") >= iou),
        "strong_by_a": flag(F.col("overlap_a") >= overlap),
        "strong_by_b": flag(F.col("overlap_b") >= overlap),
    }
    return pairs.withColumns(flags).where("strong_by_iou or strong_by_a or strong_by_b")


def match_pairs(a: DataFrame, b: DataFrame, settings: config.Settings, polygons: bool = False) -> DataFrame:
    """Pairs of footprints with their shares: by boxes for rectangles, by WKT polygons (geom_wkt) otherwise."""
    carry = ["area", *(["geom_wkt"] if polygons else [])]
    return pair_metrics(candidates(a, b, settings.grid_cell, carry), polygon_overlap() if polygons else box_overlap())


def _fills_box(s: str) -> Column:
    box = (F.col(f"{s}_maxx") - F.col(f"{s}_minx")) * (F.col(f"{s}_maxy") - F.col(f"{s}_miny"))
    return F.coalesce(F.abs(F.col(f"area_{s}") - box) <= 1e-12 * box, F.lit(False))


def polygon_overlap() -> Column:
    """Area that the polygons of a candidate share. Where both fill their boxes no polygon is read."""
    plain = _fills_box("a") & _fills_box("b")
    read = shapes.overlap_area(*[F.when(~plain, F.col(f"geom_wkt_{s}")) for s in "ab"])
    return F.when(plain, box_overlap()).otherwise(read)


def membership(a: DataFrame, b: DataFrame, strong: DataFrame) -> DataFrame:
    """source, row_idx, label: the component of every row of both sources; rows without a strong pair stand alone.

    Nodes are 2 * row_idx for the register and 2 * row_idx + 1 for the survey.
    """
    labels = graph.connected_components(strong.select((F.col("idx_a") * 2).alias("u"), (F.col("idx_b") * 2 + 1).alias("v")))
    nodes = a.select(F.lit("A").alias("source"), "row_idx", (F.col("row_idx") * 2).alias("node")).unionByName(
        b.select(F.lit("B").alias("source"), "row_idx", (F.col("row_idx") * 2 + 1).alias("node"))
    )
    return nodes.join(labels, nodes["node"] == labels["v"], "left").select("source", "row_idx", F.coalesce("label", "node").alias("label"))


def ordered(numbers: Column, compat: bool = False) -> Column:
    """An array of numbers in their order, with compat in that of their texts."""
    if not compat:
        return F.sort_array(numbers)
    return F.transform(F.sort_array(F.transform(numbers, lambda x: x.cast("string"))), lambda x: x.cast("long"))


def match_type(n_a: Column, n_b: Column) -> Column:
    return (
        F.when((n_a > 0) & (n_b == 0), "A_only").when((n_a == 0) & (n_b > 0), "B_only").when((n_a == 1) & (n_b == 1), "1:1")
        .when((n_a == 1) & (n_b > 1), "1:N").when((n_a > 1) & (n_b == 1), "N:1").when((n_a > 1) & (n_b > 1), "N:N").otherwise("unknown")
    )


def component_table(members: DataFrame, compat: bool = False) -> DataFrame:
    """component_id, label, a_idxs, b_idxs, n_a, n_b, match_type. Ids run over components of the register first.

    Members are listed by number, with compat in the order of the numbers' texts; an id is the place of a component's
    least register row, or after all of these its least survey row.
    """
    of = lambda s: ordered(F.collect_list(F.when(F.col("source") == s, F.col("row_idx"))), compat)
    table = members.groupBy("label").agg(of("A").alias("a_idxs"), of("B").alias("b_idxs"))
    table = table.withColumns({"n_a": F.size("a_idxs"), "n_b": F.size("b_idxs")})
    some = table.withColumn(
        "__key",
        F.when(F.col("n_a") > 0, F.array_min("a_idxs")).otherwise(F.array_min("b_idxs")),
    ).withColumn("__only_b", F.col("n_a") == 0)
    with_a, only_b = statistics.numbered(
        some.where("not __only_b"),
        "__key",
        "component_id",
    ), statistics.numbered(some.where("__only_b"), "__key", "component_id")
    first = with_a.agg(F.count(F.lit(1)).alias("__first"))
    only_b = only_b.crossJoin(F.broadcast(first)).withColumn("component_id", F.col("component_id") + F.col("__first")).drop("__first")
    both = with_a.unionByName(only_b)
    return both.select("component_id", "label", "a_idxs", "b_idxs", "n_a", "n_b", match_type(F.col("n_a"), F.col("n_b")).alias("match_type"))


def component_metrics(components: DataFrame, members: DataFrame, strong: DataFrame) -> DataFrame:
    """Adds max_iou, mean_iou, max_overlap_a, max_overlap_b; null for components without a pair."""
    a = members.where("source = 'A'").select(F.col("row_idx").alias("idx_a"), "label")
    sums = strong.join(a, "idx_a").groupBy("label").agg(
        F.max("iou").alias("max_iou"),
        F.avg("iou").alias("mean_iou"),
        F.max("overlap_a").alias("max_overlap_a"),
        F.max("overlap_b").alias("max_overlap_b"),
    )
    return components.join(sums, "label", "left")


def address_features(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adds address_a_norm and house_a to the register, street_b and house_b to the survey; '' where a column is missing."""
    address = next((F.col(c) for c in ("gkh_address", "address") if c in a.columns), F.lit(None))
    of = lambda c: F.col(c) if c in b.columns else F.lit(None)
    a = a.withColumns({"address_a_norm": text.norm_text(address), "house_a": text.house_number(address)})
    return a, b.withColumns({"street_b": text.norm_text(of("name_street")), "house_b": text.norm_text(of("number"))})


def address_validation(components: DataFrame, members: DataFrame, a: DataFrame, b: DataFrame, compat: bool = False) -> DataFrame:
    """Adds address_match_strong, address_match_weak, address_conflict from the house numbers of a component's rows.

    Numbers in common match; numbers on both sides but none in common conflict. A missing number is no number; with
    compat it is the number ''.
    """
    house = a.select(F.lit("A").alias("source"), "row_idx", F.col("house_a").alias("house")).unionByName(
        b.select(F.lit("B").alias("source"), "row_idx", F.col("house_b").alias("house"))
    )
    house = house if compat else house.where("house <> ''")
    of = lambda s: F.collect_set(F.when(F.col("source") == s, F.col("house")))
    sets = members.join(house, ["source", "row_idx"]).groupBy("label").agg(of("A").alias("__a"), of("B").alias("__b"))
    out = components.join(sets, "label", "left")
    known, common = flag((F.size("__a") > 0) & (F.size("__b") > 0)), flag(F.arrays_overlap("__a", "__b"))
    return out.withColumns(
        {"address_match_strong": known & common, "address_match_weak": known & common, "address_conflict": known & ~common}
    ).drop("__a", "__b")


def review_flags(components: DataFrame, iou: float = 0.4) -> DataFrame:
    """Adds needs_review: conflicting addresses, a weak best share, or more than one row on a side."""
    many = F.col("match_type").isin("1:N", "N:1", "N:N")
    return components.withColumn("needs_review", flag(F.col("address_conflict")) | flag(F.col("max_iou") < iou) | many)


def component_geometry(components: DataFrame, members: DataFrame, a: DataFrame, b: DataFrame, column: str = "geom_wkt") -> DataFrame:
    """Adds column, WKT: the union of a component's survey footprints, or of its register footprints if it has none."""
    of = lambda df, s: df.select(F.lit(s).alias("source"), "row_idx", F.col(column).alias("wkt"))
    parts = members.join(of(a, "A").unionByName(of(b, "B")), ["source", "row_idx"]).where("wkt is not null")
    chosen = F.max("source").over(Window.partitionBy("label"))  # B where there is one
    parts = parts.withColumn("__s", chosen).where("source = __s")
    number = F.row_number().over(Window.partitionBy("label").orderBy("row_idx")) - 1
    parts, most = parts.select("label", number.alias("n"), "wkt"), UNION_PARTS
    while True:  # unions of a few, then unions of these: no row holds a whole large component
        lists = parts.groupBy("label", F.floor(F.col("n") / most).alias("n")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("n").alias("o"), "wkt"))).alias("g")
        )
        texts = F.transform("g", lambda x: x["wkt"])
        parts = written(
            lists.select(
                "label",
                "n",
                F.when(F.size("g") == 1, F.get(texts, F.lit(0))).otherwise(shapes.union_of(F.when(F.size("g") > 1, texts))).alias("wkt"),
            ),
            "unions",
        )
        if parts.where("n > 0").isEmpty():
            return components.join(parts.select("label", F.col("wkt").alias(column)), "label", "left")
