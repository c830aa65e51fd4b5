"""One height for each component, with its source and confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions.values import array_mean, array_weighted_mean, flag

_LISTS = {
    "B": {"b_height_values": "height_clean_final", "b_stairs_values": "stairs_clean", "b_afh_values": "avg_floor_height_clean", "b_area_values": "area"},
    "A": {"a_floor_min_values": "gkh_floor_count_min_clean", "a_floor_max_values": "gkh_floor_count_max_clean", "a_floor_mid_values": "gkh_floor_mid"},
}
_FIRSTS = {"district_comp": "district", "locality_comp": "locality", "purpose_comp": "purpose_of_building", "type_comp": "type"}


def _value(df: DataFrame, column: str, kind: str = "double"):
    return F.col(column).cast(kind) if column in df.columns else F.lit(None).cast(kind)


def _order(compat: bool):
    """A member's place in its component: by number, with compat by the number's text."""
    return F.col("row_idx").cast("string" if compat else "long").alias("__order")


def member_lists(components: DataFrame, members: DataFrame, a: DataFrame, b: DataFrame, compat: bool = False) -> DataFrame:
    """Adds the members' values as lists in the order of their numbers (compat: of the texts), without nulls, areas excepted.

    b_height_areas lists the areas of the members whose height is known, so that weights stay with their heights.
    """
    out = components
    for source, df in (("A", a), ("B", b)):
        rows = members.where(F.col("source") == source).select("label", "row_idx").join(
            df.select("row_idx", *[_value(df, c).alias(f"__{n}") for n, c in _LISTS[source].items()]),
            "row_idx",
        )
        lists = rows.groupBy("label").agg(F.sort_array(F.collect_list(F.struct(_order(compat), *[f"__{n}" for n in _LISTS[source]]))).alias("__m"))
        pick = lambda n: F.transform(F.col("__m"), lambda x: x[f"__{n}"])
        made = {n: pick(n) if n == "b_area_values" else F.filter(pick(n), lambda x: x.isNotNull()) for n in _LISTS[source]}
        if source == "B":
            known = F.filter(F.col("__m"), lambda x: x["__b_height_values"].isNotNull())
            made["b_height_areas"] = F.transform(known, lambda x: x["__b_area_values"])
        out = out.join(lists.select("label", *[v.alias(n) for n, v in made.items()]), "label", "left")
        out = out.withColumns({n: F.coalesce(n, F.array().cast("array<double>")) for n in made})
    return out


def baseline_features(components: DataFrame, members: DataFrame, a: DataFrame, b: DataFrame, compat: bool = False) -> DataFrame:
    """Adds means of the members' cleaned features and the first known text features, in the order of member_lists."""
    of_b = members.where("source = 'B'").select("label", "row_idx").join(
        b.select(
            "row_idx",
            _value(b, "stairs_clean").alias("s"),
            _value(b, "avg_floor_height_clean").alias("f"),
            *[_value(b, c, "string").alias(n) for n, c in _FIRSTS.items()],
        ),
        "row_idx",
    )
    first = [F.min(F.when(F.col(n).isNotNull(), F.struct(_order(compat), F.col(n).alias("v")))).getField("v").alias(n) for n in _FIRSTS]
    of_b = of_b.groupBy("label").agg(F.avg("s").alias("stairs_clean_component"), F.avg("f").alias("avg_floor_height_component"), *first)
    floors = {
        "a_floor_min_component": "gkh_floor_count_min_clean",
        "a_floor_max_component": "gkh_floor_count_max_clean",
        "a_floor_mid_component": "gkh_floor_mid",
    }
    of_a = members.where("source = 'A'").select("label", "row_idx").join(
        a.select("row_idx", *[_value(a, c).alias(n) for n, c in floors.items()]),
        "row_idx",
    ).groupBy("label").agg(*[F.avg(n).alias(n) for n in floors])
    return components.join(of_b, "label", "left").join(of_a, "label", "left")


def height_range(df: DataFrame, low: float = 2.8, high: float = 3.0) -> DataFrame:
    """Adds a_height_min and a_height_max from the register's floors; null unless both ends are known."""
    both = (F.size("a_floor_min_values") > 0) & (F.size("a_floor_max_values") > 0)
    return df.withColumns(
        {
            "a_height_min": F.when(both, F.array_min("a_floor_min_values") * low),
            "a_height_max": F.when(both, F.array_max("a_floor_max_values") * high),
        }
    )


def select_height(df: DataFrame, settings: config.Settings = config.Settings(), compat: bool = False) -> DataFrame:
    """Adds height_final, height_source, confidence_score, b_internal_ok, a_agree_with_b by the rule table.

    With compat the two outcomes that need a yes or no of the register never come about, and areas pair with heights
    by place even where a height is missing.
    """
    df = height_range(df, settings.floor_low, settings.floor_high)
    n = F.size("b_height_values")
    weighted = array_weighted_mean(F.col("b_height_values"), F.col("b_area_values" if compat else "b_height_areas"))
    df = df.withColumn("__h", F.when(n == 1, F.get("b_height_values", F.lit(0))).when(n > 1, weighted))
    expected = array_mean(F.col("b_stairs_values")) * array_mean(F.col("b_afh_values"))
    df = df.withColumns(
        {
            "__ok": F.when(n == 1, F.abs(F.col("__h") - expected) <= settings.tolerance),
            "__agree": F.col("__h").between(F.col("a_height_min"), F.col("a_height_max")),
        }
    )
    ok, agree, known = flag(F.col("__ok")), F.col("__agree"), F.col("a_height_min").isNotNull() & F.col("a_height_max").isNotNull()
    yes, no = (F.lit(False), F.lit(False)) if compat else (flag(agree), flag(~agree))
    rows = [
        ((n == 1) & ok & yes, "B_direct_high", 0.95),
        ((n == 1) & ok & agree.isNull(), "B_direct_high", 0.90),
        ((n == 1) & no, "B_conflict_with_A", 0.60),
        (n == 1, "B_direct_medium", 0.80),
        ((n > 1) & no, "B_weighted_conflict_with_A", 0.55),
        (n > 1, "B_weighted", 0.75),
        (known, "A_range_only", 0.45),
    ]
    source, confidence = F.lit("unknown"), F.lit(0.0)
    for when, name, score in reversed(rows):
        source, confidence = F.when(when, name).otherwise(source), F.when(when, score).otherwise(confidence)
    middle = F.when((n == 0) & known, (F.col("a_height_min") + F.col("a_height_max")) / 2)
    df = df.withColumns(
        {
            "height_final": F.coalesce("__h", middle),
            "height_source": source,
            "confidence_score": confidence,
            "b_internal_ok": F.col("__ok"),
            "a_agree_with_b": F.when(n > 0, agree),
        }
    )
    return df.drop("__h", "__ok", "__agree")


def pipeline_flags(df: DataFrame, confidence: float = 0.65) -> DataFrame:
    """Adds needs_ml, needs_visual_review, ready_for_use."""
    ml = (F.col("height_source") == "unknown") | F.col("height_final").isNull()
    conflict = F.col("height_source").isin("B_conflict_with_A", "B_weighted_conflict_with_A")
    df = df.withColumns({"needs_ml": ml, "needs_visual_review": flag(F.col("needs_review")) | conflict | (F.col("confidence_score") < confidence)})
    return df.withColumn("ready_for_use", F.col("height_final").isNotNull() & ~F.col("needs_ml") & ~F.col("needs_visual_review"))
