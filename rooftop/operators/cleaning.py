"""Flags and cleaned features of both sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions.values import flag, outside
from rooftop.operators import spatial, statistics
from rooftop.session import written

A_COLUMNS = ["area_sq_m", "gkh_floor_count_min", "gkh_floor_count_max"]
B_COLUMNS = ["height", "stairs", "avg_floor_height"]


def physical_flags(df: DataFrame, columns: list[str], bounds: dict = config.BOUNDS) -> DataFrame:
    """Adds X_is_nan and X_phys_bad of each column that is there, and gkh_min_gt_max where both floor counts are."""
    out = {}
    for c in (c for c in columns if c in df.columns):
        out |= {f"{c}_is_nan": F.col(c).isNull(), f"{c}_phys_bad": outside(F.col(c), *bounds[c])}
    if {"gkh_floor_count_min", "gkh_floor_count_max"} <= {*df.columns}:
        out["gkh_min_gt_max"] = flag(F.col("gkh_floor_count_min") > F.col("gkh_floor_count_max"))
    return df.withColumns(out)


def _flag_or_false(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(False)


def height_for_lisa(df: DataFrame) -> DataFrame:
    """Adds height_clean_for_lisa: the height where it is neither physically bad nor beyond the fences."""
    bad = _flag_or_false(df, "height_phys_bad") | _flag_or_false(df, "height_iqr_bad")
    return df.withColumn("height_clean_for_lisa", F.when(~bad, F.col("height")))


def needs_review(df: DataFrame) -> DataFrame:
    return df.withColumn("height_needs_review", F.col("height_phys_bad") | F.col("height_iqr_bad"))


def review_groups(df: DataFrame) -> DataFrame:
    """Adds needs_review and review_group; a physical fault comes first."""
    phys, iqr, lisa = F.col("height_phys_bad"), F.col("height_iqr_bad"), F.col("lisa_flag")
    group = F.when(phys, "physical_bad").when(iqr & lisa, "iqr_and_lisa").when(lisa, "lisa_only").when(iqr, "iqr_only").otherwise("clean")
    return df.withColumns({"needs_review": phys | iqr | lisa, "review_group": group})


def height_clean_final(df: DataFrame) -> DataFrame:
    """Adds height_clean_final and height_drop_reason; the two statistical faults together come first in the reason."""
    phys, both = F.col("height_phys_bad"), F.col("height_iqr_bad") & F.col("lisa_flag")
    reason = F.when(both, "iqr_and_lisa").when(phys, "physical_bounds")
    return df.withColumns({"height_clean_final": F.when(~(phys | both), F.col("height")), "height_drop_reason": reason})


def domain_cap(df: DataFrame, city: str = "spb") -> DataFrame:
    """Adds height_domain_cap_bad and drops heights above the city's cap; an unknown city changes nothing."""
    if city not in config.CITY_CAPS:
        return df
    bad = flag(F.col("height_clean_final") > config.CITY_CAPS[city]["height"])
    df = df.withColumn("height_domain_cap_bad", bad)
    bad = F.col("height_domain_cap_bad")
    return df.withColumns(
        {
            "height_clean_final": F.when(~bad, F.col("height_clean_final")),
            "height_drop_reason": F.when(bad, "domain_cap").otherwise(F.col("height_drop_reason")),
        }
    )


def clean_by_flags(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds name and name's drop reason: no physical fault and within the fences; the fences come first in the reason."""
    phys, iqr = F.col(f"{column}_phys_bad"), F.col(f"{column}_iqr_bad")
    return df.withColumns({name: F.when(~(phys | iqr), F.col(column)), f"{column}_drop_reason": F.when(iqr, "iqr").when(phys, "physical_bounds")})


def clean_floors(df: DataFrame) -> DataFrame:
    """Adds cleaned floor counts, swapped where out of order, and their middle where both are known."""
    low, high = (F.when(~F.col(f"{c}_phys_bad"), F.col(c)) for c in ("gkh_floor_count_min", "gkh_floor_count_max"))
    df = df.withColumns({"gkh_floor_count_min_clean": low, "gkh_floor_count_max_clean": high})
    low, high = F.col("gkh_floor_count_min_clean"), F.col("gkh_floor_count_max_clean")
    swapped = flag(low > high)
    return df.withColumns(
        {
            "gkh_floor_count_min_clean": F.when(swapped, high).otherwise(low),
            "gkh_floor_count_max_clean": F.when(swapped, low).otherwise(high),
            "gkh_floor_mid": (low + high) / 2,
        }
    )


def clean_area(df: DataFrame, small: float = 20.0) -> DataFrame:
    """Adds area_sq_m_clean and area_sq_m_small_flag."""
    df = df.withColumn("area_sq_m_clean", F.when(~F.col("area_sq_m_phys_bad"), F.col("area_sq_m")))
    return df.withColumn("area_sq_m_small_flag", flag(F.col("area_sq_m_clean") < small))


def _counters(df: DataFrame, counters: dict[str, str]) -> DataFrame:
    """One row of counts: names of flags, or +name for values that aren't null; a missing column counts 0."""
    out = []
    for name, of in counters.items():
        c = of.lstrip("+")
        what = F.lit(0).cast("long") if c not in df.columns else F.count(c) if of[0] == "+" else F.count_if(F.col(c))
        out.append((F.max(what) if c not in df.columns else what).alias(name))
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(out, counters, strict=True)])


def height_summary(b: DataFrame) -> DataFrame:
    names = {
        "height_raw": "+height",
        "height_phys_bad": "height_phys_bad",
        "height_iqr_bad": "height_iqr_bad",
        "height_lisa": "lisa_flag",
        "height_needs_review": "needs_review",
        "height_clean": "+height_clean_final",
        "height_domain_cap": "height_domain_cap_bad",
    }
    return _counters(b, names)


def summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """A row for each source: counter names in one column, counts in the other."""
    names_a = {
        "a_gkh_min_phys_bad": "gkh_floor_count_min_phys_bad",
        "a_gkh_max_phys_bad": "gkh_floor_count_max_phys_bad",
        "a_gkh_min_gt_max": "gkh_min_gt_max",
        "a_area_phys_bad": "area_sq_m_phys_bad",
        "a_area_small": "area_sq_m_small_flag",
    }
    names_b = {
        "b_height_clean": "+height_clean_final",
        "b_stairs_clean": "+stairs_clean",
        "b_afh_clean": "+avg_floor_height_clean",
        "b_stairs_phys_bad": "stairs_phys_bad",
        "b_afh_phys_bad": "avg_floor_height_phys_bad",
    }
    rows = []
    for df, total, names in ((a, "a_rows", names_a), (b, "b_rows", names_b)):
        one = _counters(df, names).withColumnRenamed("rows", total)
        rows.append(
            one.select(
                F.explode(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).cast("long").alias("n")) for c in one.columns])).alias("x")
            ).select("x.counter", "x.n")
        )
    return rows[0].unionByName(rows[1])


def clean_a(a: DataFrame, settings: config.Settings) -> DataFrame:
    """All flags and cleaned features of the register."""
    return clean_area(clean_floors(physical_flags(a, A_COLUMNS, settings.bounds)), settings.small_area)


def clean_b(b: DataFrame, settings: config.Settings) -> DataFrame:
    """All flags and cleaned features of the height survey; the order of the steps matters. Needs row_idx, cx, cy."""
    b = written(statistics.with_iqr_flags(physical_flags(b, B_COLUMNS, settings.bounds), B_COLUMNS, settings.iqr_k), "fences")
    b = spatial.with_lisa(statistics.with_zscore(height_for_lisa(needs_review(b))), settings)
    b = domain_cap(height_clean_final(review_groups(b)), settings.city)
    return clean_by_flags(clean_by_flags(b, "stairs", "stairs_clean"), "avg_floor_height", "avg_floor_height_clean")
