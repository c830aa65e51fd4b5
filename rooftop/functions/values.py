"""Arithmetic on values and arrays that may hold nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def flag(condition: Column) -> Column:
    """A condition that is never null."""
    return F.coalesce(condition, F.lit(False))


def outside(value: Column, low: float, high: float) -> Column:
    return flag(~value.between(low, high))


def clip(value: Column, low: float, high: float) -> Column:
    """Between low and high; null stays null."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole; null unless whole is above 0."""
    return F.when(whole > 0, F.try_divide(part, whole))


def no_nan(df: DataFrame) -> DataFrame:
    """NaN of every floating column as null."""
    kinds = (DoubleType, FloatType)
    return df.select(
        *[F.nanvl(F.col(f"`{f.name}`"), F.lit(None)).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`") for f in df.schema]
    )


def array_mean(values: Column) -> Column:
    """Mean of the elements that aren't null; null if there are none."""
    kept = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / F.size(kept))


def array_weighted_mean(values: Column, weights: Column) -> Column:
    """Mean of values weighted by the elements of weights at the same places, up to the shorter array's end.

    Pairs with a null, and weights that aren't above 0, are left out; null if no pair is left.
    """
    n = F.least(F.size(values), F.size(weights))
    pairs = F.filter(
        F.slice(F.arrays_zip(values.alias("v"), weights.alias("w")), 1, F.greatest(n, F.lit(0))),
        lambda p: p["v"].isNotNull() & (p["w"] > 0),
    )
    add = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + p["v"] * p["w"])
    return F.when(F.size(pairs) > 0, add / F.aggregate(pairs, F.lit(0.0), lambda a, p: a + p["w"]))


def mapped(key: Column, values: dict, default) -> Column:
    """A literal map's value of a key, or a default."""
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out
