"""Exact quantiles and ranks without a single-task sort, and the statistics built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rooftop.functions.values import flag
from rooftop.session import written

#: Distinct values that one task may put in order; more are dealt to ranges that are ordered in parallel.
ONE_TASK = 1_000_000


def in_ranges(counts: DataFrame) -> DataFrame:
    """Adds part, by value: ranges with about as many rows each, whatever the values' distribution; written, so fixed."""
    parts = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), counts.count() // ONE_TASK)
    return written(counts.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()), "ranges")


def value_ranks(df: DataFrame, column: str, most: int = ONE_TASK) -> DataFrame:
    """v, c, before, n of each distinct value: rows that have it, rows below it, rows with any.

    Rows collapse to distinct values before the first shuffle, and the values are written and counted. Few are put in
    order by one task. More are dealt to ranges between sampled quantiles, so that outliers and skew leave the ranges
    alike, ordered within each, and shifted by the sums of the lower ranges: no window spans them all.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    counts = written(counts, "values")
    earlier = lambda w: w.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    if counts.count() <= most:
        n = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
        before = F.coalesce(F.sum("c").over(earlier(Window.partitionBy())), F.lit(0))
        return counts.select("v", "c", F.lit(n).cast("long").alias("n"), before.alias("before"))
    dealt, lower = in_ranges(counts), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("part").agg(F.sum("c").alias("own"))  # a row for each range
    sums = sums.select("part", F.coalesce(F.sum("own").over(lower), F.lit(0)).alias("offset"), F.sum("own").over(Window.partitionBy()).alias("n"))
    inside = F.coalesce(F.sum("c").over(earlier(Window.partitionBy("part"))), F.lit(0))
    return dealt.join(F.broadcast(sums), "part").select("v", "c", "n", (F.col("offset") + inside).alias("before"))


def quantiles(df: DataFrame, column: str, shares: list[float], ranks: DataFrame | None = None) -> DataFrame:
    """One row q0, q1...: quantiles with linear interpolation between neighbours, null for an empty column."""
    ranks, out = value_ranks(df, column) if ranks is None else ranks, []
    for i, p in enumerate(shares):
        at = F.lit(p) * (F.col("n") - 1)
        for name, place in ((f"l{i}", F.floor(at)), (f"h{i}", F.ceil(at))):
            here = (F.col("before") <= place) & (place < F.col("before") + F.col("c"))
            out.append(F.max(F.when(here, F.col("v"))).alias(name))
        out.append(F.max(at - F.floor(at)).alias(f"f{i}"))
    found = ranks.agg(*out)
    return found.select(*[(F.col(f"l{i}") + (F.col(f"h{i}") - F.col(f"l{i}")) * F.col(f"f{i}")).alias(f"q{i}") for i in range(len(shares))])


def with_quantiles(df: DataFrame, names: dict[str, tuple[str, float]], ranks: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adds for each name a column's quantile, the same in all rows. All are found from df as it comes, or from its ranks."""
    out = df
    for column in dict.fromkeys(c for c, _ in names.values()):
        mine = {n: p for n, (c, p) in names.items() if c == column}
        out = out.crossJoin(F.broadcast(quantiles(df, column, list(mine.values()), (ranks or {}).get(column)).toDF(*mine)))
    return out


def with_rank_pct(df: DataFrame, names: dict[str, str], given: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adds for each column: name the rank of its value divided by the number of values; ties share their mean rank, nulls have none."""
    out = df
    for column, name in names.items():
        ranks = (given or {}).get(column)
        ranks = value_ranks(df, column) if ranks is None else ranks
        share = ((F.col("before") + (F.col("c") + 1) / 2) / F.col("n")).alias(name)
        out = out.join(ranks.select(F.col("v").alias("__v"), share), F.col(column).cast("double") == F.col("__v"), "left").drop("__v")
    return out


def with_iqr_flags(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Adds quartiles, range, fences and X_iqr_bad of each column that is there."""
    columns = [c for c in columns if c in df.columns]
    df = with_quantiles(df, {f"{c}_{q}": (c, p) for c in columns for q, p in (("q1", 0.25), ("q3", 0.75))})
    df = df.withColumns({f"{c}_iqr": F.col(f"{c}_q3") - F.col(f"{c}_q1") for c in columns})
    df = df.withColumns(
        {f"{c}_{n}": f for c in columns for n, f in (("lower_fence", F.col(f"{c}_q1") - k * F.col(f"{c}_iqr")), ("upper_fence", F.col(f"{c}_q3") + k * F.col(f"{c}_iqr")))}
    )
    return df.withColumns({f"{c}_iqr_bad": flag((F.col(c) < F.col(f"{c}_lower_fence")) | (F.col(c) > F.col(f"{c}_upper_fence"))) for c in columns})


def with_zscore(df: DataFrame, value: str = "height", clean: str = "height_clean_for_lisa") -> DataFrame:
    """Adds mean and sample deviation of the clean values, and the raw value's z; null without a deviation above 0."""
    one = df.agg(F.avg(clean).alias("height_mean_for_lisa"), F.stddev_samp(clean).alias("height_std_for_lisa"))
    df = df.crossJoin(F.broadcast(one))
    z = F.try_divide(F.col(value) - F.col("height_mean_for_lisa"), F.col("height_std_for_lisa"))
    return df.withColumn("height_z", F.when(F.col("height_std_for_lisa") > 0, z))


def numbered(df: DataFrame, key: str, name: str, width: int = 65536) -> DataFrame:
    """Adds 0, 1, 2... in the order of a distinct non-negative integer key, in parallel by ranges of width keys."""
    df = df.withColumn("__b", F.floor(F.col(key) / width))
    lower = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sums = df.groupBy("__b").agg(F.count(F.lit(1)).alias("own")).select("__b", F.coalesce(F.sum("own").over(lower), F.lit(0)).alias("__o"))
    place = F.row_number().over(Window.partitionBy("__b").orderBy(key))
    return df.join(sums, "__b").withColumn(name, (F.col("__o") + place - 1).cast("long")).drop("__b", "__o")
