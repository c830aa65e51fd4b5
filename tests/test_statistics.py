import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rooftop.functions.values import array_mean, array_weighted_mean, clip
from rooftop.operators import statistics


def test_quantiles_and_ranks_equal_pandas(spark):
    rng = np.random.default_rng(1)
    values = pd.Series([*rng.normal(10, 3, 300).round(1), *[7.0] * 40, None, None])
    df = spark.createDataFrame([(i, None if pd.isna(v) else float(v)) for i, v in enumerate(values)], "row_idx long, v double")
    got = statistics.quantiles(df, "v", [0.25, 0.5, 0.9]).first()
    assert list(got) == pytest.approx(list(values.quantile([0.25, 0.5, 0.9])))
    ranks = {r.row_idx: r.p for r in statistics.with_rank_pct(df, {"v": "p"}).collect()}
    want = values.rank(pct=True)
    assert all(ranks[i] is None if pd.isna(w) else ranks[i] == pytest.approx(w) for i, w in want.items())


@pytest.mark.parametrize("values,want", [([1, 2, 4, 7, 7, 9, 20], (3.0, 8.0, 13.4)), ([5], (5, 5, 5)), ([], (None, None, None))])
def test_quantiles_of_few_values(spark, values, want):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = statistics.quantiles(df, "v", [0.25, 0.75, 0.9]).first()
    assert list(got) == [w if w is None else pytest.approx(w) for w in want]


def test_rank_pct_of_ties(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 4, 7, 7, 9, 20]], "v double")
    got = sorted(r.p * 7 for r in statistics.with_rank_pct(df, {"v": "p"}).collect())
    assert got == pytest.approx([1, 2, 3, 4.5, 4.5, 6, 7])


def test_iqr_flags_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    rows = statistics.with_iqr_flags(df, ["v", "missing"]).collect()
    assert len(rows) == 2 and all(r.v_iqr_bad is False and r.v_q1 is None for r in rows)


def test_numbered_is_gapless(spark):
    df = spark.createDataFrame([(k,) for k in (900000, 3, 70000, 65536, 65535, 0)], "k long")
    assert {r.k: r.n for r in statistics.numbered(df, "k", "n").collect()} == {0: 0, 3: 1, 65535: 2, 65536: 3, 70000: 4, 900000: 5}


def test_array_means(spark):
    df = spark.createDataFrame([([1.0, None, 3.0], [2.0, 5.0, 0.0], [4.0]), ([], [], [])], "v array<double>, w array<double>, s array<double>")
    got = df.select(array_mean(F.col("v")).alias("m"), array_weighted_mean(F.col("v"), F.col("w")).alias("x"), array_weighted_mean(F.col("v"), F.col("s")).alias("y"), clip(F.lit(1.5), 0.0, 1.0).alias("c")).collect()
    assert tuple(got[0]) == (2.0, 1.0, 1.0, 1.0) and tuple(got[1]) == (None, None, None, 1.0)
