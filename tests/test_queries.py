"""Queries against DuckDB on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from rooftop.plans import queries

DATA = "/root/testdata/sf0.001"
FAST = ["strong_pairs", "polygon_pair_metrics", "component_table", "address_validation", "height_selection", "dedupe_source", "iqr_flags", "lisa_local_i", "rank_pct", "eco_risk", "knn_features", "utm_projection", "norm_text", "geometry_diagnostics"]


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("part", "customer", "orders", "lineitem", "events"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    want = con.execute(queries.SQL[name])
    names = sorted(c[0] for c in want.description)
    assert sorted(df.columns) == names
    place = [[c[0] for c in want.description].index(n) for n in names]
    got = sorted(repr([_plain(r[n]) for n in names]) for r in df.collect())
    assert got == sorted(repr([_plain(r[i]) for i in place]) for r in want.fetchall())


def test_contract_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(queries.SQL) <= set(contract.oracle_sql())


def test_learning_queries_run_the_operators_settings(monkeypatch):
    class Stop(Exception):
        pass

    seen = []

    def stop(df, settings):
        seen.append((settings.trees, settings.folds))
        raise Stop

    monkeypatch.setattr(queries, "_to_learn", lambda *_: None)
    monkeypatch.setattr(queries.learning, "shape_features", lambda df: type("Rows", (), {"where": lambda self, _: df})())
    for name in ("spatial_cv", "fill_heights"):
        monkeypatch.setattr(queries.learning, name, stop)
    for name in ("ml_cv_summary", "ml_fill_heights"):
        with pytest.raises(Stop):
            queries.QUERIES[name](None, DATA)
    assert seen == [(300, 5)] * 2
