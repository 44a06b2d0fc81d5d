import glob
import inspect
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rel = duck.sql(ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of(rel.columns, rel.fetchall())


def test_registered_models_run_over_their_full_ranges(spark, monkeypatch):
    from registry import models
    seen = {}

    def note(module, name, returns=None):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, **k: seen.__setitem__(
            name, inspect.signature(real).bind(*a, **k)) or returns)
        return real
    monkeypatch.setattr(models, "_vectors", lambda *a: None)
    for module, name in ((models.kmeans, "elbow"), (models.quality, "silhouette_by_k"), (models.dtw, "dtw_pairs")):
        note(module, name)
    note(models.prep, "series")
    monkeypatch.setattr(models, "cells", lambda spark, sf, grain: seen.__setitem__("grain", grain))
    for name in ("kmeans_elbow", "silhouette_by_k", "dtw_pairs"):
        entry.queries()[name](spark, None)
    for bound in seen.values():
        if not isinstance(bound, str):
            bound.apply_defaults()
    assert seen["elbow"].arguments["k_range"] == 20 and seen["grain"] == "day"
    assert list(seen["silhouette_by_k"].arguments["ks"]) == list(range(2, 11))
    assert seen["silhouette_by_k"].arguments["n_init"] == 10


def _noted(monkeypatch, module):
    """Product-days made and tables written by `module`, in order."""
    seen, real_days, real_durable = [], module.days, module.durable
    monkeypatch.setattr(module, "days", lambda *a: seen.append("days") or real_days(*a))
    monkeypatch.setattr(module, "durable", lambda df: seen.append("pinned") or real_durable(df))
    return seen


@pytest.mark.parametrize("name", ["cluster_box", "cluster_box_iqr"])
def test_boxes_make_product_days_once(spark, monkeypatch, name):
    from registry import reports
    seen = _noted(monkeypatch, reports)
    getattr(reports, name)(spark, SF)
    assert seen == ["days", "pinned"]


def test_the_plane_of_products_is_made_once(spark, monkeypatch):
    from registry import models
    seen = _noted(monkeypatch, models)
    models._plane(spark, SF)
    assert seen == ["days", "pinned"]
