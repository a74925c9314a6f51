"""Registered queries run the operators' whole jobs."""

import os

import pytest

from vanewright import queries
from vanewright.plans import detectors, features, training


class Reached(Exception):
    pass


def called(monkeypatch, module, name, query, spark, sf):
    """Positional and named arguments of the first call of ``module.name`` in a query."""
    seen = []

    def stop(*args, **options):
        seen.append((args, options))
        raise Reached

    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Reached):
        queries.QUERIES[query](spark, sf)
    return seen[0]


@pytest.mark.parametrize("query", ["farm_forest_scores", "turbine_forest_results"])
def test_forests_are_whole_and_features_selected(monkeypatch, spark, sf, query):
    _, options = called(monkeypatch, training, "run", query, spark, sf)
    assert detectors.TREES == 300 and options.get("trees", 300) == 300 and options.get("names") is None


def test_pool_has_all_windows_and_lags(monkeypatch, spark, sf):
    _, options = called(monkeypatch, features, "farm_pool", "farm_pool", spark, sf)
    assert not {"sizes", "steps"} & set(options)


def test_comparison_has_all_detectors(monkeypatch, spark, sf):
    args, options = called(monkeypatch, training, "compare", "detector_comparison", spark, sf)
    assert len(args) == 3 and not options  # all models, selected features


@pytest.mark.parametrize("query", ["wide_correlations", "wide_selection"])
def test_wide_columns_are_not_written(spark, sf, query):
    """Hundreds of columns made of a table's few take no more disk than some times the table."""
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(spark.conf.get("spark.checkpoint.dir")) for f in files)
    before = size()
    queries.QUERIES[query](spark, sf).collect()
    assert size() - before < 20 * os.path.getsize(f"{sf}/lineitem.parquet")
