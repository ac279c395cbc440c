"""Every registered query against its DuckDB counterpart on the smallest tables."""

import pytest

import __spark_entry__ as registry
from checks.compare import difference

FITTED = {
    "kmeans_clusters", "kmeans_optimal_k", "churn_proba", "churn_feature_importance",
    "churn_model_metrics", "churn_model_metrics_rf", "churn_model_metrics_lr",
}


# The operators for training text have tests of their own.
REPORTS = set(registry._REPORTS)


def test_only_fitted_models_lack_a_counterpart():
    assert REPORTS - set(registry.oracle_sql()) == FITTED
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(REPORTS & set(registry.oracle_sql())))
def test_equals_duckdb(spark, sf_dir, name):
    assert difference(spark, sf_dir, name) is None


def test_entry_has_rows(spark, sf_dir):
    assert registry.entry(spark).count() > 0
