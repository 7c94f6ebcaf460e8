"""Plan invariants over every registered non-training query: no cartesian products or nested-loop
joins (no cross joins / all-pairs), and no row-at-a-time Python UDFs."""

import contextlib
import io

import pytest

from autoprice.plans import registry
from conftest import SF_SMALL

registry.load_all()
TRAINING = {"rf_regressor", "linear_regression", "rf_classifier", "random_search", "batch_predict", "model_save_load",
            "feature_importance", "train_price", "train_validate_price", "ab_test_url", "train_linear_baseline",
            "train_url", "stream_score_fitted", "forest_regressor", "forest_classifier", "random_search_full", "tree_regressor",
            "batch_predict_rows", "train_url_rows"}
KEYS = sorted(k for k in registry.QUERIES if k not in TRAINING)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("key", KEYS)
def test_plan_has_no_cross_join_or_row_udf(spark, key):
    df = registry.QUERIES[key](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert not [f for f in FORBIDDEN if f in plan], plan[:2000]
