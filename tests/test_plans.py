"""Plan shape: column pruning reaches the scan, no row-at-a-time Python."""
import contextlib
import io
import re

import pytest

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["rate_by_factor", "batch_score", "chi_square", "roc_auc", "threshold_sweep",
                                  "row_violations", "contingency", "linear_shap"])
def test_no_row_python_and_pruned_scans(spark, name):
    from __spark_entry__ import queries

    text = plan(queries()[name](spark, SF))
    assert "BatchEvalPython" not in text
    scans = re.findall(r"Location: [^\[]*\[([^\]]*)\](?:(?!Location:).)*?ReadSchema: struct<([^>]*)>", text, re.DOTALL)
    inputs = [schema for place, schema in scans if SF in place]
    assert inputs or scans  # a query may read nothing but tables it has written while it was built
    for schema in inputs:
        cols = {c.split(":")[0] for c in schema.split(",")}
        # the fixture needs at most these columns of orders / customer
        assert cols <= {"o_orderkey", "o_custkey", "o_totalprice", "c_custkey", "c_name", "c_mktsegment"}, (name, cols)


def test_filter_reaches_scan(spark):
    from strata.sources.tables import read_table
    from pyspark.sql import functions as F

    text = plan(read_table(spark, SF, "orders").where(F.col("o_totalprice") > 180000).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,180000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_compare_models_validates_every_model_on_all_folds(spark, monkeypatch):
    from strata.plans import q_train

    held = []

    def one(name, make_estimator, train, test, n_features, cv_folds=None):
        held.append((name, cv_folds))
        return {"model": name, "cv_f1_mean": 0.0, "f1": 0.0}, None

    monkeypatch.setattr(q_train, "model_frame", lambda spark, sf: (None, None))
    monkeypatch.setattr(q_train.M, "evaluate_model", one)
    q_train.q_compare_models(spark, SF)
    assert held == [("logistic", None), ("random_forest", None), ("gradient_boosting", None)]
