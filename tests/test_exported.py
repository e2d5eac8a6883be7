"""Exported models give what the fitted pipelines give."""

import pytest
from cohortloom.operators import exported, models
from pyspark.sql import functions as F

NAMES = ["a", "b", "flat"]


@pytest.fixture(scope="module")
def features(spark):
    data = [(f"e{i:03d}", float(i), None if i % 7 == 0 else float(i % 10), 2.0, i % 2, float(1 + i % 5)) for i in range(200)]
    data += [("none", None, float("nan"), None, None, None)]
    return spark.createDataFrame(data, "entity_id string, a double, b double, flat double, outcome int, cpc double")


@pytest.mark.parametrize("kinds", [("network", "trees"), ("logistic", "linear")])
def test_same_scores_as_the_pipelines(spark, features, kinds):
    labels = features.select("entity_id", "outcome", "cpc")
    fitted = (models.fit_outcome(features, labels, NAMES, kinds[0]), models.fit_cpc(features, labels, NAMES, kinds[1], rounds=4, depth=3))
    plain = [exported.Exported.from_json(exported.export(m).to_json()) for m in fitted]
    failed = features.where("entity_id = 'e005'").select("entity_id")
    one = {r.entity_id: r for r in models.score_cohort(*fitted, features, failed).collect()}
    scored = models.score_cohort(*plain, features, failed)
    other = {r.entity_id: r for r in scored.collect()}
    assert one.keys() == other.keys() and len(one) == 201
    for key, r in one.items():
        assert (other[key].failed, other[key].predicted_outcome) == (r.failed, r.predicted_outcome)
        for name in ("poor_probability", "predicted_cpc"):
            assert (other[key][name] is None) == (r[name] is None) == r.failed
            assert r.failed or other[key][name] == pytest.approx(r[name], abs=1e-9)
    assert "Python" not in scored._jdf.queryExecution().toString()


def test_unknown_models_raise(spark, features):
    rows = features.dropna().select("entity_id", "a", F.col("cpc"))
    model = models.Pipeline(stages=models._preparation(["a"])).fit(rows)
    with pytest.raises(ValueError):
        exported.export(model)
