import threading

import pytest
from cohortloom.operators import features as ft
from cohortloom.operators import metrics, models
from cohortloom.plans import jobs, views
from pyspark.sql import Observation
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def features(spark):
    data = [
        (f"e{i:03d}", float(i), None if i % 7 == 0 else float(i % 10), None, i % 2, float(1 + i % 5))
        for i in range(200)
    ]
    return spark.createDataFrame(
        data, "entity_id string, a double, b double, empty double, outcome int, cpc double"
    )


def test_default_vector_has_117_names():
    names = ft.feature_names()
    assert len(names) == len(set(names)) == 117
    assert names[8] == "mean_Fp1_F7" and names[-1] == "quality"


def test_imputation_drops_empty_columns(features):
    filled = ft.mean_impute(features, ["a", "b", "empty"])
    assert filled.columns == ["entity_id", "a", "b"]
    mean = features.agg(F.avg("b")).head()[0]
    assert filled.where("entity_id = 'e007'").head().b == pytest.approx(mean)


@pytest.mark.parametrize("kinds", [("network", "trees"), ("logistic", "linear")])
def test_fit_and_score(features, kinds):
    labels = features.select("entity_id", "outcome", "cpc")
    # b's parity decides the outcome and its remainder the score.
    outcome = models.fit_outcome(features, labels, ["a", "b", "empty"], kinds[0])
    cpc = models.fit_cpc(features, labels, ["a", "b", "empty"], kinds[1])
    failed = features.where("entity_id = 'e003'").select("entity_id")
    scored = models.score_cohort(outcome, cpc, features, failed).cache()
    assert scored.count() == 200
    bad = scored.where("failed").collect()
    assert [(r.entity_id, r.predicted_outcome, r.predicted_cpc) for r in bad] == [("e003", None, None)]
    good = scored.where("not failed")
    assert good.where("predicted_cpc between 1 and 5 and poor_probability between 0 and 1").count() == 199
    assert good.where("predicted_outcome <> cast(poor_probability > 0.5 as int)").count() == 0
    zeros = models.score_cohort(outcome, cpc, features, failed, fill_failed=0.0).where("failed").head()
    assert (zeros.predicted_outcome, zeros.predicted_cpc) == (0.0, 0.0)


def test_fitted_models_survive_saving(features, tmp_path):
    labels = features.select("entity_id", "outcome", "cpc")
    model = models.fit_outcome(features, labels, ["a", "b"], "logistic")
    model.write().save(str(tmp_path / "m"))
    again = models.PipelineModel.load(str(tmp_path / "m"))
    p = again.transform(features).select("prediction").collect()
    assert p == model.transform(features).select("prediction").collect()


def test_logistic_model_after_observed_rows(features):
    observed = Observation()
    features.observe(observed, F.count(F.lit(1)).alias("n")).collect()
    assert observed.get == {"n": 200}
    labels = features.select("entity_id", "outcome", "cpc")
    model = models.fit_outcome(features, labels, ["a", "b"], "logistic")
    assert model.transform(features).select("prediction").where("prediction in (0, 1)").count() == 200


def test_split_is_stable(features):
    training, held = models.hash_split(features, 0.25)
    assert training.count() + held.count() == 200
    assert held.count() == models.hash_split(features.repartition(9), 0.25)[1].count() > 20


def test_metrics_edge_cases(spark):
    none = spark.createDataFrame([(0, 0), (0, 0)], "actual int, predicted int")
    assert tuple(metrics.classification_metrics(none).head()) == (2, 1.0, 0.0)
    some = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "actual int, predicted int")
    assert tuple(metrics.classification_metrics(some).head()) == (4, 0.5, 0.5)
    gaps = spark.createDataFrame(
        [(1.0, 3.0), (2.0, 1.0), (5.0, None)], "actual double, predicted double"
    )
    assert tuple(metrics.regression_metrics(gaps).head()) == (3, 2.5, 1.5)


def test_whole_job(spark, data):
    report = jobs.train_and_evaluate(
        views.entity_text(spark, data),
        views.user_index(spark, data),
        views.user_samples(spark, data),
        channels=views.EVENT_CHANNELS,
        n_fft=views.USER_N_FFT,
        kinds=("logistic", "linear"),
    ).collect()
    assert [r.part for r in report] == ["training", "held_out"]
    assert all(0 <= r.outcome_accuracy <= 1 for r in report)


def test_both_models_are_fitted_at_once(spark, data, features, monkeypatch):
    both = threading.Barrier(2, timeout=20)

    def step(name):
        def fit(table, labels, names, kind):
            both.wait()
            assert spark.sparkContext.getLocalProperty("fits") == "set by the caller"
            return f"{name} {kind} of {table.count()} rows by {names}"

        return fit

    monkeypatch.setattr(models, "fit_outcome", step("outcome"))
    monkeypatch.setattr(models, "fit_cpc", step("cpc"))
    spark.sparkContext.setLocalProperty("fits", "set by the caller")
    fitted = jobs.train(views.entity_text(spark, data), features, ["a"], ("logistic", "linear"))
    spark.sparkContext.setLocalProperty("fits", None)
    assert fitted == ("outcome logistic of 200 rows by ['a']", "cpc linear of 200 rows by ['a']")
    monkeypatch.setattr(models, "fit_cpc", lambda *a: 1 / 0)
    monkeypatch.setattr(models, "fit_outcome", lambda *a: None)
    with pytest.raises(ZeroDivisionError):
        jobs.train(views.entity_text(spark, data), features, ["a"])


def test_fitting_tables_come_in_even_parts(spark):
    features = spark.range(20_000).selectExpr("id as entity_id", "cast(id % 7 as double) as a").coalesce(1)
    labels = spark.range(20_000).selectExpr("id as entity_id", "cast(id % 2 as double) as outcome")
    sizes = [0] * 8
    rows = models._labelled(features, labels, ["a"], "outcome")
    for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect():
        sizes[r.part] = r["count"]
    assert len(sizes) == 8 and min(sizes) > 2_000
    assert rows.agg(F.sum("entity_id"), F.countDistinct("entity_id")).head()[:] == (19_999 * 10_000, 20_000)
    few = models._labelled(features.limit(30), labels, ["a"], "outcome")
    assert few.rdd.getNumPartitions() == 1
