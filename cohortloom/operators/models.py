"""Outcome and score models as Spark ML pipelines, and scoring of a cohort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import scoring
from cohortloom.operators.exported import Exported, raw_scores
from cohortloom.operators.features import mean_imputer, usable_features
from cohortloom.operators.scale import scratch_path, written_table

# Hidden layer sizes of the outcome network and rounds of training.
HIDDEN_LAYERS = (128, 64, 32, 16)
MAX_ITERATIONS = 50
L2_PENALTY = 0.001
TREE_ROUNDS, TREE_DEPTH = 20, 4
# Rows of a part that a fit reads in one task.
LEAST_ROWS, MOST_ROWS = 2_000, 500_000


def _preparation(names: Sequence[str]) -> list:
    """Impute, assemble and scale; shared by both models."""
    imputer = mean_imputer(names)
    assembler = VectorAssembler(
        inputCols=imputer.getOutputCols(), outputCol="assembled", handleInvalid="keep"
    )
    scaler = StandardScaler(
        inputCol="assembled", outputCol="scaled_features", withMean=True, withStd=True
    )
    return [imputer, assembler, scaler]


def _labelled(
    features: DataFrame, labels: DataFrame, names: Sequence[str], label: str
) -> DataFrame:
    """Features of the entities with a label, written once: every fitting pass reads them."""
    known = labels.where(F.col(label).isNotNull()).select("entity_id", label)
    rows = features.select("entity_id", *names).join(known, "entity_id")
    return _even_parts(written_table(rows, "labelled"))


def _even_parts(rows: DataFrame) -> DataFrame:
    """The rows in equal parts for the cores: narrow rows cost a fit their number, not their bytes.

    A table of few bytes comes in one part, and every step of a fit would then run on one core.
    """
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = cores * math.ceil(n / (cores * MOST_ROWS)) if n > cores * LEAST_ROWS else math.ceil(n / LEAST_ROWS)
    if parts <= 1:
        return rows
    return written_table(rows.repartition(parts, "entity_id").sortWithinPartitions("entity_id"), "parts")


def fit_outcome(
    features: DataFrame,
    labels: DataFrame,
    names: Sequence[str],
    kind: str = "network",
    seed: int = 42,
) -> PipelineModel:
    """Classifier of the outcome: ``network`` (multilayer perceptron) or ``logistic``."""
    rows = _labelled(features, labels, names, "outcome")
    usable = usable_features(rows, names)
    if kind == "network":
        model = MultilayerPerceptronClassifier(
            featuresCol="scaled_features",
            labelCol="outcome",
            layers=[len(usable), *HIDDEN_LAYERS, 2],
            maxIter=MAX_ITERATIONS,
            seed=seed,
        )
    else:
        model = LogisticRegression(
            featuresCol="scaled_features",
            labelCol="outcome",
            maxIter=MAX_ITERATIONS,
            regParam=L2_PENALTY,
        )
    fitted = Pipeline(stages=[*_preparation(usable), model]).fit(rows)
    return fitted if kind == "network" else _without_summary(fitted, rows)


def _without_summary(fitted: PipelineModel, rows: DataFrame) -> PipelineModel:
    """The model as it is saved, without the summary of its training.

    A logistic model's summary holds the session, which can't go to tasks once any rows were observed.
    """
    path = scratch_path(rows.sparkSession, "model")
    fitted.save(path)
    return PipelineModel.load(path)


def fit_cpc(
    features: DataFrame,
    labels: DataFrame,
    names: Sequence[str],
    kind: str = "trees",
    seed: int = 42,
    rounds: int = TREE_ROUNDS,
    depth: int = TREE_DEPTH,
    penalty: float = L2_PENALTY,
) -> PipelineModel:
    """Regressor of the ordinal score: ``trees`` (boosted) or ``linear`` with an L2 penalty."""
    rows = _labelled(features, labels, names, "cpc")
    usable = usable_features(rows, names)
    options = {"featuresCol": "scaled_features", "labelCol": "cpc", "predictionCol": "cpc_raw"}
    if kind == "trees":
        model = GBTRegressor(maxIter=rounds, maxDepth=depth, seed=seed, **options)
    else:
        model = LinearRegression(maxIter=MAX_ITERATIONS, regParam=penalty, **options)
    return Pipeline(stages=[*_preparation(usable), model]).fit(rows)


def _raw_scores(outcome_model: PipelineModel, cpc_model: PipelineModel, features: DataFrame) -> DataFrame:
    # Both models score the same row, one after the other.
    by_outcome = outcome_model.transform(features).select(
        *features.columns, F.get(vector_to_array("probability"), F.lit(1)).alias("p")
    )
    return cpc_model.transform(by_outcome).select("entity_id", "p", "cpc_raw")


def score_cohort(
    outcome_model: PipelineModel | Exported,
    cpc_model: PipelineModel | Exported,
    features: DataFrame,
    failed: DataFrame | None = None,
    fill_failed: float | None = None,
) -> DataFrame:
    """entity_id, predicted_outcome, poor_probability, predicted_cpc, failed.

    Entities listed in ``failed`` (their data could not be assembled) get NULL scores, or
    ``fill_failed`` where given. Both models are fitted pipelines, or both are exported.
    """
    exported = isinstance(outcome_model, Exported)
    scored = (raw_scores if exported else _raw_scores)(outcome_model, cpc_model, features)
    if failed is None:
        scored = scored.withColumn("failed", F.lit(False))
    else:
        marks = failed.select("entity_id").distinct().withColumn("failed", F.lit(True))
        scored = scored.join(marks, "entity_id", "left")
        scored = scored.withColumn("failed", F.coalesce("failed", F.lit(False)))
    p = F.col("p")

    def guard(value, fill):
        return F.when(~F.col("failed"), value).otherwise(F.lit(fill).cast("double"))

    return scored.select(
        "entity_id",
        guard(scoring.score_threshold(p).cast("double"), fill_failed).alias("predicted_outcome"),
        guard(p, fill_failed).alias("poor_probability"),
        guard(scoring.clip_score(F.col("cpc_raw")), fill_failed).alias("predicted_cpc"),
        "failed",
    )


def hash_split(table: DataFrame, holdout: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(training, held-out) rows by a hash of the entity, the same on every run."""
    position = F.pmod(F.xxhash64(F.lit(seed), "entity_id"), F.lit(1_000_000)) / 1_000_000
    return table.where(position >= holdout), table.where(position < holdout)
