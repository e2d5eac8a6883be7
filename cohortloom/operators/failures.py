"""Entities that fail in some step of scoring, as rows instead of exceptions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortloom.operators import models, recordings, signals
from cohortloom.operators.exported import Exported

#: Steps in which an entity can fail, in their order.
STEPS = ("text", "recordings", "signals", "scores")
ERROR = "struct<step: string, reason: string, n: bigint>"


def _error(step: str, reason: str, n: Column) -> Column:
    return F.struct(F.lit(step).alias("step"), F.lit(reason).alias("reason"), n.cast("bigint").alias("n"))


def entity_failures(
    entity_text: DataFrame, index: DataFrame, samples: DataFrame, spec: DataFrame | None = None
) -> DataFrame:
    """entity_id and error (step, reason, n) of every entity that fails before it is scored.

    An entity fails if it has no text, if ``n`` recordings that its index names are not stored, or,
    given ``spec`` (what headers claim), if the claims of ``n`` channels of its named recordings
    differ from their samples. The first step in which it fails is reported, one row for each
    entity; rows without an entity id take no part. Counts combine before they are shuffled.
    """
    record = ["entity_id", "record_id"]
    named = index.where(F.col("record_id").isNotNull()).select(*record).distinct()
    known = entity_text.select("entity_id").unionByName(index.select("entity_id")).distinct()
    readable = entity_text.where(F.col("text").isNotNull()).select("entity_id")
    found = [
        ("no text", known.join(readable, "entity_id", "left_anti")),
        ("recording not stored", recordings.orphan_recordings(index, samples)),
    ]
    if spec is not None:
        claimed, stored = (t.join(named, record, "left_semi") for t in (spec, samples))
        report = signals.signal_quality_report(stored, claimed)
        checks = [F.col(c) for c in report.columns if c.endswith("_ok")]
        found.append(("header and samples differ", report.where(~reduce(lambda a, b: a & b, checks))))
    counts = [
        rows.where(F.col("entity_id").isNotNull())
        .groupBy("entity_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("entity_id", F.lit(place).alias("place"), _error(step, reason, F.col("n")).alias("error"))
        for place, (step, (reason, rows)) in enumerate(zip(STEPS, found))
    ]
    failures = reduce(DataFrame.unionByName, counts)
    return failures.groupBy("entity_id").agg(F.min_by("error", "place").alias("error"))


def score_entities(
    outcome_model: PipelineModel | Exported,
    cpc_model: PipelineModel | Exported,
    features: DataFrame,
    failures: DataFrame,
    fill_failed: float | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """entity_id, predicted_outcome, poor_probability, predicted_cpc and error of every entity.

    Entities of ``failures``, also those without features, and entities whose scores are not
    finite get NULL scores, or ``fill_failed`` where given; the others have no error.
    ``observation`` takes the number of entities and of the failures of each step when the
    result is computed.
    """
    scored = models.score_cohort(outcome_model, cpc_model, features).drop("failed")
    numbers = [c for c in scored.columns if c != "entity_id"]
    joined = scored.join(failures.select("entity_id", "error"), "entity_id", "full")
    finite = reduce(lambda a, b: a & b, (F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in numbers))
    late = F.when(~finite, _error("scores", "no finite score", F.lit(1)))
    told = joined.withColumn("error", F.coalesce(F.col("error").cast(ERROR), late.cast(ERROR)))
    fill = F.lit(fill_failed).cast("double")
    shown = [F.when(F.col("error").isNull(), F.col(c)).otherwise(fill).alias(c) for c in numbers]
    result = told.select("entity_id", *shown, "error")
    if observation is None:
        return result
    steps = [F.count_if(F.col("error.step") == s).alias(s) for s in STEPS]
    return result.observe(observation, F.count(F.lit(1)).alias("entities"), *steps)
