"""Encodings and scores as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two outcome words and the range of the ordinal score.
GOOD_OUTCOME = "Good"
POOR_OUTCOME = "Poor"
SCORE_RANGE = (1.0, 5.0)


def encode_outcome(outcome: Column, strict: bool = False) -> Column:
    """Good is 0, Poor is 1, anything else NULL (``strict`` raises instead)."""
    encoded = F.when(outcome == GOOD_OUTCOME, F.lit(0)).when(outcome == POOR_OUTCOME, F.lit(1))
    if strict:
        problem = F.concat(F.lit("no usable outcome: "), F.coalesce(outcome, F.lit("missing")))
        return encoded.otherwise(F.raise_error(problem).cast("int"))
    return encoded


def one_hot_sex(sex: Column) -> list[Column]:
    """Columns female, male, other; a missing value counts as other."""
    female = F.coalesce(sex == "Female", F.lit(False))
    male = F.coalesce(sex == "Male", F.lit(False))
    return [
        female.cast("int").alias("female"),
        male.cast("int").alias("male"),
        (~female & ~male).cast("int").alias("other"),
    ]


def clip_score(score: Column, low: float = SCORE_RANGE[0], high: float = SCORE_RANGE[1]) -> Column:
    """The score within its range; NaN has no place in it and gives NULL."""
    return F.when(score.isNotNull() & ~F.isnan(score), F.greatest(F.lit(low), F.least(F.lit(high), score)))


def sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def score_threshold(probability: Column, cut: float = 0.5) -> Column:
    """Class 1 strictly above the cut, else 0; a missing probability has no class."""
    return F.when(probability.isNotNull(), (probability > cut).cast("int"))


def linear_score(features: Sequence[Column], weights: Sequence[float], bias: float) -> Column:
    """Dot product plus bias, left as one expression for code generation."""
    if len(features) != len(weights):
        raise ValueError(f"{len(features)} features but {len(weights)} weights")
    terms = (f * F.lit(float(w)) for f, w in zip(features, weights))
    return reduce(lambda a, b: a + b, terms, F.lit(float(bias)))
