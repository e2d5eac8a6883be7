"""Scores of predictions against actual values, each one global aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_labels(actual: DataFrame, predicted: DataFrame, how: str = "inner") -> DataFrame:
    """Actual and predicted values joined by entity; both present, or with "full" either."""
    return actual.select("entity_id", F.col("label").alias("actual")).join(
        predicted.select("entity_id", F.col("label").alias("predicted")), "entity_id", how
    )


def accuracy(actual: Column, predicted: Column) -> Column:
    return F.avg((actual == predicted).cast("double"))


def f1(actual: Column, predicted: Column) -> Column:
    """F1 of class 1; 0 when the class occurs on neither side."""
    hits = F.count_if((actual == 1) & (predicted == 1))
    misses = F.count_if((actual == 1) & (predicted != 1))
    false_alarms = F.count_if((actual != 1) & (predicted == 1))
    return F.coalesce(F.try_divide(2.0 * hits, 2.0 * hits + misses + false_alarms), F.lit(0.0))


def mean_squared_error(actual: Column, predicted: Column) -> Column:
    d = (actual - predicted).cast("double")
    return F.avg(d * d)


def mean_absolute_error(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted).cast("double"))


def classification_metrics(pairs: DataFrame) -> DataFrame:
    a, p = F.col("actual"), F.col("predicted")
    return pairs.agg(
        F.count(F.lit(1)).alias("n"), accuracy(a, p).alias("accuracy"), f1(a, p).alias("f1")
    )


def regression_metrics(pairs: DataFrame) -> DataFrame:
    a, p = F.col("actual"), F.col("predicted")
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        mean_squared_error(a, p).alias("mse"),
        mean_absolute_error(a, p).alias("mae"),
    )


def evaluation_report(scored: DataFrame) -> DataFrame:
    """The four figures to three decimals from one pass.

    ``scored`` holds outcome, predicted_outcome, cpc and predicted_cpc. Every figure uses
    the rows where both of its values are present.
    """
    o, po = F.col("outcome"), F.col("predicted_outcome")
    c, pc = F.col("cpc"), F.col("predicted_cpc")
    return scored.agg(
        F.round(accuracy(o, po), 3).alias("outcome_accuracy"),
        F.round(f1(o, po), 3).alias("outcome_f1"),
        F.round(mean_squared_error(c, pc), 3).alias("cpc_mse"),
        F.round(mean_absolute_error(c, pc), 3).alias("cpc_mae"),
    )
