"""Fitted models as plain numbers, and their scores as column expressions.

An exported model scores inside any query, without the ML runtime, and its numbers can be
compared, stored as JSON and repeated in SQL. Its size is that of the model, not of the data.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel, MultilayerPerceptronClassificationModel
from pyspark.ml.feature import ImputerModel, StandardScalerModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import scoring
from cohortloom.operators.scale import scratch_path

#: A layer: a row of weights for each of its units, and their biases.
Layer = tuple[list[list[float]], list[float]]


@dataclass
class Exported:
    """What to do with a row: fill missing values, shift and scale, then one kind of model.

    ``layers`` is a network whose last layer gives the classes, ``trees`` a list of (weight, tree)
    with a tree a number or [feature, threshold, low side, high side], ``linear`` the weights and
    the bias; ``link`` says whether these give a logit.
    """

    names: list[str]
    fill: list[float]
    shift: list[float]
    scale: list[float]
    layers: list[Layer] = field(default_factory=list)
    trees: list[tuple[float, list | float]] = field(default_factory=list)
    linear: tuple[list[float], float] | None = None
    link: bool = False

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Exported:
        return Exported(**json.loads(text))

    def inputs(self) -> list[Column]:
        """The prepared features; a missing value is filled before it is shifted and scaled."""
        def prepared(name: str, fill: float, shift: float, scale: float) -> Column:
            value = F.col(name).cast("double")
            value = F.when(value.isNull() | F.isnan(value), F.lit(fill)).otherwise(value)
            return (value - F.lit(shift)) * F.lit(scale)

        return [prepared(*x) for x in zip(self.names, self.fill, self.shift, self.scale)]

    def score(self) -> Column:
        """Probability of class 1 of a classifier, else the predicted number."""
        if self.layers:
            return _network(F.array(*self.inputs()), self.layers)
        if self.trees:

            def summed(x):
                return reduce(lambda a, b: a + b, (F.lit(float(w)) * _walk(x, tree) for w, tree in self.trees))

            return _bound(F.array(*self.inputs()), summed)
        value = scoring.linear_score(self.inputs(), *self.linear)
        return scoring.sigmoid(value) if self.link else value


def _bound(value: Column, body) -> Column:
    """``body`` of the value, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _network(x: Column, layers: Sequence[Layer]) -> Column:
    """Sigmoid units, and the softmax of the last layer for class 1."""
    for weights, bias in layers[:-1]:
        x = _bound(x, _layer(weights, bias, scoring.sigmoid))
    x = _bound(x, _layer(*layers[-1], lambda z: z))

    def softmax(z):
        return F.exp(F.get(z, F.lit(1)) - F.array_max(z)) / F.aggregate(
            F.transform(z, lambda v: F.exp(v - F.array_max(z))), F.lit(0.0), lambda s, t: s + t
        )

    return _bound(x, softmax)


def _layer(weights: list[list[float]], bias: list[float], activation):
    """Function from the inputs of a layer to its units; the weights are one constant."""
    numbers = json.dumps([{"w": w, "b": b} for w, b in zip(weights, bias)])
    units = F.from_json(F.lit(numbers), "array<struct<w: array<double>, b: double>>")

    def run(x: Column) -> Column:
        def unit(r):
            return activation(F.aggregate(F.zip_with(x, r["w"], lambda a, w: a * w), r["b"], lambda s, t: s + t))

        return F.transform(units, unit)

    return run


def _walk(x: Column, tree: list | float) -> Column:
    if isinstance(tree, (int, float)):
        return F.lit(float(tree))
    feature, threshold, low, high = tree
    return F.when(F.get(x, F.lit(feature)) <= F.lit(float(threshold)), _walk(x, low)).otherwise(_walk(x, high))


def export(model: PipelineModel) -> Exported:
    """The numbers of a pipeline of imputer, assembler, scaler and one of the known models."""
    imputer = next(s for s in model.stages if isinstance(s, ImputerModel))
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    names, last = imputer.getInputCols(), model.stages[-1]
    fill = imputer.surrogateDF.head()
    found = Exported(
        names,
        [float(fill[n]) for n in names],
        [float(v) for v in scaler.mean],
        # A feature without spread is scaled to 0.
        [1 / float(v) if v else 0.0 for v in scaler.std],
    )
    if isinstance(last, MultilayerPerceptronClassificationModel):
        found.layers = _layers(list(map(float, last.weights)), last.getLayers())
    elif isinstance(last, GBTRegressionModel):
        found.trees = list(zip(map(float, last.treeWeights), _trees(last)))
    elif isinstance(last, (LinearRegressionModel, LogisticRegressionModel)):
        found.linear = [float(v) for v in last.coefficients], float(last.intercept)
        found.link = isinstance(last, LogisticRegressionModel)
    else:
        raise ValueError(f"no export of {type(last).__name__}")
    return found


def _layers(weights: list[float], sizes: Sequence[int]) -> list[Layer]:
    """Weights come layer by layer: a matrix by columns, then the biases."""
    found, at = [], 0
    for wide, units in zip(sizes[:-1], sizes[1:]):
        matrix = [weights[at + unit : at + units * wide : units] for unit in range(units)]
        at += units * wide
        found.append((matrix, weights[at : at + units]))
        at += units
    return found


def _trees(model: GBTRegressionModel) -> list:
    """Nested splits of every tree, as the saved model holds them; all splits are numeric."""
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    nodes: dict[int, dict] = {}
    for r in rows:
        nodes.setdefault(r.treeID, {})[r.id] = r

    def nested(tree: dict, node):
        if node.leftChild < 0:
            return float(node.prediction)
        (threshold,) = node.split.leftCategoriesOrThreshold
        return [node.split.featureIndex, float(threshold), *(nested(tree, tree[c]) for c in (node.leftChild, node.rightChild))]

    return [nested(nodes[t], nodes[t][0]) for t in sorted(nodes)]


def raw_scores(outcome: Exported, cpc: Exported, features: DataFrame) -> DataFrame:
    """entity_id, p and cpc_raw, in one pass over the features."""
    return features.select("entity_id", outcome.score().alias("p"), cpc.score().alias("cpc_raw"))
