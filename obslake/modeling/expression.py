"""A fitted pipeline as SQL: scaler and tree become one nested CASE.

The expression needs no vectors and no Python, stays in whole-stage code, and
runs in any engine that has CASE and DOUBLE.  Its arithmetic is the scaler's,
(x - mean) * (1 / std), so it takes the same branch on every row.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.feature import StandardScalerModel, StringIndexerModel, VectorAssembler
from pyspark.sql import Column
from pyspark.sql import functions as F


def _stage(model: PipelineModel, kind: type):
    found = [s for s in model.stages if isinstance(s, kind)]
    if len(found) != 1:
        raise ValueError(f"expected one {kind.__name__} in the pipeline, found {len(found)}")
    return found[0]


def _number(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _name(column: str, quote: str) -> str:
    return quote + column.replace(quote, quote * 2) + quote


def prediction_sql(model: PipelineModel, quote: str = "`") -> str:
    """The prediction of the pipeline's tree; null if a feature is null.
    ``quote`` surrounds column names (a double quote in standard SQL)."""
    features = _stage(model, VectorAssembler).getInputCols()
    scaler, tree = _stage(model, StandardScalerModel), _stage(model, DecisionTreeClassificationModel)
    names = [f"CAST({_name(f, quote)} AS DOUBLE)" for f in features]
    centred = scaler.getWithMean()
    value = []
    for name, mean, std in zip(names, scaler.mean.toArray(), scaler.std.toArray()):
        x = f"({name} - {_number(mean)})" if centred else name
        if scaler.getWithStd():
            x = f"{x} * {_number(1.0 / std if std != 0 else 0.0)}"
        value.append(x)

    def walk(node) -> str:
        if node.subtreeDepth() == 0:
            return _number(node.prediction())
        split = node.split()
        if "Continuous" not in split.getClass().getSimpleName():
            raise ValueError("only splits of numbers have an expression")
        left, right = walk(node.leftChild()), walk(node.rightChild())
        if left == right:
            return left
        return f"CASE WHEN {value[split.featureIndex()]} <= {_number(split.threshold())} THEN {left} ELSE {right} END"

    some_null = " OR ".join(f"{_name(f, quote)} IS NULL" for f in features)
    return f"CASE WHEN {some_null} THEN NULL ELSE {walk(tree._call_java('rootNode'))} END"


def label_index_sql(model: PipelineModel, quote: str = "`") -> str:
    """The index of the pipeline's label: an unseen one gets the number of labels."""
    indexer = _stage(model, StringIndexerModel)
    label, labels = _name(indexer.getInputCol(), quote), list(indexer.labels)
    cases = " ".join("WHEN '" + x.replace("'", "''") + f"' THEN {_number(i)}" for i, x in enumerate(labels))
    return f"CASE {label} {cases} ELSE {_number(len(labels))} END" if cases else _number(0)


def prediction(model: PipelineModel) -> Column:
    return F.expr(prediction_sql(model))


def label_index(model: PipelineModel) -> Column:
    return F.expr(label_index_sql(model))
