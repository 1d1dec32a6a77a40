"""Confusion counts, accuracy, weighted F1 and model comparison.

All of them are aggregates over ``label_index`` and ``prediction`` that leave
one row per class or model, whatever the number of predictions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _label() -> Column:
    return F.col("label_index")


def _prediction() -> Column:
    return F.col("prediction")


def confusion_counts(predictions: DataFrame, *by: str) -> DataFrame:
    return predictions.groupBy(*by, "label_index", "prediction").agg(F.count(F.lit(1)).alias("count"))


def _cells() -> list[Column]:
    def cell(actual: int, predicted: float) -> Column:
        return F.count_if((_label() == actual) & (_prediction() == predicted))

    return [
        cell(0, 0.0).alias("TN"),
        cell(0, 1.0).alias("FP"),
        cell(1, 0.0).alias("FN"),
        cell(1, 1.0).alias("TP"),
    ]


def confusion_cells(predictions: DataFrame, *by: str) -> DataFrame:
    """``TN, FP, FN, TP`` in one row; a cell nobody falls into is 0."""
    return predictions.groupBy(*by).agg(*_cells())


def accuracy(predictions: DataFrame, *by: str) -> DataFrame:
    return predictions.groupBy(*by).agg(F.avg((_label() == _prediction()).cast("int")).alias("accuracy"))


def weighted_f1(predictions: DataFrame, *by: str) -> DataFrame:
    """Per-class F1 weighted by how many rows truly are of that class, for any number of classes."""
    hit = F.when(_label() == _prediction(), F.col("count")).otherwise(0)
    none = F.lit(0).cast("bigint")

    def side(cls: Column, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            cls.cast("double").alias("cls"),
            support.alias("support"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    sides = F.array(
        side(_label(), F.col("count"), none, hit),
        side(_prediction(), none, F.col("count"), none),
    )
    f1 = 2 * F.col("hits") / F.nullif(F.col("support") + F.col("predicted"), F.lit(0))
    return (
        confusion_counts(predictions, *by)
        .select(*by, F.inline(sides))
        .groupBy(*by, "cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .groupBy(*by)
        .agg((F.sum(F.coalesce(f1, F.lit(0.0)) * F.col("support")) / F.sum("support")).alias("f1"))
    )


def metrics_from_cells(cells: DataFrame, model: str = "model") -> DataFrame:
    """The comparison table from the four cells of each model."""
    tn, fp, fn, tp = map(F.col, ("TN", "FP", "FN", "TP"))
    total = F.nullif(tn + fp + fn + tp, F.lit(0))

    def f1(hits: Column) -> Column:
        return F.coalesce(2 * hits / F.nullif(2 * hits + fp + fn, F.lit(0)), F.lit(0.0))

    return cells.select(
        F.col(model).alias("Model"),
        ((tn + tp) / total).alias("Accuracy"),
        ((f1(tn) * (tn + fp) + f1(tp) * (fn + tp)) / total).alias("F1-Score"),
        "TN",
        "FP",
        "FN",
        "TP",
    )


def compare_models(predictions: DataFrame, model: str = "model") -> DataFrame:
    """One row per model from one pass over the tagged predictions of all models."""
    return metrics_from_cells(confusion_cells(predictions, model), model)


def class_recall(cells: DataFrame, *by: str) -> DataFrame:
    """Recall of each class: overall accuracy hides a model that always says AI."""
    tn, fp, fn, tp = map(F.col, ("TN", "FP", "FN", "TP"))
    return cells.select(
        *by,
        (tn / F.nullif(tn + fp, F.lit(0))).alias("human_recall"),
        (tp / F.nullif(tp + fn, F.lit(0))).alias("ai_recall"),
    )
