"""Feature assembly, the three classifiers, scoring and saved models."""

from __future__ import annotations

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.functions.text import FEATURE_COLUMNS
from penmark.operators.tfidf import (
    MIN_DF,
    VOCAB_SIZE,
    collect_terms,
    count_vectorizer,
    idf_scaler,
    idf_weights,
    vocabulary,
)
from penmark.sources.corpus import union_all

# The settings the published scores were reached with.
LOGISTIC_REGRESSION = "Logistic Regression"
RANDOM_FOREST = "Random Forest"
LINEAR_SVM = "Linear SVM"
CLASSIFIER_SETTINGS = {
    LOGISTIC_REGRESSION: {"maxIter": 20},
    RANDOM_FOREST: {"numTrees": 50, "maxDepth": 10, "seed": 42},
    LINEAR_SVM: {"maxIter": 20, "regParam": 0.1},
}

ESTIMATORS = {
    LOGISTIC_REGRESSION: LogisticRegression,
    RANDOM_FOREST: RandomForestClassifier,
    LINEAR_SVM: LinearSVC,
}


def assembler(tfidf: str = "tfidf_features", output: str = "features") -> VectorAssembler:
    """TF-IDF weights first, then the five stylometric columns."""
    return VectorAssembler(inputCols=[tfidf, *FEATURE_COLUMNS], outputCol=output)


def fit_features(
    featured: DataFrame, vocab_size: int = VOCAB_SIZE, min_df: int = MIN_DF
) -> PipelineModel:
    """Vocabulary, IDF and assembly fitted on ``featured``, as one saved-together model.

    Give it the training rows only, or test rows shape the features.
    """
    terms = collect_terms(vocabulary(featured, vocab_size, min_df))
    if not terms:
        raise ValueError(f"no term occurs in {min_df} documents")
    cv = count_vectorizer([term for term, _ in terms])
    scaler = idf_scaler(idf_weights(terms, featured.count()))
    return PipelineModel(stages=[cv, *scaler, assembler()])


def classifier(name: str, weight_col: str | None = None) -> Estimator:
    settings = dict(CLASSIFIER_SETTINGS[name])
    if weight_col:
        settings["weightCol"] = weight_col
    return ESTIMATORS[name](featuresCol="features", labelCol="label_index", **settings)


def with_class_weight(train: DataFrame, column: str = "class_weight") -> DataFrame:
    """Weights that give both classes the same total: n / (2 * rows of the class)."""
    sizes = dict(train.groupBy("label_index").count().collect())
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for index, size in sizes.items():
        weight = F.when(F.col("label_index") == index, n / (len(sizes) * size)).otherwise(weight)
    return train.withColumn(column, weight)


def fit_classifier(
    train: DataFrame, features: PipelineModel, name: str, weight_col: str | None = None
) -> PipelineModel:
    """Fit one classifier on vectors from ``features`` and join both into one model.

    ``train`` already holds the ``features`` column. Make it a written table:
    the fit reads it more than once, and a table survives lost executors.
    """
    columns = ["features", "label_index", *([weight_col] if weight_col else [])]
    fitted = classifier(name, weight_col).fit(train.select(*columns))
    return PipelineModel(stages=[*features.stages, fitted])


def vectorized(featured: DataFrame, features: PipelineModel, *keep: str) -> DataFrame:
    """Only the columns training needs, so the written table stays narrow."""
    return features.transform(featured).select(*keep, "features", "label_index")


def score(df: DataFrame, model: PipelineModel, *keep: str) -> DataFrame:
    """Score raw feature rows with a full model: vectors and class in one pass."""
    return model.transform(df).select(*keep, "prediction")


def score_all(df: DataFrame, models: dict[str, PipelineModel], *keep: str) -> DataFrame:
    """Predictions of several models over rows that hold ``features``, tagged ``model``.

    All models run over the same row, so the rows are read once.
    """
    scored = df
    tagged = []
    for i, (name, model) in enumerate(models.items()):
        last = model.stages[-1].copy({})
        for param, column in (
            ("predictionCol", f"prediction_{i}"),
            ("rawPredictionCol", f"raw_{i}"),
            ("probabilityCol", f"probability_{i}"),
        ):
            if last.hasParam(param):
                last.set(last.getParam(param), column)
        scored = last.transform(scored)
        tagged.append(F.struct(F.lit(name).alias("model"), F.col(f"prediction_{i}").alias("prediction")))
    return scored.select(*keep, F.inline(F.array(*tagged)))


def score_each(df: DataFrame, models: dict[str, PipelineModel], *keep: str) -> DataFrame:
    """As :func:`score_all` for models with different feature stages: one pass per model."""
    return union_all(
        [score(df, m, *keep).withColumn("model", F.lit(name)) for name, m in models.items()]
    )
