"""The stages from raw corpus to report, each reading and writing tables.

A stage's output table is the next stage's input, so a lost executor repeats
tasks of one stage only and nothing depends on cached blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.functions.lexicon import ARABIC, LanguageProfile
from penmark.functions.text import add_style_features, prepare
from penmark.operators.classify import (
    CLASSIFIER_SETTINGS,
    fit_classifier,
    fit_features,
    score_all,
    vectorized,
    with_class_weight,
)
from penmark.operators.evaluation import compare_models
from penmark.operators.projection import boundary_line, fit_boundary, fit_components, plot_points, project
from penmark.operators.reshape import label_index, to_long
from penmark.operators.sampling import SPLITS, with_split
from penmark.operators.tfidf import MIN_DF, VOCAB_SIZE
from penmark.sources.corpus import load_model, read_report_csv, save_model, write_report_csv, write_table

ROW_KEY = ("doc_id", "row_key", "generation_method", "generator")


def row_key(df: DataFrame) -> list[str]:
    """The columns that tell the rows of a corpus apart; derived corpora have no ``row_key``."""
    return [c for c in ROW_KEY if c in df.columns]


@dataclass(frozen=True)
class Workspace:
    """Where the stages keep their tables, models and reports."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name.lower().replace(' ', '_')}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def build_corpus(wide: DataFrame, ws: Workspace, profile: LanguageProfile = ARABIC) -> DataFrame:
    """Wide corpus to labelled rows with clean text and tokens."""
    return write_table(prepare(to_long(wide), profile), ws.table("corpus"))


def build_features(
    corpus: DataFrame,
    ws: Workspace,
    profile: LanguageProfile = ARABIC,
    split_key: str = "doc_id",
    keep_texts: bool = False,
) -> DataFrame:
    """Stylometric columns, label index and split, stored by split.

    Readers of one split skip the other two by their folder. The texts stay in
    the corpus table unless ``keep_texts``: nothing after this stage reads them.
    Tokens have no blanks, so they are stored as one line: a string is written and read
    several times as fast as an array of them. ``unpacked`` gives the array back.
    """
    featured = add_style_features(corpus, profile).withColumn("label_index", label_index(F.col("label")))
    if not keep_texts:
        featured = featured.drop("text", "clean_text")
    packed = featured.withColumn("tokens", F.array_join("tokens", " "))
    return unpacked(write_table(with_split(packed, split_key), ws.table("features"), partition_by="split"))


def unpacked(table: DataFrame) -> DataFrame:
    """A stored table with its ``tokens`` as an array, however they are stored."""
    if dict(table.dtypes).get("tokens") != "string":
        return table
    none = F.array().cast("array<string>")
    return table.withColumn("tokens", F.when(F.col("tokens") == "", none).otherwise(F.split("tokens", " ")))


def build_feature_model(
    features: DataFrame,
    ws: Workspace,
    vocab_size: int = VOCAB_SIZE,
    min_df: int = MIN_DF,
    fit_scope: str = "train",
) -> PipelineModel:
    """Fit the feature model and save it.

    ``fit_scope="all"`` also lets validation and test rows shape vocabulary and
    IDF, which flatters the scores.
    """
    if fit_scope not in ("train", "all"):
        raise ValueError("fit_scope is 'train' or 'all'")
    scope = features if fit_scope == "all" else features.where(F.col("split") == SPLITS[0])
    model = fit_features(scope, vocab_size, min_df)
    save_model(model, ws.model("features"))
    return model


def store_vectors(features: DataFrame, model: PipelineModel, ws: Workspace) -> DataFrame:
    """The vectors of every split as a table."""
    vectors = vectorized(features, model, *row_key(features), "split")
    return write_table(vectors, ws.table("vectors"), partition_by="split")


def build_vectors(
    features: DataFrame,
    ws: Workspace,
    vocab_size: int = VOCAB_SIZE,
    min_df: int = MIN_DF,
    fit_scope: str = "train",
) -> tuple[DataFrame, PipelineModel]:
    """Fit the feature model and store the vectors of every split."""
    model = build_feature_model(features, ws, vocab_size, min_df, fit_scope)
    return store_vectors(features, model, ws), model


def split_of(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


def train_models(
    vectors: DataFrame,
    features: PipelineModel,
    ws: Workspace,
    names: tuple[str, ...] = tuple(CLASSIFIER_SETTINGS),
    balanced: bool = False,
) -> dict[str, PipelineModel]:
    """Fit each classifier on the training vectors and save it with its feature stages."""
    train = split_of(vectors, SPLITS[0])
    weight = None
    if balanced:
        train, weight = with_class_weight(train), "class_weight"
    models = {}
    for name in names:
        models[name] = fit_classifier(train, features, name, weight)
        save_model(models[name], ws.model(name))
    return models


def load_models(ws: Workspace, names: tuple[str, ...] = tuple(CLASSIFIER_SETTINGS)) -> dict[str, PipelineModel]:
    return {name: load_model(ws.model(name)) for name in names}


def predictions(vectors: DataFrame, models: dict[str, PipelineModel], split: str) -> DataFrame:
    return score_all(split_of(vectors, split), models, *row_key(vectors), "label_index")


def store_predictions(
    vectors: DataFrame, models: dict[str, PipelineModel], ws: Workspace, split: str
) -> DataFrame:
    """Predictions as a table, for reports that would otherwise score again."""
    return write_table(predictions(vectors, models, split), ws.table(f"{split}_predictions"))


METRICS = "Model string, Accuracy double, `F1-Score` double, TN bigint, FP bigint, FN bigint, TP bigint"


def report_comparison(scored: DataFrame, ws: Workspace) -> DataFrame:
    """The comparison table as CSV, one row per model, and read back from there."""
    path = ws.report("model_comparison_results")
    write_report_csv(compare_models(scored).orderBy("Model"), path)
    return read_report_csv(scored.sparkSession, path, METRICS)


def build_projection(vectors: DataFrame, ws: Workspace, split: str = SPLITS[2]) -> tuple[DataFrame, DataFrame]:
    """Plot points and boundary line of one split, from its whole vectors."""
    rows, key = split_of(vectors, split), row_key(vectors)
    projected = write_table(project(rows, fit_components(rows), *key), ws.table("projection"))
    points = write_table(plot_points(projected, *key), ws.table("plot_points"))
    line = write_table(boundary_line(points, fit_boundary(points)), ws.table("plot_line"))
    return points, line


def open_table(spark: SparkSession, ws: Workspace, name: str) -> DataFrame:
    return unpacked(spark.read.parquet(ws.table(name)))
