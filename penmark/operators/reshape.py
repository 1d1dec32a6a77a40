"""Wide corpus to labelled rows, and label encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.sources.corpus import GENERATED_COLUMNS, HUMAN_COLUMN, union_all


def authors() -> list[tuple[str, str, str]]:
    """(generator, label, text column) for each author of the wide corpus."""
    generated = [(c.removesuffix("_generated_abstract"), "ai", c) for c in GENERATED_COLUMNS]
    return [("original", "human", HUMAN_COLUMN), *generated]


KEYS = ("doc_id", "row_key", "generation_method")


def to_long(wide: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row per author and abstract, null texts kept.

    The input is scanned once; a union of one select per author would scan it
    once per author. Unpivoting also lets the optimizer leave out the texts
    when a query needs only labels or row counts. ``keep`` is by default what the
    corpus has of ``KEYS``.
    """
    keep = keep or tuple(k for k in KEYS if k in wide.columns)
    renamed = wide.select(*keep, *[F.col(column).alias(generator) for generator, _, column in authors()])
    label = F.when(F.col("generator").isin(*[g for g, kind, _ in authors() if kind == "human"]), "human")
    return renamed.unpivot(list(keep), [g for g, _, _ in authors()], "generator", "text").select(
        *keep, "generator", label.otherwise("ai").alias("label"), "text"
    )


def with_source_key(wide: DataFrame) -> DataFrame:
    """Add the split key ``doc_id`` and the row key ``row_key`` to a corpus without keys.

    ``doc_id`` is a hash of the human text: versions of one abstract share it under every
    generation method, so a split on it keeps them together. Where that text is missing or
    blank the others are hashed. ``row_key`` is a hash of method and all five texts, so only
    rows that are equal in all of them share it.
    """
    every = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for _, _, c in authors()]
    generated = [text for (_, label, _), text in zip(authors(), every) if label == "ai"]
    human = F.when(F.trim(F.col(HUMAN_COLUMN)) != "", F.col(HUMAN_COLUMN))
    method = F.coalesce(F.col("generation_method"), F.lit("")) if "generation_method" in wide.columns else F.lit("")
    return wide.withColumn("doc_id", F.md5(F.coalesce(human, F.concat_ws("\u001f", *generated)))).withColumn(
        "row_key", F.md5(F.concat_ws("\u001f", method, *every))
    )


def author_rows(wide: DataFrame, generator: str, keep: tuple[str, ...] = ("doc_id", "generation_method")) -> DataFrame:
    """The rows of one author only, with the same columns as ``to_long``."""
    label, column = {g: (lab, col) for g, lab, col in authors()}[generator]
    return wide.select(
        *keep, F.lit(generator).alias("generator"), F.lit(label).alias("label"), F.col(column).alias("text")
    )


def union_strict(*frames: DataFrame) -> DataFrame:
    """Union by name that refuses frames with differing columns; duplicates stay."""
    return union_all(list(frames))


def label_index(label: Column, positive: str = "ai") -> Column:
    """1 for the positive label, 0 for any other, null for null."""
    return (label == positive).cast("int")


def decode_prediction(prediction: Column) -> Column:
    return F.when(prediction == 1.0, "AI").otherwise("Human")


def class_name(index: Column) -> Column:
    return F.when(index == 0, "Human").when(index == 1, "AI")
