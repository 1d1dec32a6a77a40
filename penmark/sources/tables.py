"""The driver's tables, and an Arabic-script corpus that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.sources.corpus import GENERATION_METHODS, spread

# Fixed values of the derived corpus, shared with the SQL in plans/oracle.py.
MARKER_WORDS = ("في", "منذ", "انا", "جامعة", "على", "خلا", "نحن", "مركز", "حاشا", "؟")
LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyz"
ARABIC_LETTERS = "ابتثجحخدذرزسشصضأإآىؤئةعغفق"
ENTITY_TAIL = " مركز علم مركز علم جامعة"
BARE_LETTER, MARKED_LETTER = "ب", "بِـ"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def wide_corpus(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """``documents`` as a wide corpus in Arabic script: one text column per author.

    ``partitions`` deals a table of few splits over that many tasks first.
    """
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text"), partitions)

    def marker(m: int, o: int) -> Column:
        position = ((F.col("doc_id") * m + o) % len(MARKER_WORDS) + 1).cast("int")
        return F.element_at(F.array(*map(F.lit, MARKER_WORDS)), position)

    space = F.lit(" ")
    body = F.translate(F.lower("text"), LATIN_LETTERS, ARABIC_LETTERS)
    base = F.col("base")
    methods = F.array(*map(F.lit, GENERATION_METHODS))
    return docs.select(
        "doc_id", F.concat(marker(1, 0), space, marker(3, 1), space, body, space, marker(7, 2)).alias("base")
    ).select(
        "doc_id",
        base.alias("original_abstract"),
        F.concat(marker(1, 5), space, base).alias("allam_generated_abstract"),
        F.concat(F.replace(base, F.lit(","), F.lit("")), F.lit(ENTITY_TAIL)).alias("jais_generated_abstract"),
        F.replace(base, F.lit(BARE_LETTER), F.lit(MARKED_LETTER)).alias("llama_generated_abstract"),
        F.when(F.col("doc_id") % 10 != 0, F.reverse(base)).alias("openai_generated_abstract"),
        F.element_at(methods, (F.col("doc_id") % 3 + 1).cast("int")).alias("generation_method"),
    )
