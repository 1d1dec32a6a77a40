"""Vocabulary, inverse document frequency and TF-IDF weights."""

from __future__ import annotations

import math

from pyspark.ml import Transformer
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, VectorSizeHint
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.functions.text import term_counts
from penmark.operators.counts import row_count

# Vocabulary size and the documents a term must occur in.
VOCAB_SIZE = 5000
MIN_DF = 5


def term_statistics(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``term, cf, df``: how often a term occurs, and in how many documents.

    Sorted tokens make the last of each run of equals mark one document, so
    both numbers come from a single grouping by term. Grouping by document and
    term first would shuffle the whole corpus.
    """
    s = F.col("s")
    return (
        df.select(F.sort_array(tokens).alias("s"))
        .select(F.inline_outer(F.arrays_zip(s, F.slice(s, F.lit(2), F.size(s)))).alias("term", "following"))
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(
            F.count(F.lit(1)).alias("cf"),
            F.count_if(F.col("following").isNull() | (F.col("following") != F.col("term"))).alias("df"),
        )
    )


def vocabulary(
    df: DataFrame, vocab_size: int = VOCAB_SIZE, min_df: int = MIN_DF, tokens: str = "tokens"
) -> DataFrame:
    """The most frequent terms among those in at least ``min_df`` documents."""
    return (
        term_statistics(df, tokens)
        .where(F.col("df") >= min_df)
        .orderBy(F.desc("cf"), "term")
        .limit(vocab_size)
    )


def with_idf(terms: DataFrame, documents: DataFrame) -> DataFrame:
    """Add ``idf = ln((N + 1) / (df + 1))``; N counts every row, empty texts too."""
    n_rows = row_count(documents).scalar()
    return terms.withColumn("idf", F.log((n_rows + 1) / (F.col("df") + 1)))


def tfidf_rows(df: DataFrame, terms: DataFrame, *key: str, tokens: str = "tokens") -> DataFrame:
    """``key, term, tf, idf, tfidf`` for every vocabulary term of every document.

    ``terms`` comes from :func:`vocabulary`, whose limit bounds what the driver and each
    task hold. The vectoriser drops the other words before anything is exploded.
    """
    ranked = terms.orderBy(F.desc("cf"), "term").select("term", "idf").collect()
    if not ranked:
        return df.sparkSession.createDataFrame([], df.select(*key).schema).selectExpr(
            *[f"`{k}`" for k in key], "'' AS term", "0L AS tf", "0D AS idf", "0D AS tfidf"
        )
    numbered = [(i, r.term, r.idf) for i, r in enumerate(ranked)]
    names = F.broadcast(df.sparkSession.createDataFrame(numbered, "i int, term string, idf double"))
    counted = count_vectorizer([r.term for r in ranked], tokens, "_counts").transform(df)
    vector = F.unwrap_udt("_counts")
    entries = counted.select(*key, F.inline_outer(F.arrays_zip(vector["indices"], vector["values"])).alias("i", "n"))
    joined = entries.where(F.col("i").isNotNull()).join(names, "i")
    return joined.select(
        *key, "term", F.col("n").cast("bigint").alias("tf"), "idf", (F.col("n") * F.col("idf")).alias("tfidf")
    )


def tfidf_rows_by_shuffle(
    df: DataFrame, terms: DataFrame, *key: str, salts: int, tokens: str = "tokens"
) -> DataFrame:
    """The same rows for vocabularies that no task should hold.

    Both sides shuffle on term and salt: a term found in every document is spread over
    ``salts`` tasks, and each salt has its own copy of the terms.
    """
    counted = df.select(*key, F.inline_outer(term_counts(F.col(tokens)))).where(F.col("term").isNotNull())
    salted = counted.withColumn("salt", F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int"))
    copies = terms.select("term", "idf", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    joined = salted.join(copies, ["term", "salt"])
    return joined.select(*key, "term", F.col("tf").cast("bigint").alias("tf"), "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def count_vectorizer(vocab: list[str], tokens: str = "tokens", output: str = "raw_features") -> CountVectorizerModel:
    """A count vectoriser over a vocabulary from :func:`vocabulary`.

    Fitting the vectoriser itself leaves ties at the cut-off to the row order.
    """
    return CountVectorizerModel.from_vocabulary(vocab, inputCol=tokens, outputCol=output)


def collect_terms(terms: DataFrame) -> list[tuple[str, int]]:
    """``(term, df)`` in rank order, on the driver: ``vocabulary`` has limited them already."""
    return [(r.term, r.df) for r in terms.orderBy(F.desc("cf"), "term").collect()]


def idf_weights(terms: list[tuple[str, int]], n_rows: int) -> list[float]:
    return [math.log((n_rows + 1.0) / (df + 1.0)) for _, df in terms]


def idf_scaler(weights: list[float], raw: str = "raw_features", output: str = "tfidf_features") -> list[Transformer]:
    """Multiply raw counts by known weights, and declare the width of the result.

    The vocabulary already holds document frequencies, so fitting ``IDF`` would
    read the corpus once more for the same numbers.
    """
    return [
        ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=raw, outputCol=output),
        VectorSizeHint(inputCol=output, size=len(weights), handleInvalid="optimistic"),
    ]


def idf_estimator(raw: str = "raw_features", output: str = "tfidf_features") -> IDF:
    """The estimator, for counts whose document frequencies are not known."""
    return IDF(inputCol=raw, outputCol=output)
