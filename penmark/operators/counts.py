"""Corpus counts: rows, groups, words, bigrams and vocabulary richness.

Every grouping here combines inside each task before it shuffles, so a word or
label that fills a third of the rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.functions.text import FEATURE_COLUMNS
from penmark.sources.corpus import write_table

# Bits of a table that tells which keys may be among some others: eight for each of these, within limits.
LEAST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 27


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def _bits(rows: DataFrame, key: str, slots: int) -> DataFrame:
    """One bit for each of ``slots`` hash values, 64 to a row: set for those of a key."""
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))
    return rows.groupBy((slot / 64).cast("bigint").alias("word")).agg(F.bit_or(bit).alias("bits"))


def _marked(rows: DataFrame, bits: DataFrame, key: str, flag: str, slots: int) -> DataFrame:
    """Add ``flag``: false for rows whose key is not among those of ``bits``."""
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    found = rows.withColumn("word", (slot / 64).cast("bigint")).join(F.broadcast(bits), "word", "left")
    bit = F.call_function("shiftright", "bits", (slot % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint"))
    return found.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop("word", "bits")


def text_counts(df: DataFrame, text: str, path: str) -> DataFrame:
    """As ``group_count`` of a Parquet table by a column of long texts, which are not shuffled to be counted.

    Digests are counted first, with the place of each one's first row, and kept at ``path``.
    Texts of one row are returned where they lie, and of the others only the first row is
    shuffled. Two tables of bits, broadcast, tell which texts and which rows may be these.
    """
    row = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    digest = F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(b""))
    rows = df.select(F.col(text), digest.alias("digest"), row.alias("at"))
    groups = write_table(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("count"), F.min("at").alias("at")), path)
    several = groups.where("count > 1")
    slots = min(max(1 << (8 * several.count()).bit_length(), LEAST_SLOTS), MOST_SLOTS)
    texts = _bits(several, "digest", slots)
    groups = _marked(groups, texts, "digest", "several", slots).where("several").drop("several")
    marked = _marked(rows, texts, "digest", "several", slots)
    once = marked.where("not several").select(text, F.lit(1).cast("bigint").alias("count"))
    first = _marked(marked.where("several").drop("several"), _bits(groups, "at", slots), "at", "first", slots).where("first")
    return once.union(first.join(groups, ["digest", "at"]).select(text, "count"))


def explode_words(df: DataFrame, *keep: str, tokens: str = "tokens") -> DataFrame:
    """One row per token; empty arrays give none.

    A plain explode makes the optimizer filter on the array's size first, which
    computes the tokens twice when they are not stored. The outer form does not,
    and its one null row per empty array is dropped right after.
    """
    return df.select(*keep, F.explode_outer(tokens).alias("word")).where(F.col("word").isNotNull())


def word_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return group_count(explode_words(df, tokens=tokens), "word")


def bigram_rows(df: DataFrame, *keep: str, tokens: str = "tokens") -> DataFrame:
    """One row per pair of neighbours; pairs never cross documents.

    Zipping the array with itself shifted by one keeps the whole count inside
    generated code, which lambda functions would leave.
    """
    t = F.col(tokens)
    n = F.greatest(F.size(t) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(t, F.lit(1), n).alias("left"), F.slice(t, F.lit(2), n).alias("right"))
    return (
        df.select(*keep, F.inline_outer(pairs).alias("left", "right"))
        .where(F.col("right").isNotNull())
        .select(*keep, F.concat_ws(" ", "left", "right").alias("bigram"))
    )


def bigram_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return group_count(bigram_rows(df, tokens=tokens), "bigram")


def top(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys, equal counts in key order."""
    return counts.orderBy(F.desc("count"), key).limit(k)


def sorted_counts(counts: DataFrame, key: str) -> DataFrame:
    return counts.orderBy(F.desc("count"), key)


def distinct_words(df: DataFrame, tokens: str = "tokens", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return explode_words(df, tokens=tokens).agg(count("word").alias("unique_tokens"))


def type_token_ratio(df: DataFrame, tokens: str = "tokens", approximate: bool = False) -> DataFrame:
    """Unique words over all words in one pass; null for an empty corpus."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return (
        explode_words(df, tokens=tokens)
        .agg(F.count(F.lit(1)).alias("total_tokens"), count("word").alias("unique_tokens"))
        .withColumn("ttr", F.col("unique_tokens") / F.nullif(F.col("total_tokens"), F.lit(0)))
    )


def feature_means(df: DataFrame, by: str = "label") -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(c).alias(f"avg_{c}") for c in FEATURE_COLUMNS])
