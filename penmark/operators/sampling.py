"""Splits, samples and peeks that do not depend on how rows are laid out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")


def split_bucket(key: Column) -> Column:
    """0..99 from the first 32 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 100


def split_name(key: Column, train: int = 70, validation: int = 15) -> Column:
    bucket = split_bucket(key)
    return (
        F.when(bucket < train, SPLITS[0]).when(bucket < train + validation, SPLITS[1]).otherwise(SPLITS[2])
    )


def with_split(df: DataFrame, key: str = "doc_id", train: int = 70, validation: int = 15) -> DataFrame:
    """Add ``split``. All rows of one key, such as the versions of one abstract, stay together."""
    return df.withColumn("split", split_name(F.col(key), train, validation))


def seeded_sample(df: DataFrame, n: int, *key: str, seed: int = 42) -> DataFrame:
    """At most n rows, chosen by a hash of key and seed: the same rows under any layout."""
    rank = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return df.orderBy(rank, *key).limit(n)


def peek(df: DataFrame, n: int, *key: str) -> DataFrame:
    return df.orderBy(*key).limit(n)
