"""Exact duplicates by progressive refinement.

Three levels, each reading more of fewer texts: byte length, then a hash of the
first PREFIX characters, then a digest of the full text. A level hands the next
one a key filter of fixed size, so no text is ever shuffled to find copies: only
lengths and hashes are. False positives of a filter cost a hash; the last level
compares full digests.

Defined results. A null text counts as empty, and empty texts are copies of one
another. The largest id of a group stays; null ids count as smallest. Rows that
repeat both id and text are one document to ``mark_copies`` (same decision for
all); ``keep_distinct`` leaves one of them. An empty table gives an empty table.
Columns of any other name are kept as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import join_groups, key_filter, mark_possible, stored, text_or_empty

PREFIX = 64


def _length() -> Column:
    return F.octet_length("_text")


def _prefix() -> Column:
    return F.xxhash64(F.substring("_text", 1, PREFIX))


def _candidates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_digest`` (null where no copy is possible), and groups of two or more."""
    repeated = F.col("n") > 1

    lengths = rows.groupBy(_length().alias("l")).agg(F.count("*").alias("n")).where(repeated)
    rows = mark_possible(rows, key_filter(lengths, "l"), "_by_length", _length())

    level2 = rows.where("_by_length").select(_length().alias("l"), _prefix().alias("p"))
    prefixes = level2.groupBy("l", "p").agg(F.count("*").alias("n")).where(repeated)
    # The prefix is hashed only where the length leaves a copy possible.
    prefix = F.when(F.col("_by_length"), _prefix())
    rows = mark_possible(rows, key_filter(prefixes, "l", "p"), "_by_prefix", _length(), prefix)

    possible = F.col("_by_length") & F.col("_by_prefix")
    rows = rows.withColumn("_digest", F.when(possible, F.sha2("_text", 256)))
    groups = (
        rows.where(possible)
        .groupBy("_digest")
        .agg(F.count("*").alias("_size"), F.max("_id").alias("_keep"))
        .where(F.col("_size") > 1)
    )
    return rows.drop("_by_length", "_by_prefix"), stored(groups, "copies")


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[Column] = ()) -> DataFrame:
    """One row per document: id, the carried columns, keep_id, group_size, kept."""
    carried = [c.alias(f"_c{i}") for i, c in enumerate(carry)]
    names = docs.select(*carry).columns if carry else []
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), *carried)
    marked, groups = _candidates(rows)
    slim = marked.drop("_text")
    joined = join_groups(slim, groups, "_digest", "_size", F.xxhash64(*[c for c in slim.columns if c != "_digest"]))
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return joined.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_c{i}").alias(name) for i, name in enumerate(names)],
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their copies; only texts that may have copies are shuffled."""
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")
    )
    marked, groups = _candidates(rows)
    marked = marked.drop("_text")
    alone = marked.where(F.col("_digest").isNull()).select("_row.*")
    possible = marked.where(F.col("_digest").isNotNull())
    joined = join_groups(possible, groups, "_digest", "_size", F.xxhash64("_id"))
    kept = joined.where(F.col("_size").isNull() | F.col("_id").eqNullSafe(F.col("_keep")))
    return alone.unionByName(kept.dropDuplicates(["_digest", "_id"]).select("_row.*"))
