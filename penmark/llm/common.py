"""What several operators share: word rule, written tables, key filters, skew-proof joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.session import shared_dir

# A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

# Groups that are joined by broadcast: the largest HOT_GROUPS of them. Any other
# group has at most one HOT_GROUPS-th of all rows.
HOT_GROUPS = 1000

# Slots of a key filter; its table has at most FILTER_SLOTS / 64 rows.
FILTER_SLOTS = 1 << 20


# Shuffle files are deleted when the execution that wrote them has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The folder of the innermost ``discarding`` block.
_discarded: ContextVar[str | None] = ContextVar("discarded", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors reach."""
    base = _discarded.get() or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Tables ``stored`` in the block are deleted at its end; what it leaves has a path from outside."""
    folder = scratch(spark, "steps")
    token = _discarded.set(folder)
    try:
        yield
    finally:
        _discarded.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, True)
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read again.

    Cuts the lineage: a lost executor costs the tasks it ran, not what was written. As
    later steps read the table, the shuffles that made it are freed at once.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    with _shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``stored``, laid out by hash of ``key``: a later join on it moves only the other side."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.option("compression", "zstd").option("path", scratch(spark, name))
    with _shuffles_freed(spark):
        writer.bucketBy(buckets, key).format("parquet").saveAsTable(table)
    return spark.table(table)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def key_filter(keys: DataFrame, *key: str, slots: int = FILTER_SLOTS) -> DataFrame:
    """A table of fixed size that tells which keys cannot be in ``keys``.

    One bit for each of ``slots`` hash values, 64 to a row, so it is broadcast
    whatever the number of keys. It has false positives, never false negatives:
    callers check the key itself afterwards.
    """
    slot = F.pmod(F.xxhash64(*key), F.lit(slots))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") % 64).cast("int"))
    table = (
        keys.select(slot.alias("slot"))
        .groupBy((F.col("slot") / 64).cast("bigint").alias("filter_word"))
        .agg(F.bit_or(bit).alias("filter_bits"))
    )
    return stored(table, "filter")


def filter_slots(n_keys: int, most: int = 1 << 26) -> int:
    """Slots for a filter over so many keys that is mostly empty, up to ``most`` (8 MB)."""
    return min(max(1 << (8 * n_keys).bit_length(), FILTER_SLOTS), most)


def mark_possible(rows: DataFrame, table: DataFrame, flag: str, *key: Column, slots: int = FILTER_SLOTS) -> DataFrame:
    """Add boolean ``flag``: false where the filter rules the key out."""
    slot = F.pmod(F.xxhash64(*key), F.lit(slots))
    marked = rows.withColumn("filter_slot", slot).withColumn("filter_word", (F.col("filter_slot") / 64).cast("bigint"))
    bit = F.call_function("shiftright", F.col("filter_bits"), (F.col("filter_slot") % 64).cast("int"))
    return (
        marked.join(F.broadcast(table), "filter_word", "left")
        .withColumn(flag, F.coalesce(bit.bitwiseAND(F.lit(1).cast("bigint")) == 1, F.lit(False)))
        .drop("filter_slot", "filter_word", "filter_bits")
    )


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Column) -> DataFrame:
    """Left join of rows with a table of one row per key, whatever the skew.

    The largest HOT_GROUPS groups are broadcast. Their rows, and rows with a null
    key, are spread by ``spread`` in the shuffle join that serves all the others,
    where no key has more than one HOT_GROUPS-th of the rows. ``groups`` should be
    a written table, as it is read twice.
    """
    values = [c for c in groups.columns if c != key]
    hot = groups.orderBy(F.desc(size), key).limit(HOT_GROUPS)
    hot = hot.select(F.col(key).alias("hot_key"), F.struct(*values).alias("hot_group"))
    cold = groups.select(F.col(key), F.lit(0).cast("bigint").alias("key_salt"), F.struct(*values).alias("cold_group"))
    salted = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left").withColumn(
        "key_salt",
        F.when(F.col("hot_key").isNull() & F.col(key).isNotNull(), F.lit(0)).otherwise(spread.bitwiseOR(F.lit(1))),
    )
    joined = salted.join(cold, [key, "key_salt"], "left")
    group = F.coalesce("hot_group", "cold_group")
    return joined.select(
        *[F.col(c) for c in rows.columns], *[group[c].alias(c) for c in values]
    )
