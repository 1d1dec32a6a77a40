"""Mixing sources to target weights.

The words of each source form one stream, packed into blocks of BLOCK words. Each
output shard holds SHARD_BLOCKS slots, and every slot has a source and a block:

* a source has a slot for every block of its whole passes, and in its last pass as many
  as bring its words nearest to the target, but one at least. The slots of all sources are dealt
  to the shards by a pseudorandom permutation of the whole output, so the counts of
  the sources in a shard are a multinomial draw, conditioned on the totals being the
  targets;
* the n-th slot of a source takes block ``permutation(n mod blocks)``, with another
  permutation for each pass over the source. Permutations are swap-or-not networks:
  bijections on any range that need no table and no sort;
* slots and blocks are joined by (source, block).

Everything is a function of the rows and SEED, so reruns agree. A source of a third
of all rows is dealt over many buckets; positions come from sums per bucket.

Defined results. A null or empty text has no words and is never taken. A null source
is a source of its own, after all others. Rows may repeat: each has its own place.
An empty table gives empty results. Other columns are kept by ``mixed_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penmark.llm.common import WORD, join_groups, stored, word_count

BLOCK = 128
SHARD_BLOCKS = 8192
SEED = 20
ROUNDS = 16
MAX_REPEATS = 3
WEIGHTS = 3
# Rows that one task orders to find their places, and slots made from one row.
BUCKET_ROWS = 5_000
SLOT_CHUNK = 8192
# Tasks that make slots, at most.
SLOT_TASKS = 1 << 14


def permuted(index: Column, size: Column, *key: Column, inverse: bool = False) -> Column:
    """Image of ``index`` under a keyed bijection on 0 .. size - 1, or under its inverse."""

    def mirror(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        swap = F.xxhash64(*key, r, F.greatest(x, other)).bitwiseAND(F.lit(1).cast("bigint")) == 1
        return F.when(swap, other).otherwise(x)

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, index, mirror)


def source_key(source: str) -> Column:
    return F.xxhash64(F.col(source), F.col(source).isNull())


def targets(sizes: DataFrame, seed: int = SEED) -> DataFrame:
    """Add weight, ``target`` and the range of output slots to one row per source.

    Sorted by the level at which they fill up, the capped sources come first, so
    the common level is the largest that a prefix of capped sources leaves.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn("rank", rank).withColumn("weight", (F.col("rank") - 1) % WEIGHTS + 1)
    cap = MAX_REPEATS * F.col("source_size")
    everything = Window.partitionBy()
    by_level = Window.orderBy(cap / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = ranked.withColumn("level", left / F.sum("weight").over(after))
    filled = level.withColumn("target", F.least(cap.cast("double"), F.max("level").over(everything) * F.col("weight")))
    # In the last pass the source's short block has its place; before it slots hold BLOCK words.
    some = F.greatest("blocks", F.lit(1).cast("bigint"))
    missing = F.col("blocks") * BLOCK - F.col("source_size")
    filled = filled.withColumn("blocks", F.ceil(F.col("source_size") / BLOCK))
    filled = filled.withColumn("pass", F.floor(F.col("target") / F.greatest("source_size", F.lit(1).cast("bigint"))))
    filled = filled.withColumn("rest", F.col("target") - F.col("pass") * F.col("source_size"))
    filled = filled.withColumn("short", permuted(some - 1, some, F.lit(seed), F.col("source_key"), F.col("pass"), inverse=True))
    plain, beyond = F.round(F.col("rest") / BLOCK), F.round((F.col("rest") + missing) / BLOCK)
    last = F.when(plain <= F.col("short"), plain).otherwise(F.least(F.greatest(F.col("short").cast("double"), beyond), F.col("blocks").cast("double")))
    n_slots = F.greatest(F.col("pass") * F.col("blocks") + last.cast("bigint"), F.least("blocks", F.lit(1).cast("bigint")))
    ends = F.sum(n_slots).over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    return (
        filled.withColumn("slots_end", ends)
        .withColumn("slots_start", F.coalesce(F.lag("slots_end").over(Window.orderBy("rank")), F.lit(0)))
        .select("source_key", "source", "n_rows", "source_size", "weight", "target", "slots_start", "slots_end", "blocks")
    )


@dataclass(frozen=True)
class Mix:
    """``sources``: sizes and targets. ``placed``: every row with its place in its
    source's stream. ``spans``: what the mix takes."""

    sources: DataFrame
    placed: DataFrame
    spans: DataFrame


def place(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    slim = stored(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("source"),
            source_key(source_col).alias("source_key"),
            F.xxhash64(text_col).alias("_text_key"),
            word_count(F.col(text_col).cast("string")).alias("size"),
        ),
        "sizes",
    )
    sizes = slim.groupBy("source_key").agg(
        F.first("source").alias("source"), F.count("*").alias("n_rows"), F.sum("size").alias("source_size")
    )
    sources = stored(targets(sizes, seed), "targets")
    n_rows = sources.agg(F.sum("n_rows")).first()[0] or 0
    buckets = n_rows // BUCKET_ROWS + 1
    dealt = slim.drop("source").withColumn("bucket", F.pmod(F.xxhash64("_id", "_text_key"), F.lit(buckets)))
    totals = dealt.groupBy("source_key", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("source_key", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("source_key", "bucket")
        .orderBy("_id", "_text_key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = dealt.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(totals, ["source_key", "bucket"]).select(
        "_id", "_text_key", "source_key", "size", (F.col("base") + F.col("within")).alias("start")
    )
    return sources, stored(placed, "placed")


def slots(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per output slot: shard, slot, source_key, block and pass over the source."""
    taking = sources.where(F.col("slots_end") > F.col("slots_start"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots_end") - F.col("slots_start") - 1, F.lit(SLOT_CHUNK).cast("bigint")))
    chunks = taking.select("source_key", "slots_start", "slots_end", "blocks", chunk.alias("first"))
    total = sources.agg(F.max("slots_end")).first()[0] or 0
    last = F.least(F.col("first") + SLOT_CHUNK, F.col("slots_end") - F.col("slots_start")) - 1
    # Chunks are small rows for many slots: a stated number of tasks, which re-planning leaves alone.
    tasks = min(total // SLOT_CHUNK + 1, SLOT_TASKS)
    dealt = chunks.repartition(tasks, "source_key", "first").select(
        "source_key", "slots_start", "blocks", F.explode(F.sequence("first", last)).alias("n")
    )
    out = permuted(F.col("slots_start") + F.col("n"), F.lit(total).cast("bigint"), F.lit(seed))
    passes = F.floor(F.col("n") / F.col("blocks"))
    block = permuted(F.col("n") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("source_key"), F.col("pass"))
    return (
        dealt.withColumn("pass", passes)
        .withColumn("_out", out)
        .select(
            F.floor(F.col("_out") / SHARD_BLOCKS).alias("shard"),
            (F.col("_out") % SHARD_BLOCKS).alias("slot"),
            "source_key",
            block.alias("block"),
            "pass",
        )
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> Mix:
    """Span rows: shard, slot, pass, source_key, the row's ``_id`` and ``start``, ``from_word`` and ``n_words``."""
    sources, placed = place(docs, id_col, text_col, source_col, seed)
    end = F.col("start") + F.col("size")
    covered = F.sequence(F.floor(F.col("start") / BLOCK), F.floor((end - 1) / BLOCK))
    pieces = placed.where(F.col("size") > 0).withColumn("block", F.explode(covered))
    begin = F.greatest(F.col("start"), F.col("block") * BLOCK)
    pieces = pieces.select(
        "source_key",
        "block",
        "_id",
        "_text_key",
        "start",
        (begin - F.col("start")).alias("from_word"),
        (F.least(end, (F.col("block") + 1) * BLOCK) - begin).alias("n_words"),
    )
    # Slots come out of a few rows per source, whose size says nothing about theirs.
    return Mix(sources, placed, slots(sources, seed).join(pieces.hint("merge"), ["source_key", "block"]))


def taken(mixed: Mix, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, size, its source's size and target, and the words taken from it."""
    sums = mixed.spans.groupBy("source_key", "start").agg(F.sum("n_words").alias("n"))
    rows = mixed.placed.join(sums, ["source_key", "start"], "left")
    sources = mixed.sources.select("source_key", "n_rows", "source_size", "target")
    joined = join_groups(rows, sources, "source_key", "n_rows", F.xxhash64("_id", "start"))
    return joined.select(
        F.col("_id").alias(id_col),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.coalesce("n", F.lit(0))).otherwise(0).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: one row per document and pass, with the words taken in that pass.

    Words keep the white space before them. All columns of ``docs`` are kept.
    """
    mixed = mix(docs, id_col, text_col, source_col)
    spans = mixed.spans.groupBy("_id", "_text_key", "source_key", "start", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "n_words"))).alias("_spans")
    )
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text_col).alias("_text_key"),
        source_key(source_col).alias("source_key"),
        F.struct(*docs.columns).alias("_row"),
    ).dropDuplicates(["_id", "_text_key", "source_key"])
    keys = ["_text_key", "source_key"]
    same = [rows["_id"].eqNullSafe(spans["_id"]), *[rows[k] == spans[k] for k in keys]]
    joined = rows.join(spans, same).select("_row", "_spans")
    # Bound as a lambda variable, the words of a text are made once for all its spans.
    tokens = F.regexp_extract_all(F.col("_row")[text_col], F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    part = lambda t, s: F.slice(t, (s["from_word"] + 1).cast("int"), s["n_words"].cast("int"))
    cut = lambda t: F.array_join(F.flatten(F.transform("_spans", lambda s: part(t, s))), "")
    text = F.transform(F.array(tokens), cut)[0]
    return joined.select(*[text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
