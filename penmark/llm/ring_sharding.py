"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

A document's place on the ring is the hash of its text, so equal texts stand
together. Each shard has VIRTUAL_NODES places on the ring and owns the stretch
before each of them. A shard takes bytes up to its capacity, SLACK above the mean;
what does not fit continues clockwise to the next virtual node whose shard has
room. So no shard exceeds its capacity by more than one document, and adding a
shard moves little besides what the new one takes.

The ring has CELLS cells. Bytes per cell are summed by Spark; walking the ring
needs only that table of at most CELLS rows, which gives every shard stretches of
bytes inside cells. Documents then look up the stretch of their own offset in their
cell. A cell with many rows (a text that a third of all rows share) is dealt over
parts by id, so no task orders more than about one PARTS-th of all rows.

Defined results. A null or empty text has the size of an empty one. Repeated rows
have places of their own; ties in the order are between equal rows. An empty table
gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penmark.llm.common import stored, text_or_empty

SHARDS = 40
VIRTUAL_NODES = 64
CELLS = 1 << 14
SLACK = 0.001
ROW_BYTES = 16
# More parts than cells there are at most; a part of LEAST_ROWS is not worth dealing.
PARTS = 1 << 15
LEAST_ROWS = 256


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """Sorted (cell, shard): the virtual nodes, each at the end of a cell."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            cell = int.from_bytes(digest, "big") % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


def walk(loads: list[tuple[int, int]], nodes: list[tuple[int, int]], shards: int, slack: float = SLACK) -> list[tuple[int, int, int]]:
    """Stretches (cell, first byte, shard) for (cell, bytes) in ring order.

    A stretch ends where the next one of its cell begins. ``loads`` has at most one
    entry per cell of the ring.
    """
    total = sum(size for _, size in loads)
    room = [-(-total * (1 + slack) // shards)] * shards
    cells = [cell for cell, _ in nodes]
    clockwise: dict[int, list[int]] = {}

    def order(node: int) -> list[int]:
        if node not in clockwise:
            following = (nodes[(node + k) % len(nodes)][1] for k in range(len(nodes)))
            clockwise[node] = list(dict.fromkeys(following))
        return clockwise[node]

    stretches = []
    for cell, size in loads:
        done = 0
        for shard in order(bisect_left(cells, cell) % len(nodes)):
            if room[shard] <= 0:
                continue
            part = min(room[shard], size - done)
            stretches.append((cell, int(done), shard))
            room[shard] -= part
            done += part
            if done >= size:
                break
    return stretches


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, and slot, its gapless number in the shard."""
    spark: SparkSession = docs.sparkSession
    text = text_or_empty(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("_id"),
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("place"),
        ).withColumn("cell", F.pmod(F.xxhash64("place"), F.lit(CELLS)).cast("int")),
        "ring-rows",
    )
    # At most CELLS rows, whatever the corpus.
    cells = rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("cell").collect()
    most = max(LEAST_ROWS, sum(c.n for c in cells) // PARTS)
    parts = [(c.cell, -(-c.n // most)) for c in cells if c.n > most]
    split = F.broadcast(spark.createDataFrame(parts, "cell int, parts bigint"))
    dealt = rows.join(split, "cell", "left").withColumn(
        "part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("_id", F.lit(1)), F.col("parts"))).cast("int")
    ).drop("parts")

    # Offsets of the parts inside their cell: as many rows as there are parts.
    per_part = dealt.groupBy("cell", "part").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("cell", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("cell", "part").orderBy("place", "_id", "size", "text_crc32")
    offset = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = dealt.withColumn("within", offset).withColumn("rank", F.row_number().over(inside))
    ordered = ordered.join(F.broadcast(bases), ["cell", "part"])
    ordered = ordered.withColumn("offset", F.col("base") + F.col("within"))

    stretches: dict[int, list[tuple[int, int]]] = {}
    for cell, first, shard in walk([(c.cell, c.bytes) for c in cells], ring(shards), shards):
        stretches.setdefault(cell, []).append((first, shard))
    plan = spark.createDataFrame(
        [(cell, [{"first": a, "shard": b} for a, b in found]) for cell, found in stretches.items()],
        "cell int, stretches array<struct<first: bigint, shard: int>>",
    )
    # The last stretch that begins at or before the document's middle byte.
    middle = F.col("offset") + F.shiftright("size", 1)
    chosen = F.element_at(F.filter("stretches", lambda s: s["first"] <= middle), -1)
    placed = ordered.join(F.broadcast(plan), "cell").withColumn("shard", chosen["shard"])
    placed = stored(placed.select("_id", "size", "text_crc32", "shard", "cell", "part", "rank"), "ring-places")

    # A part's rows go to a shard in one run of ranks.
    runs = placed.groupBy("shard", "cell", "part").agg(F.count("*").alias("n"), F.min("rank").alias("first_rank"))
    earlier = Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "shard", "cell", "part", "first_rank", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("slot_base")
    )
    return placed.join(F.broadcast(runs), ["shard", "cell", "part"]).select(
        F.col("_id").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("slot_base") + F.col("rank") - F.col("first_rank")).alias("slot"),
    )
