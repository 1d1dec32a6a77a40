"""Similarity join on the Jaccard similarity of word n-grams, by vertical partitioning.

The global order of n-grams is rarest first: n-grams known to be frequent come last, by
their number, and all others stand in the order of their 64-bit hashes. The frequent ones
are counted on a sample of one text in SAMPLE; the MOST_FREQUENT foremost are a table that every task has. Any
order gives the same result, this one the fewest candidates: a passage that many
documents share stands at the end, and documents meet in it only if they hold little else.

* Equal sets are one class. Everything below works on classes.
* Candidates: of two linked sets each has at least its least share of n-grams in common with
  the other, so the first n - ceil(share x n) + 1 n-grams of both in the global order
  have one in common (the prefix argument). Where the first common one stands at places i
  and j, nothing before it is common, so at most the smaller of n - i and m - j is; pairs
  for which that is too little never meet (the positional argument).
* Every class has BITS bits, each the parity of its n-grams that fall on it. Bits that differ
  between two classes stand for different n-grams of theirs, so pairs with more of them than
  linked pairs have different n-grams go before any n-grams are laid out (the bitmap argument).
* Classes with such an n-gram in common are compared with two of them, the hub and the far end,
  not each with each. For the comparison the hashes are cut into OVERLAP_FRAGMENTS fragments; a
  pair's overlap is counted in each fragment separately and summed per pair.
* Linked pairs give components. Pairs whose classes meet in an n-gram but lie in
  different components are compared as well, if their bits allow a link. So no link between
  components is missed, and the pairs inside a component are never listed. Where an n-gram
  has many classes, further ones of them first meet all others, as long as that links
  many. The rest is dealt in blocks; the blocks meet two by two, in different tasks.

Defined results. A document with fewer words than an n-gram has its whole sequence as
its only n-gram. Without words, or with null text, its set is empty and it is linked
with nothing. Null ids count as no id. Repeated rows are linked with one another. An
empty table gives an empty table. Columns of other names are kept by ``keep_one_per_group``.
Very long texts are hashed in slices; their n-grams are held as one array. Hashes of n-grams
and sets have 64 bits and are taken for what they stand for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from penmark.llm.common import discarding, filter_slots, join_groups, key_filter, mark_possible, scratch, stored
from penmark.llm.components import connected_components
from penmark.llm.shingles import mixed, ngram_sets

WORDS = 5
THRESHOLD = (80, 100)
# One text in so many is read for the frequent n-grams; those seen so often there count as
# frequent, the first MOST_FREQUENT of them.
SAMPLE = 16
LEAST_SEEN = 3
MOST_FREQUENT = 1 << 18
OVERLAP_FRAGMENTS = 4
# Pairs of one hub that are compared in one place.
HUB_PAIRS = 500
# Parities kept of a set, in words of 64. They tell sets of more than about twice as many n-grams little.
BITS = 1024
# N-grams with classes apart for several blocks get so many further hubs at most, one by one, while
# this share of the pairs with them that bits allow is linked.
MORE_HUBS = 2
LINKED_SHARE = 0.1
# Classes of one n-gram that meet those of another block in one place.
BLOCK_CLASSES = 256
# A pair on its way through the fragments: sizes, and n-grams seen so far, of both and in common.
PAIR = ["a", "b", "place", "n_a", "n_b", "overlap", "seen_a", "seen_b"]


def prefix(size: int, threshold: tuple[int, int]) -> int:
    """How many of a set's first n-grams one of every linked set's first ones is among."""
    return size + threshold[0] * size // -threshold[1] + 1


def keys(ngrams: np.ndarray, threshold: tuple[int, int], frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first n-grams of a sorted set in the global order, as hashes of their hashes."""
    need = prefix(len(ngrams), threshold)
    spread = mixed(ngrams)
    known, level = frequent
    if len(known):
        at = np.searchsorted(known, ngrams)
        at[at == len(known)] = 0
        order = np.lexsort((spread, np.where(known[at] == ngrams, level[at], 0)))
    else:
        order = np.argsort(spread)
    return spread[order[:need]].view(np.int64)


def _sampled(n_words: int):
    """Class and n-grams of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                sets = [g for g in ngram_sets(batch.column(0).slice(start, 256).to_pylist(), n_words) if len(g)]
                held = pa.array([g.view(np.int64) for g in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([class_of(g) for g in sets], pa.int64()), held], ["class", "ngrams"])

    return run


def frequent_ngrams(docs: DataFrame, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and levels of the n-grams that many different sets of a sample have."""
    sample = docs.where(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(SAMPLE)) == 0)
    sets = sample.select("text").mapInArrow(_sampled(n_words), "class bigint, ngrams array<bigint>").dropDuplicates(["class"])
    counts = sets.select(F.explode("ngrams").alias("ngram")).groupBy("ngram").agg(F.count("*").alias("n"))
    # MOST_FREQUENT rows at most, whatever the corpus.
    rows = counts.where(F.col("n") >= LEAST_SEEN).orderBy(F.desc("n"), "ngram").limit(MOST_FREQUENT).collect()
    known = np.array([r.ngram for r in rows], np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], np.array([int(r.n).bit_length() for r in rows], np.uint8)[order]


def _sketch(id_type, n_words: int, threshold: tuple[int, int], frequent):
    names = ["id", "n", "class", "bits", "keys"]
    kinds = [id_type, pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, classes, bits, found = [], [], [], []
                for ngrams in ngram_sets(part.column(1).to_pylist(), n_words):
                    sizes.append(len(ngrams))
                    classes.append(class_of(ngrams) if len(ngrams) else None)
                    bits.append(parities(ngrams) if len(ngrams) else None)
                    found.append(keys(ngrams, threshold, frequent.value) if len(ngrams) else [])
                columns = [part.column(0).to_pylist(), sizes, classes, bits, found]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=schema)

    return run


def class_of(ngrams: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        content = mixed(ngrams).sum(dtype=np.uint64) + np.uint64(len(ngrams))
    return int(mixed(np.array([content], np.uint64)).view(np.int64)[0])


def parities(ngrams: np.ndarray) -> np.ndarray:
    """Whether an odd number of the n-grams falls on each of BITS places, as words."""
    odd = np.bincount((ngrams & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _segments(n_words: int):
    """class, fragment and the segment's n-grams, for the overlap counts."""
    names = ["class", "fragment", "ngrams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                classes, fragments, held = [], [], []
                for ngrams in ngram_sets(batch.column(0).slice(start, 256).to_pylist(), n_words):
                    if not len(ngrams):
                        continue
                    own = class_of(ngrams)
                    cuts = np.searchsorted(ngrams >> np.uint64(32), np.arange(OVERLAP_FRAGMENTS + 1) * (1 << 32) // OVERLAP_FRAGMENTS)
                    for k in range(OVERLAP_FRAGMENTS):
                        classes.append(own)
                        fragments.append(k)
                        held.append(ngrams[cuts[k] : cuts[k + 1]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(fragments, pa.int32()), pa.array(held, pa.binary())], names)

    return run


def _add_overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with the overlap of their two segments, and these segments' sizes, added to what they had."""
    for batch in batches:
        both, of_a, of_b = [], [], []
        for x, y in zip(batch.column("ngrams"), batch.column("others")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            every = np.concatenate([x, y])
            every.sort(kind="stable")
            both.append(int(np.count_nonzero(every[1:] == every[:-1])))
            of_a.append(len(x))
            of_b.append(len(y))
        added = {"overlap": both, "seen_a": of_a, "seen_b": of_b}
        summed = [
            pa.array(batch.column(c).to_numpy() + np.array(added[c], np.int64)) if c in added else batch.column(c) for c in PAIR
        ]
        yield pa.RecordBatch.from_arrays(summed, PAIR)


def _fit(a: Column, b: Column) -> Column:
    """Whether neither of two classes is larger than the other may be linked with."""
    return (a["n"] <= b["reach"]) & (b["n"] <= a["reach"])


def _bits_fit(threshold: tuple[int, int]) -> Column:
    """Whether the bits of the pair's classes differ in no more places than linked sets have different n-grams."""
    num, den = threshold
    words = [F.bit_count(F.col("bits_a")[k].bitwiseXOR(F.col("bits_b")[k])) for k in range(BITS // 64)]
    differ = reduce(Column.__add__, words).cast("bigint")
    return (den + num) * differ <= (den - num) * (F.col("n_a") + F.col("n_b"))


class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, n_words: int, threshold: tuple[int, int]):
        self.docs, self.n_words, self.threshold = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), n_words, threshold
        kind = docs.schema[id_col].dataType
        schema = f"id {kind.simpleString()}, n bigint, class bigint, bits array<bigint>, keys array<bigint>"
        self.sizes = self.segments = None
        frequent = docs.sparkSession.sparkContext.broadcast(frequent_ngrams(self.docs, n_words))
        self.sets = stored(self.docs.mapInArrow(_sketch(to_arrow_type(kind), n_words, threshold, frequent), schema), "sets")

    def reach(self):
        """The largest partner that a class may have whose first common n-gram is at this place."""
        num, den = self.threshold
        return F.floor((F.col("n") - F.col("pos")) * (num + den) / num + 1e-9) - F.col("n")

    def members(self) -> DataFrame:
        path = scratch(self.sets.sparkSession, "members")
        with discarding(self.sets.sparkSession):
            return stored(self._members(), "members", path)

    def _members(self) -> DataFrame:
        """key, class, n, reach: classes that meet in an n-gram of their prefixes and may be linked by
        their sizes and the places of the n-gram; and two of them, ``hub`` (the smallest set) and ``far``."""
        uses = self.sets.select("class", "n", F.posexplode("keys").alias("pos", "key"))
        uses = uses.select("key", "class", "n", self.reach().alias("reach"))
        shared = uses.groupBy("key").agg(
            F.min("class").alias("low"), F.max("class").alias("high"), F.min("n").alias("least"), F.max("reach").alias("most"), F.count("*").alias("uses")
        )
        shared = stored(shared.where("low != high").drop("low", "high"), "shared-keys")
        slots = filter_slots(shared.count())
        uses = mark_possible(uses, key_filter(shared, "key", slots=slots), "possible", F.col("key"), slots=slots)
        uses = uses.where("possible").drop("possible").distinct()
        met = join_groups(uses, shared, "key", "uses", F.xxhash64("class")).where("least <= reach and n <= most")
        met = stored(met.select("key", "class", "n", "reach"), "met")
        one = lambda *first: F.struct(*first, *[c for c in ("class", "n", "reach") if c not in first])
        ends = met.groupBy("key").agg(
            F.min(one("n", "class")).alias("hub"), F.min(one("class")).alias("low"), F.max(one("class")).alias("high"), F.count("*").alias("uses")
        )
        hub = F.struct(*[F.col("hub")[c].alias(c) for c in ("class", "n", "reach")])
        far = F.when(F.col("hub")["class"] == F.col("high")["class"], F.col("low")).otherwise(F.col("high"))
        ends = ends.where(F.col("low")["class"] != F.col("high")["class"]).select("key", hub.alias("hub"), far.alias("far"), "uses")
        # Of two classes it is known already whether they may be linked.
        ends = stored(ends.where((F.col("uses") > 2) | _fit(F.col("hub"), F.col("far"))), "ends")
        return join_groups(met, ends, "key", "uses", F.xxhash64("class")).where("hub is not null").drop("uses")

    def describe(self, *classes: DataFrame) -> None:
        """An id, size and bits of the classes that have none yet."""
        wanted = reduce(DataFrame.union, classes).toDF("class").distinct()
        if self.sizes is not None:
            wanted = wanted.join(self.sizes, "class", "left_anti")
        # All rows of a class have the same size and bits.
        rows = self.sets.where("class is not null").select("class", "id", "n", "bits").join(wanted, "class", "left_semi")
        one = rows.groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
        sizes = stored(one, "sizes")
        self.sizes = sizes if self.sizes is None else self.sizes.union(sizes)

    def possible(self, pairs: DataFrame) -> DataFrame:
        """a, b, n_a, n_b of the pairs whose sizes and bits allow a link."""
        num, den = self.threshold
        of = lambda x: self.sizes.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
        hubs = stored(pairs.groupBy("b").agg(F.count("*").alias("pairs")).join(of("b"), "b"), "hubs")
        both = join_groups(pairs.join(of("a"), "a"), hubs, "b", "pairs", F.xxhash64("a"))
        near = both.where((den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")) & _bits_fit(self.threshold))
        return stored(near.select("a", "b", "n_a", "n_b"), "near")

    def prepare(self, *pairs: DataFrame) -> None:
        """Segments for overlap counts, of the classes in the pairs that have none yet."""
        ends = [p.select(F.col(c).alias("class")) for p in pairs for c in ("a", "b")]
        wanted = reduce(DataFrame.union, ends).distinct()
        if self.segments is not None:
            wanted = wanted.join(self.segments.select("class"), "class", "left_anti")
        wanted = stored(self.sizes.select("class", "id").join(wanted, "class"), "wanted")
        # Only the documents that stand for a class here are read again.
        slots = filter_slots(wanted.count())
        docs = mark_possible(self.docs, key_filter(wanted, "id", slots=slots), "possible", F.col("id"), slots=slots)
        docs = docs.where("possible").select("text")
        segments = docs.mapInArrow(_segments(self.n_words), "class bigint, fragment int, ngrams binary")
        needed = segments.join(wanted.select("class"), "class", "left_semi")
        segments = stored(needed.dropDuplicates(["class", "fragment"]), "segments")
        self.segments = segments if self.segments is None else self.segments.union(segments)

    def compare(self, pairs: DataFrame) -> DataFrame:
        """a, b of the linked pairs, from pairs with their sizes.

        One job per fragment, which frees its shuffles before the next one. Pairs that cannot
        be linked any more, whatever the fragments to come hold, go.
        """
        num, den = self.threshold
        per_hub = stored(pairs.groupBy("b").agg(F.count("*").alias("pairs")), "pairs-per-hub")
        near = join_groups(pairs, per_hub, "b", "pairs", F.xxhash64("a"))
        # A hub's segments are laid out once for every HUB_PAIRS pairs it is in.
        near = near.withColumn("place", F.pmod(F.xxhash64("a", F.lit(3)), F.ceil(F.col("pairs") / HUB_PAIRS)))
        zero = F.lit(0).cast("bigint")
        near = stored(near.drop("pairs").withColumns({"overlap": zero, "seen_a": zero, "seen_b": zero}).select(PAIR), "pairs")
        schema = ", ".join(f"{c} bigint" for c in PAIR)
        most = F.col("overlap") + F.least(F.col("n_a") - F.col("seen_a"), F.col("n_b") - F.col("seen_b"))
        for k in range(OVERLAP_FRAGMENTS):
            part = self.segments.where(F.col("fragment") == k).drop("fragment")
            left = near.join(part.withColumnRenamed("class", "a"), "a")
            right = near.select("b", "place").distinct().join(part.select(F.col("class").alias("b"), F.col("ngrams").alias("others")), "b")
            summed = left.join(right, ["b", "place"]).select(*PAIR, "ngrams", "others").mapInArrow(_add_overlap, schema)
            near = stored(summed.where(den * most >= num * (F.col("n_a") + F.col("n_b") - most)), "pairs")
        union = F.col("n_a") + F.col("n_b") - F.col("overlap")
        return near.where(den * F.col("overlap") >= num * union).select("a", "b")

    def links(self) -> DataFrame:
        """class, component of the classes that are linked with another one."""
        path = scratch(self.sets.sparkSession, "linked")
        with discarding(self.sets.sparkSession):
            return stored(self._links(), "linked", path)

    def _links(self) -> DataFrame:
        members = self.members()
        stars = []
        for end in (F.col("hub"), F.col("far")):
            may = _fit(F.struct("n", "reach"), end) & (F.col("class") != end["class"])
            stars.append(members.where(may).select(F.col("class").alias("a"), end["class"].alias("b")))
        stars = [stored(star.distinct(), "star") for star in stars]
        self.describe(*[star.select(c) for star in stars for c in ("a", "b")])
        stars = [self.possible(star) for star in stars]
        self.prepare(*stars)
        links = self.compare(stars[0])
        found = connected_components(links)
        # Again with the other end of each key's classes, where the star left components apart.
        apart = stored(_across(stars[1], found), "star")
        if apart.limit(1).count():
            links = links.union(self.compare(apart))
            found = connected_components(links)
        # Whatever may be linked with a key's hub or far end has met it.
        others = members.where((F.col("class") != F.col("hub")["class"]) & (F.col("class") != F.col("far")["class"]))
        rows = self._apart(others, found)
        for _ in range(MORE_HUBS):
            star, left = self._crowded(rows)
            if not star.limit(1).count():
                break
            self.describe(star.select("a"), star.select("b"))
            near = self.possible(star)
            self.prepare(near)
            more = self.compare(near)
            n_more = more.count()
            if n_more:
                links = links.union(more)
                found = connected_components(links)
            rows = self._apart(left, found)
            if not n_more or n_more < LINKED_SHARE * near.count():
                break
        self.describe(rows.select("class"))
        rest = stored(self._between(rows), "rest")
        if rest.limit(1).count():
            self.prepare(rest)
            found = connected_components(links.union(self.compare(rest)))
        return found

    def _apart(self, rows: DataFrame, found: DataFrame) -> DataFrame:
        """The rows of keys whose classes lie in different components, with component and the key's classes."""
        labelled = rows.select("key", "class", "n", "reach").join(found.withColumnRenamed("node", "class"), "class", "left")
        rows = stored(labelled.withColumn("component", F.coalesce("component", "class")), "labelled-keys")
        per_key = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("classes"))
        per_key = stored(per_key.where("low != high").select("key", "classes"), "keys-apart")
        return stored(join_groups(rows, per_key, "key", "classes", F.xxhash64("class")).where("classes is not null"), "labelled-keys")

    def _crowded(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs of one class of each key of several blocks with the others it may be linked with, and the rows without it."""
        first = F.struct(F.xxhash64("class"), "class", "n", "reach", "component")
        hubs = rows.where(F.col("classes") > BLOCK_CLASSES).groupBy("key").agg(F.min(first).alias("hub"), F.count("*").alias("uses"))
        both = stored(join_groups(rows, stored(hubs, "ends"), "key", "uses", F.xxhash64("class")), "labelled-keys")
        hub = F.col("hub")
        may = _fit(F.struct("n", "reach"), hub) & (F.col("component") != hub["component"])
        star = stored(both.where(may).select(F.col("class").alias("a"), hub["class"].alias("b")).distinct(), "star")
        return star, both.where(hub.isNull() | (F.col("class") != hub["class"]))

    def _between(self, rows: DataFrame) -> DataFrame:
        """a, b, n_a, n_b: pairs that meet in a key, lie in different components and may still be linked."""
        rows = rows.join(self.sizes.select("class", "bits"), "class")
        blocks = F.ceil(F.col("classes") / BLOCK_CLASSES)
        rows = rows.withColumn("last", blocks - 1).withColumn("block", F.pmod(F.xxhash64("class", F.lit(7)), blocks))
        zero = F.lit(0).cast("bigint")
        of = lambda x: [F.col(c).alias(c if c == "key" else f"{c}_{x}") for c in ("key", "class", "component", "n", "reach", "bits")]
        left = rows.select(*of("a"), F.col("block").alias("i"), F.explode(F.sequence("block", "last")).alias("j"))
        right = rows.select(*of("b"), F.explode(F.sequence(zero, F.col("block"))).alias("i"), F.col("block").alias("j"))
        may = (F.col("component_a") != F.col("component_b")) & ((F.col("i") < F.col("j")) | (F.col("class_a") < F.col("class_b")))
        may &= (F.col("n_a") <= F.col("reach_b")) & (F.col("n_b") <= F.col("reach_a"))
        met = left.join(right, ["key", "i", "j"]).where(may & _bits_fit(self.threshold))
        swap = F.col("class_a") > F.col("class_b")
        ends = {c: F.when(swap, F.col(other)).otherwise(F.col(own)) for c, own, other in [
            ("a", "class_a", "class_b"), ("b", "class_b", "class_a"), ("n_a", "n_a", "n_b"), ("n_b", "n_b", "n_a")
        ]}
        return met.select(*[value.alias(c) for c, value in ends.items()]).distinct()


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose two classes are not in the same component."""
    a = found.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
    per_b = pairs.groupBy("b").agg(F.count("*").alias("n"))
    per_b = stored(per_b.join(found.select(F.col("node").alias("b"), F.col("component").alias("c_b")), "b", "left"), "ends")
    both = join_groups(pairs.join(a, "a", "left"), per_b, "b", "n", F.xxhash64("a"))
    return both.where(F.coalesce(F.col("c_a"), F.col("a")) != F.coalesce(F.col("c_b"), F.col("b"))).select(pairs.columns)


def similarity_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id it is linked with, directly or not).

    Documents are linked if ``threshold[1] * intersection >= threshold[0] * union``.
    """
    join = _Join(docs, id_col, text_col, n_words, threshold)
    found = join.links().withColumnRenamed("node", "class")
    per_class = join.sets.where("class is not null").groupBy("class").agg(F.min("id").alias("id"), F.count("*").alias("n_rows"))
    grouped = per_class.join(found, "class", "left")
    alone = grouped.where("component is null and n_rows > 1").select("class", "n_rows", F.col("id").alias("component_id"))
    linked = stored(grouped.where("component is not null"), "linked-classes")
    smallest = linked.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("n_classes"))
    linked = join_groups(linked, stored(smallest, "components"), "component", "n_classes", F.xxhash64("class"))
    groups = stored(alone.unionByName(linked.select("class", "n_rows", "component_id")), "groups")
    rows = join_groups(join.sets.select("id", "n", "class"), groups, "class", "n_rows", F.xxhash64("id"))
    own = F.when(F.col("n_rows").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one_per_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """The documents without those that are linked with one of a smaller id."""
    groups = similarity_groups(docs, id_col, text_col, n_words, threshold)
    gone = stored(groups.where(f"`{id_col}` != component_id").select(F.col(id_col).alias("_gone")).distinct(), "near-copies")
    # Only what may be a near copy meets the list of them in a shuffle.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_id"))
    rows = mark_possible(rows, key_filter(gone, "_gone"), "_possible", F.col("_id"))
    checked = rows.where("_possible").join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    return rows.where("not _possible").select("_row.*").unionByName(checked.select("_row.*"))
