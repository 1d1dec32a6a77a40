import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from penmark.llm import source_mix as sm
from tests.conftest import plan_of
from tests.llm.conftest import documents


def water_filling(sizes):
    """Shares by weight; what exceeds a cap is shared anew until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 1000, 1024):
        out = spark.range(n).select(sm.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(5)).alias("p"))
        assert sorted(r.p for r in out.collect()) == list(range(n))
    moved = [r.p for r in spark.range(1000).select(sm.permuted(F.col("id"), F.lit(1000).cast("bigint"), F.lit(5)).alias("p")).collect()]
    assert sum(p == i for i, p in enumerate(moved)) < 10


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5}, {None: 7, "z": 70, "Z": 700, "é": 7000}, {"only": 12}, {"a": 0, "b": 50}])
def test_targets_equal_repeated_sharing(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size bigint")
    rows = rows.withColumn("source_key", sm.source_key("source")).withColumn("n_rows", F.lit(1))
    got = {r.source: r.target for r in sm.targets(rows).collect()}
    assert got == pytest.approx(water_filling(sizes))


def test_mix_of_the_documents(docs):
    mixed = sm.mix(docs)
    rows = sm.taken(mixed).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    target = water_filling(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 4 * sm.BLOCK
    slots = mixed.spans.groupBy("shard", "slot").agg(F.sum("n_words").alias("n"), F.countDistinct("source_key").alias("k")).collect()
    assert all(r.n <= sm.BLOCK and r.k == 1 for r in slots)
    again = sm.taken(sm.mix(docs.repartition(5))).collect()
    assert sorted(map(tuple, again)) == sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in rows)


def test_small_sources_get_their_target(spark):
    """Capped sources exactly, others to a block, none of them not at all."""
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 130, "e": 3000}
    rows = [(i, " ".join(f"{s}{k}" for k in range(n)), s) for i, (s, n) in enumerate(sizes.items())]
    got = {r.doc_id: r for r in sm.taken(sm.mix(documents(spark, rows))).collect()}
    target = water_filling(sizes)
    for i, (s, n) in enumerate(sizes.items()):
        assert got[i].taken > 0
        assert abs(got[i].taken - target[s]) <= (0 if target[s] == 3.0 * n else sm.BLOCK)
    assert got[0].taken == 30 and got[2].taken == 15 and got[3].taken == 390


def test_shards_get_their_share(spark):
    """Sources over shards as often as a multinomial draw would have it."""
    sources = spark.createDataFrame(
        [(1, 0, 3000, 2000), (2, 3000, 9000, 4000), (3, 9000, 10000, 900)],
        "source_key bigint, slots_start bigint, slots_end bigint, blocks bigint",
    )
    slots = sm.slots(sources).withColumn("part", F.floor(F.col("slot") / 1000)).where("shard = 0 and part < 8").collect()
    counts = defaultdict(Counter)
    for r in slots:
        counts[r.part][r.source_key] += 1
    for part in counts.values():
        for key, p in ((1, 0.3), (2, 0.6), (3, 0.1)):
            assert abs(part[key] - 1000 * p) < 5 * math.sqrt(1000 * p * (1 - p))
    passes = sm.slots(sources).groupBy("source_key", "pass").agg(F.count("*").alias("n"), F.countDistinct("block").alias("d")).collect()
    assert all(r.n == r.d for r in passes)


def test_mixed_documents_hold_the_words_taken(tricky, nothing):
    out = sm.mixed_documents(tricky)
    assert out.columns == tricky.columns
    rows = out.select("doc_id", "text", "class").collect()
    assert {r["class"] for r in rows} == {"x"}
    got = Counter()
    for r in rows:
        got[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    want = Counter()
    for r in sm.taken(sm.mix(tricky)).collect():
        want[r.doc_id] += r.taken
    assert +got == +want
    words = {w for r in tricky.select("text").collect() for w in (r.text or "").split()}
    assert all(w in words for r in rows if r.doc_id != 12 for w in r.text.split())
    assert sm.mixed_documents(nothing).count() == 0 and sm.taken(sm.mix(nothing)).count() == 0


def test_edge_cases_and_native_plan(tricky):
    rows = sm.taken(sm.mix(tricky)).collect()
    assert len(rows) == tricky.count()
    assert all(r.taken == 0 and r.size == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert all(r.taken <= 3 * r.size for r in rows)
    mixed = sm.mix(tricky)
    plan = plan_of(mixed.spans) + plan_of(sm.taken(mixed))
    assert "Python" not in plan and "Arrow" not in plan
