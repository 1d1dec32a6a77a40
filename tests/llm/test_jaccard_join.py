import random
import re
from collections import Counter, defaultdict

import numpy as np

from penmark.llm import jaccard_join as jj
from penmark.llm.components import connected_components
from penmark.llm.shingles import hash_words
from tests.llm.conftest import documents

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def by_brute_force(rows, n, threshold):
    """(id, set size, smallest id reachable) from all pairs that have an n-gram in common."""
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            where[g].append(k)
    common = Counter((a, b) for ks in where.values() for j, b in enumerate(ks) for a in ks[:j])
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), c in common.items():
        if threshold[1] * c >= threshold[0] * (len(sets[a][1]) + len(sets[b][1]) - c):
            root[find(a)] = find(b)
    best = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        if i is not None:
            best[r] = min(best.get(r, i), i)
    return sorted(((i, len(s), best.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


def joined(df, n, threshold):
    return sorted((tuple(r) for r in jj.similarity_groups(df, n_words=n, threshold=threshold).collect()), key=str)


def test_equals_all_pairs_on_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert joined(docs, 4, (85, 100)) == by_brute_force(rows, 4, (85, 100))


def test_equals_all_pairs_around_the_threshold(spark, threshold=(80, 100)):
    """Chains of edits on texts of all sizes, so that many pairs lie near the threshold."""
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for size in [3, 5, 6, 8, 12, 17, 18, 19, 21, 30, 35, 36, 40, 66, 70, 130, 140, 300]:
        for _ in range(3):
            words = rng.choices(vocabulary, k=size)
            for _ in range(6):
                rows.append((len(rows), " ".join(words), "s"))
                words = list(words)
                for _ in range(rng.randint(1, max(1, size // 60))):
                    kind, at = rng.random(), rng.randrange(len(words))
                    if kind < 0.6:
                        words[at] = rng.choice(vocabulary)
                    elif kind < 0.8:
                        words.insert(at, rng.choice(vocabulary))
                    elif len(words) > 2:
                        del words[at]
    got = joined(documents(spark, rows), 4, threshold)
    assert got == by_brute_force([r[:2] for r in rows], 4, threshold)
    assert len({c for _, _, c in got}) < len(got)


def test_large_group_of_near_copies(spark):
    """Copies of one text, each with a few words of its own, in one component without all pairs."""
    rng = random.Random(9)
    base = [f"b{rng.randrange(500)}" for _ in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(200)] = f"own{i}"
        rows.append((i, " ".join(words), "s"))
    rows += [(300 + i, f"another text {i} of its own with nothing shared at all {i * i}", "s") for i in range(50)]
    assert joined(documents(spark, rows), 4, (85, 100)) == by_brute_force([r[:2] for r in rows], 4, (85, 100))


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(0)
    for threshold in ((80, 100), (85, 100), (50, 100), (100, 100)):
        for size in [*range(1, 60), 200, 1000]:
            some = np.unique(rng.integers(0, 1 << 63, 2 * size + 5, dtype=np.uint64) * 2)
            known = np.sort(rng.choice(some, size))
            frequent = (known, rng.integers(1, 9, len(known)).astype(np.uint8))
            for order in (frequent, (known[:0], frequent[1][:0])):
                a = np.sort(some[rng.permutation(len(some))[:size]])
                gone = rng.integers(0, size + 1)
                b = np.unique(np.concatenate([a[rng.permutation(size)[: size - gone]], rng.choice(some, gone)]))
                both = len(np.intersect1d(a, b))
                linked = len(b) and threshold[1] * both >= threshold[0] * (len(a) + len(b) - both)
                met = len(b) and len(np.intersect1d(jj.keys(a, threshold, order), jj.keys(b, threshold, order)))
                assert met or not linked


def test_frequent_ngrams_come_last(spark, monkeypatch):
    """Documents that share a passage and little else are no candidates."""
    monkeypatch.setattr(jj, "SAMPLE", 1)
    passage = " ".join(f"p{i}" for i in range(100))
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(120)), "s") for i in range(60)]
    join = jj._Join(documents(spark, rows), "doc_id", "text", 5, (80, 100))
    assert join.members().count() == 0


def test_bits_keep_every_linked_pair_and_drop_others(spark, threshold=(85, 100)):
    """Linked sets pass whatever their sizes; sets of a few n-grams in common do not."""
    rng = np.random.default_rng(3)
    rows, linked = [], []
    for k in range(400):
        size = int(rng.integers(1, 1500))
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        gone = int(rng.integers(0, size // 5 + 1)) if k % 4 else len(a) - len(a) // 10
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, gone, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        linked.append(100 * both >= 85 * (len(a) + len(b) - both))
        rows.append((k, len(a), len(b), jj.parities(a).tolist(), jj.parities(b).tolist()))
    df = spark.createDataFrame(rows, "k int, n_a bigint, n_b bigint, bits_a array<bigint>, bits_b array<bigint>")
    left = {r.k for r in df.where(jj._bits_fit(threshold)).collect()}
    assert {k for k in range(400) if linked[k]} <= left and any(linked)
    assert not [k for k in left if k % 4 == 0 and rows[k][1] > 100]


def test_dissimilar_documents_of_an_ngram_are_not_compared(spark, monkeypatch):
    """No n-grams are laid out for documents that have little in common but an n-gram of their prefixes."""
    monkeypatch.setattr(jj, "MOST_FREQUENT", 0)
    rows = [(i, " ".join([f"p{j}" for j in range(30)] + [f"own{i}x{j}" for j in range(120)]), "s") for i in range(40)]
    df, compared = documents(spark, rows), []
    compare = jj._Join.compare
    monkeypatch.setattr(jj._Join, "compare", lambda self, pairs: compared.append(pairs.count()) or compare(self, pairs))
    assert joined(df, 4, (85, 100)) == by_brute_force([r[:2] for r in rows], 4, (85, 100))
    assert sum(compared) == 0


def test_crowded_ngrams_meet_in_blocks(spark, monkeypatch):
    """Several groups of near copies, and texts near the threshold, that all have n-grams in common."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for _ in range(6):
        base = passage + [f"w{rng.randrange(10**6)}" for _ in range(30)]
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"own{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words), "s"))
    expected = by_brute_force([r[:2] for r in rows], 4, (85, 100))
    for block, hubs in ((3, 1), (3, 0)):
        monkeypatch.setattr(jj, "BLOCK_CLASSES", block)
        monkeypatch.setattr(jj, "MORE_HUBS", hubs)
        assert joined(documents(spark, rows), 4, (85, 100)) == expected


def test_words_hash_alike_wherever_they_stand():
    text = ("Alpha beta\tALPHA\n" + "x" * 700_000 + " alpha ß ").encode()
    starts, hashes = hash_words(np.frombuffer(text, np.uint8))
    assert len(starts) == 6
    assert hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 4


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (50, 50)] + [(1000, 2000 + i) for i in range(300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in (3, 7, 9)} == {3}
    assert {got[2000 + i] for i in range(300)} == {1000}


def test_edge_cases(tricky, nothing):
    rows = [(r.doc_id, r.text) for r in tricky.select("doc_id", "text").collect()]
    assert joined(tricky, 5, (80, 100)) == by_brute_force(rows, 5, (80, 100))
    kept = jj.keep_one_per_group(tricky)
    assert kept.columns == tricky.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, 9, 11, 12, None}
    assert jj.keep_one_per_group(nothing).count() == 0
