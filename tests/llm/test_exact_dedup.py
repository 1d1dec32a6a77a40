import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from penmark.llm import exact_dedup
from penmark.llm.common import text_or_empty
from tests.llm.conftest import PROSE, documents


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        ((i, hashlib.sha256((t or "").encode()).hexdigest(), best[t or ""], len(groups[t or ""]), i == best[t or ""]) for i, t in rows),
        key=str,
    )


def marked(df):
    digest = F.sha2(text_or_empty("text"), 256).alias("text_sha256")
    return sorted((tuple(r) for r in exact_dedup.mark_copies(df, carry=[digest]).collect()), key=str)


def test_equals_plain_grouping(docs, tricky):
    for df in (docs, tricky):
        assert marked(df) == expected([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_texts_that_differ_late_are_not_copies(spark):
    base = "p" * 500
    rows = [(i, base + str(i % 3), "s") for i in range(12)] + [(20, base + "\0", "s"), (21, base + " ", "s")]
    assert marked(documents(spark, rows)) == expected([r[:2] for r in rows])


def test_one_hot_group(spark):
    rows = [(i, PROSE if i % 3 == 0 else f"text {i}", "s") for i in range(3000)]
    assert marked(documents(spark, rows, 7)) == expected([r[:2] for r in rows])


def test_keep_distinct(tricky, nothing):
    kept = exact_dedup.keep_distinct(tricky)
    assert kept.columns == tricky.columns
    rows = kept.collect()
    texts = [r.text or "" for r in rows]
    assert len(texts) == len(set(texts)) == len({r.text or "" for r in tricky.collect()})
    assert {r.doc_id for r in rows if (r.text or "") == PROSE} == {7}
    assert exact_dedup.keep_distinct(nothing).count() == 0 and marked(nothing) == []
