import re
from collections import Counter

from pyspark.sql import functions as F

from penmark.llm import quality_rules as qr
from penmark.llm.common import stored
from tests.conftest import plan_of


def counts(text):
    """The base counts in plain Python."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_equal_plain_python(spark, docs, tricky):
    more = ["a a a a", "a b c a b c", "a b c d a b c", "x\nx\n \n \nx", "a b a b a b a", "#*$%&|<> b"]
    extra = spark.createDataFrame([(100 + i, t, "s") for i, t in enumerate(more)], "doc_id bigint, text string, source string")
    rows = tricky.select("doc_id", "text").union(extra.select("doc_id", "text")).union(docs.select("doc_id", "text"))
    got = qr.text_features(rows, carry=["text"]).select("row.text", *qr.FEATURES).collect()
    assert len(got) == rows.count()
    for r in got:
        assert tuple(r)[1:] == counts(r.text), r.text


def test_rules_reject_junk_and_keep_prose(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored, model = qr.score(docs)
    rows = scored.select("row.doc_id", "base_failed", "kept").join(labels, "doc_id").collect()
    prose = [r for r in rows if r.quality == 1 and not r.base_failed]
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in prose) >= 0.97 * len(prose)
    assert sum(r.kept for r in junk) <= 0.2 * len(junk)
    for name in qr.votes():
        assert all(0 < a < 1 for a in model.accuracy(name))


def test_em_finds_how_good_rules_are(spark):
    """Votes drawn from known rates on 40,000 documents."""
    right = {"r1": (0.95, 0.8), "r2": (0.9, 0.7), "r3": (0.85, 0.9), "r4": (0.97, 0.6)}
    u = lambda name: F.abs(F.xxhash64("id", F.lit(name)) % 100_000) / 100_000
    good = u("truth") < 0.8
    votes = [
        F.when(u(name) < F.when(good, a).otherwise(1 - b), 1).otherwise(-1).cast("tinyint").alias(name)
        for name, (a, b) in right.items()
    ]
    patterns = stored(spark.range(40_000).select(*votes).groupBy(*right).count(), "patterns")
    model = qr.fit(patterns, list(right))
    assert abs(model.prior - 0.8) < 0.03
    for name, (a, b) in right.items():
        found = model.accuracy(name)
        assert abs(found[0] - a) < 0.03 and abs(found[1] - b) < 0.06


def test_edge_cases_and_native_plan(tricky, nothing):
    scored, _ = qr.score(tricky, carry=tricky.columns)
    rows = scored.select("row.doc_id", "row.class", "base_failed", "kept").collect()
    assert len(rows) == tricky.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 4, 5, 11))
    assert scored.where("kept").select("row.*").columns == tricky.columns
    assert qr.keep_good(nothing).count() == 0
    plan = plan_of(qr.text_features(tricky)) + plan_of(scored)
    assert "Python" not in plan and "Arrow" not in plan
