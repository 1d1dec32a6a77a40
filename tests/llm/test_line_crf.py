import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.llm import line_crf as crf


def by_enumeration(good, same, counts):
    totals, equals, marginals, at = [], [], [], 0
    for n in counts:
        scores = good[at : at + n]
        weights, agree, on = [], [], []
        for labels in itertools.product((0, 1), repeat=n):
            pairs = sum(a == b for a, b in zip(labels, labels[1:]))
            weights.append(np.exp(scores @ np.array(labels) + same * pairs) if n else 1.0)
            agree.append(pairs)
            on.append(labels)
        p = np.array(weights) / sum(weights)
        totals.append(np.log(sum(weights)))
        equals.append(p @ np.array(agree))
        marginals += list(p @ np.array(on, float).reshape(len(p), n))
        at += n
    return totals, equals, marginals


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    counts = np.array([3, 0, 1, 6, 2, 0, 5])
    good = rng.normal(size=counts.sum()) * 2
    for same in (-1.0, 0.0, 1.7):
        for got, want in zip(crf.chain_sums(good, same, counts), by_enumeration(good, same, counts)):
            assert got == pytest.approx(want, abs=1e-9)


def test_gradient_is_the_slope():
    import pyarrow as pa

    features, _, counts = crf.line_features(["Good line here.\nAnother one.", "### *** !!\nok", "", "x"])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[1, 0, 1, 0]]), pa.array([counts.tolist()]), pa.array([features.tobytes()], pa.binary())],
        ["labels", "counts", "features"],
    )
    weights = np.random.default_rng(1).normal(size=crf.SIZE)

    def value(w):
        row = next(crf._loss(w)(iter([batch]))).to_pylist()[0]
        return row["loss"], np.array(row["gradient"])

    _, gradient = value(weights)
    for k in range(0, crf.SIZE, 3):
        step = np.zeros(crf.SIZE)
        step[k] = 1e-5
        assert (value(weights + step)[0] - value(weights - step)[0]) / 2e-5 == pytest.approx(gradient[k], abs=1e-4)


def test_line_features_see_neighbours_and_repeats():
    features, lengths, counts = crf.line_features(["a b\n\n  \n###\na b", None, "A!"])
    assert counts.tolist() == [3, 0, 1]
    assert lengths.tolist() == [2, 3, 2, 2]
    width = len(crf.LINE_FEATURES)
    seen, symbols = crf.LINE_FEATURES.index("seen_line"), crf.LINE_FEATURES.index("symbols")
    assert features[:, seen].tolist() == [0, 0, 1, 0]
    assert features[0, 2 * width + symbols] == features[2, width + symbols] == 1
    assert features[:, 3 * width].tolist() == [1, 0, 0, 1] and features[:, 3 * width + 1].tolist() == [0, 0, 1, 1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    weights = crf.fit(docs, labels.where(fold != 0))
    scored = crf.label_lines(docs, weights).join(labels.where(fold == 0), "doc_id").collect()
    right = sum((r.score >= 0.3) == (r.quality == 1) for r in scored)
    assert right >= 0.95 * len(scored)
    lines = crf.label_lines(docs.where("doc_id = 0"), weights).first().line_good
    assert all(0 <= p <= 1 for p in lines)


def test_edge_cases(tricky, nothing, spark):
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (None, 1), (9, None)], "doc_id bigint, quality int")
    weights = crf.fit(tricky, labels)
    rows = crf.label_lines(tricky, weights).collect()
    assert len(rows) == tricky.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert [r.score for r in rows if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert not crf.fit(tricky, labels.where("false")).any() and not crf.fit(nothing, labels).any()
    assert {r.score for r in crf.label_lines(tricky, np.zeros(crf.SIZE)).collect() if r.doc_id == 6} == {0.5}
    assert crf.label_lines(nothing, weights).count() == 0
