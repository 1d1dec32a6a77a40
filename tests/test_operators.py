import collections
import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import plan_of
from penmark.operators import counts, evaluation, quantiles, reshape, sampling, tfidf
from penmark.plans import catalog

DOCS = [["a", "b", "a"], ["b"], [], ["a", "c", "c", "d"], ["c"], ["d", "d"]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, tokens array<string>")


# -- counts --------------------------------------------------------------------


def test_counts_over_stored_and_computed_tokens(spark, docs):
    words = {r.word: r["count"] for r in counts.word_counts(docs).collect()}
    assert words == dict(collections.Counter(w for d in DOCS for w in d))
    pairs = {r.bigram: r["count"] for r in counts.bigram_counts(docs).collect()}
    assert pairs == dict(collections.Counter(f"{x} {y}" for d in DOCS for x, y in zip(d, d[1:])))


def test_bigrams_equal_the_ngram_transformer(spark, corpus_rows):
    expected = NGram(n=2, inputCol="tokens", outputCol="g").transform(corpus_rows).select(F.explode("g").alias("bigram"))
    difference = counts.bigram_counts(corpus_rows).exceptAll(counts.group_count(expected, "bigram"))
    assert difference.count() == 0


def test_type_token_ratio(spark, docs):
    row = counts.type_token_ratio(docs).first()
    assert (row.total_tokens, row.unique_tokens, row.ttr) == (11, 4, 4 / 11)
    empty = counts.type_token_ratio(docs.where("doc_id < 0")).first()
    assert (empty.total_tokens, empty.unique_tokens, empty.ttr) == (0, 0, None)
    assert counts.type_token_ratio(docs, approximate=True).first().unique_tokens == 4


def test_counting_computes_the_tokens_once(spark, sf):
    for df in (counts.word_counts(catalog.prepared(spark, sf)), tfidf.term_statistics(catalog.prepared(spark, sf))):
        assert plan_of(df).count("regexp_replace") == 1


def test_top_breaks_ties_by_key(spark):
    rows = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "word string, count long")
    assert [r.word for r in counts.top(rows, "word", 2).collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan_of(counts.top(rows, "word", 2))


# -- reshape ---------------------------------------------------------------------


def test_long_form_scans_once_and_keeps_nulls(spark, sf):
    wide = catalog.wide(spark, sf)
    rows = reshape.to_long(wide)
    assert rows.count() == 5 * wide.count()
    assert rows.where(F.col("text").isNull()).count() == wide.where(F.col("openai_generated_abstract").isNull()).count() > 0
    assert plan_of(rows).count("FileScan") == 1
    labels = {r.label: r["count"] for r in counts.group_count(rows, "label").collect()}
    assert labels["ai"] == 4 * labels["human"]


def test_text_counts_equal_grouping_by_text(spark, tmp_path):
    texts = [None, None, "", "", "", "a", "b", "b"] + [f"text {i}" for i in range(300)] + [f"text {i * 7}" for i in range(20)]
    spark.createDataFrame([(t,) for t in texts], "text string").repartition(5).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    found = counts.text_counts(table, "text", f"{tmp_path}/digests")
    assert sorted(map(str, found.collect())) == sorted(map(str, counts.group_count(table, "text").collect()))
    none = counts.text_counts(table.where("false"), "text", f"{tmp_path}/none")
    assert none.count() == 0 and none.schema == found.schema


def test_label_counts_read_no_texts(spark, sf):
    assert "ReadSchema: struct<>" in plan_of(counts.group_count(catalog.long(spark, sf), "label"))


def test_labels(spark):
    rows = spark.createDataFrame([("ai", 1.0, 1), ("human", 0.0, 0), (None, None, None)], "l string, p double, i int")
    got = rows.select(
        reshape.label_index(F.col("l")).alias("x"), reshape.decode_prediction(F.col("p")).alias("y"), reshape.class_name(F.col("i")).alias("z")
    ).collect()
    assert [tuple(r) for r in got] == [(1, "AI", "AI"), (0, "Human", "Human"), (None, "Human", None)]


def test_strict_union_refuses_other_columns(spark, docs):
    with pytest.raises(Exception):
        reshape.union_strict(docs, docs.drop("tokens")).count()
    assert reshape.union_strict(docs, docs).count() == 2 * len(DOCS)


def test_source_key_joins_versions(spark):
    rows = spark.createDataFrame(
        [("t", "a", None, None, None), ("t", "b", None, None, None), (None, "a", "x", None, None)],
        "original_abstract string, allam_generated_abstract string, jais_generated_abstract string, "
        "llama_generated_abstract string, openai_generated_abstract string",
    )
    keys = [r.doc_id for r in reshape.with_source_key(rows).collect()]
    assert keys[0] == keys[1] != keys[2] and keys[2]


def test_blank_and_repeated_abstracts_have_keys_of_their_own(spark):
    names = ("original", "allam", "jais", "llama", "openai")
    texts = [" ", "", None, "t", "t", "t"]
    rows = spark.createDataFrame(
        [(t, f"a{i // 2}", "x", None, "x", "from_title") for i, t in enumerate(texts)],
        ", ".join(f"{n}_generated_abstract string" if n != "original" else "original_abstract string" for n in names)
        + ", generation_method string",
    )
    keyed = reshape.with_source_key(rows).collect()
    splits = {r.original_abstract: r.doc_id for r in keyed}
    # Blank, empty and missing human texts are keyed by the generated ones.
    assert keyed[0].doc_id == keyed[1].doc_id != keyed[2].doc_id and len({r.doc_id for r in keyed[3:]}) == 1
    assert len(splits) == 4 and len({r.row_key for r in keyed}) == 5 and keyed[4].row_key == keyed[5].row_key
    long = reshape.to_long(reshape.with_source_key(rows))
    assert "row_key" in long.columns and long.select("row_key", "generator").distinct().count() == 25


# -- TF-IDF -----------------------------------------------------------------------


def test_vocabulary_by_brute_force(spark, docs):
    cf = collections.Counter(w for d in DOCS for w in d)
    df = collections.Counter(w for d in DOCS for w in set(d))
    expected = sorted(((w, cf[w], df[w]) for w in cf if df[w] >= 2), key=lambda t: (-t[1], t[0]))[:3]
    assert [tuple(r) for r in tfidf.vocabulary(docs, 3, 2).collect()] == expected


def test_vocabulary_equals_the_vectoriser_without_ties_at_the_cut(spark, corpus_rows):
    ours = tfidf.vocabulary(corpus_rows, 1_000_000, 5)
    theirs = CountVectorizer(inputCol="tokens", outputCol="v", vocabSize=1_000_000, minDF=5).fit(corpus_rows)
    assert {r.term for r in ours.collect()} == set(theirs.vocabulary)


def weights(rows, terms):
    return tfidf.tfidf_rows(rows, terms, "doc_id", "generator")


def test_weights_equal_the_ml_stages(spark, corpus_rows):
    rows = corpus_rows
    terms = tfidf.with_idf(tfidf.vocabulary(rows, 200), rows)
    ranked = tfidf.collect_terms(tfidf.vocabulary(rows, 200))
    vocab = [t for t, _ in ranked]
    cv = tfidf.count_vectorizer(vocab)
    counted = cv.transform(rows)
    fitted = tfidf.idf_estimator().fit(counted)
    assert tfidf.idf_weights(ranked, rows.count()) == pytest.approx(list(fitted.idf), abs=1e-12)
    vectors = fitted.transform(counted)
    scaler, hint = tfidf.idf_scaler(list(fitted.idf), output="scaled")
    assert hint.transform(scaler.transform(vectors)).where("scaled <> tfidf_features").count() == 0
    expected = (
        vectors.select("doc_id", "generator", F.posexplode(vector_to_array("tfidf_features")).alias("i", "w"))
        .where("w <> 0")
        .withColumn("term", F.element_at(F.array(*map(F.lit, vocab)), F.col("i") + 1))
    )
    both = weights(rows, terms).join(expected, ["doc_id", "generator", "term"], "full")
    far = both.where(F.coalesce(F.abs(F.col("tfidf") - F.col("w")) > 1e-9, F.lit(True)))
    assert both.count() > 0 and far.count() == 0


def test_salted_join_equals_broadcast(spark, corpus_rows):
    rows = corpus_rows
    terms = tfidf.with_idf(tfidf.vocabulary(rows, 300), rows)
    small = weights(rows, terms)
    large = tfidf.tfidf_rows_by_shuffle(rows, terms, "doc_id", "generator", salts=4)
    assert "BroadcastHashJoin" in plan_of(small)
    assert small.count() == large.count() and small.exceptAll(large).count() == 0


# -- layout must not matter ------------------------------------------------------------


@pytest.mark.parametrize("partitions", [2, 7])
def test_results_do_not_depend_on_partitions(spark, corpus_rows, partitions):
    again = corpus_rows.repartition(partitions)

    def results(rows):
        docs = rows.where("generator = 'original'").select("doc_id")
        return [
            [tuple(r) for r in tfidf.vocabulary(rows, 50).collect()],
            [tuple(r) for r in counts.top(counts.bigram_counts(rows), "bigram", 20).collect()],
            [r.doc_id for r in sampling.seeded_sample(docs, 30, "doc_id").collect()],
            sorted((r.doc_id, r.split) for r in sampling.with_split(docs).collect()),
        ]

    assert results(again) == results(corpus_rows)


def test_split_shares_and_whole_abstracts(spark):
    rows = sampling.with_split(spark.range(40_000).withColumnRenamed("id", "doc_id"))
    share = {r.split: r["count"] / 40_000 for r in counts.group_count(rows, "split").collect()}
    assert share == pytest.approx({"train": 0.70, "validation": 0.15, "test": 0.15}, abs=0.01)


def test_sample_is_whole_when_small_and_changes_with_the_seed(spark):
    rows = spark.range(100)
    assert sampling.seeded_sample(rows, 1500, "id").count() == 100
    picks = [{r.id for r in sampling.seeded_sample(rows, 10, "id", seed=s).collect()} for s in (1, 2)]
    assert picks[0] != picks[1] and len(picks[0]) == 10


# -- evaluation -----------------------------------------------------------------------------

# Published cells and scores.
PUBLISHED = [
    ("Logistic Regression", 0.9762059973924381, 0.9765007603687138, 1185, 31, 115, 4805),
    ("Random Forest", 0.8300195567144719, 0.7745454952380361, 174, 1042, 1, 4919),
    ("Linear SVM", 0.9819100391134289, 0.9820114466351726, 1179, 37, 74, 4846),
]


@pytest.fixture(scope="module")
def published(spark):
    rows = []
    for model, _, _, tn, fp, fn, tp in PUBLISHED:
        rows += [(model, 0, 0.0, tn), (model, 0, 1.0, fp), (model, 1, 0.0, fn), (model, 1, 1.0, tp)]
    cells = spark.createDataFrame(rows, "model string, label_index int, prediction double, n int")
    return cells.select("model", "label_index", "prediction", F.explode(F.sequence(F.lit(1), "n")).alias("i"))


def test_comparison_reproduces_the_published_scores(published):
    got = {r.Model: tuple(r) for r in evaluation.compare_models(published).collect()}
    for expected in PUBLISHED:
        assert got[expected[0]][1:3] == pytest.approx(expected[1:3], abs=1e-14)
        assert got[expected[0]][3:] == expected[3:]
    f1 = {r.model: r.f1 for r in evaluation.weighted_f1(published, "model").collect()}
    accuracy = {r.model: r.accuracy for r in evaluation.accuracy(published, "model").collect()}
    for model, acc, score, *_ in PUBLISHED:
        assert (accuracy[model], f1[model]) == pytest.approx((acc, score), abs=1e-14)


@pytest.mark.parametrize("rows", [[(0, 0.0)] * 3 + [(1, 0.0)] * 2, [(0, 0.0), (1, 2.0), (2, 2.0), (2, 1.0), (0, 0.0)]])
def test_f1_and_accuracy_equal_the_evaluator(spark, rows):
    df = spark.createDataFrame(rows, "label_index int, prediction double")
    for metric, ours in (("f1", evaluation.weighted_f1(df).first().f1), ("accuracy", evaluation.accuracy(df).first().accuracy)):
        judge = MulticlassClassificationEvaluator(labelCol="label_index", predictionCol="prediction", metricName=metric)
        assert ours == pytest.approx(judge.evaluate(df), abs=1e-12)


def test_missing_cells_are_zero(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0)], "label_index int, prediction double")
    assert tuple(evaluation.confusion_cells(df).first()) == (0, 0, 0, 2)
    recall = evaluation.class_recall(evaluation.confusion_cells(df)).first()
    assert (recall.human_recall, recall.ai_recall) == (None, 1.0)


# -- quantiles ----------------------------------------------------------------------------------

GRID = (0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0)


def columns():
    rng = np.random.default_rng(5)
    return {
        "spread": rng.normal(size=5000),
        "hot": np.where(rng.random(5000) < 0.4, 7.0, rng.exponential(20, 5000)),
        "two": np.where(rng.random(5000) < 0.5, 1.0, 2.0),
        "one": np.full(3000, 3.0),
        "few": rng.integers(0, 9, 4000).astype(float),
    }


@pytest.mark.parametrize("name", list(columns()))
def test_narrowed_quantiles_are_exact(spark, name):
    values = columns()[name]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    expected = list(np.quantile(values, GRID))
    assert quantiles.quantiles(df, ["v"], GRID)["v"] == pytest.approx(expected, abs=1e-12)
    narrowed = quantiles.quantiles(df, ["v"], GRID, accuracy=100)["v"]
    assert narrowed == pytest.approx(expected, abs=1e-12)


def test_quantiles_of_nothing(spark):
    assert quantiles.quantiles(spark.createDataFrame([], "v double"), ["v"], (0.5,)) == {"v": [None]}


def test_columns_share_the_passes(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=3000), rng.exponential(size=3000)
    df = spark.createDataFrame([(float(x), float(y) if i % 3 else None) for i, (x, y) in enumerate(zip(a, b))], "a double, b double")
    got = quantiles.quantiles(df, ["a", "b"], GRID, accuracy=200)
    assert got["a"] == pytest.approx(list(np.quantile(a, GRID)), abs=1e-12)
    assert got["b"] == pytest.approx(list(np.quantile(b[np.arange(3000) % 3 > 0], GRID)), abs=1e-12)


def test_two_jobs_find_all_quantiles(spark, monkeypatch):
    df = spark.range(0, 400_000, 1, 8).select((F.col("id") * 7919 % 400_003).alias("a"), F.sqrt("id").alias("b"))
    jobs = []
    first = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: jobs.append("LocalTableScan" in plan_of(self)) or first(self))
    got = quantiles.quantiles(df, ["a", "b"], GRID)
    # What is asked of the sketches takes no job.
    assert jobs.count(False) == 2
    ids = np.arange(400_000)
    assert got["a"] == pytest.approx(list(np.quantile(ids * 7919 % 400_003, GRID)), abs=1e-9)
    assert got["b"] == pytest.approx(list(np.quantile(np.sqrt(ids), GRID)), abs=1e-9)


def test_quantiles_of_integers_and_not_a_number(spark):
    big = [2**53 + k for k in range(3000)]
    rows = [(b, float("nan") if k % 100 == 0 else float(k), 1.5) for k, b in enumerate(big)]
    got = quantiles.quantiles(spark.createDataFrame(rows, "a bigint, b double, c float"), ["a", "b", "c"], (0.0, 1.0), accuracy=64)
    assert got["a"] == [big[0], big[-1]] and got["c"] == [1.5, 1.5]
    assert got["b"][0] == 1.0 and math.isnan(got["b"][1])
    with pytest.raises(TypeError):
        quantiles.quantiles(spark.createDataFrame([("x",)], "s string"), ["s"], (0.5,))


def test_trim_keeps_both_ends(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    kept = [r.v for r in quantiles.trim_outliers(df, "v").orderBy("v").collect()]
    assert (kept[0], kept[-1], len(kept)) == (1.0, 99.0, 99)
    assert not math.isnan(kept[0])
