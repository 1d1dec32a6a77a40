"""What the plans of the registered queries must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from penmark.operators import counts, evaluation, tfidf
from penmark.plans import catalog, oracle


# The projection multiplies vectors in Arrow batches.
WITH_ARROW = {"m7_projected_rows", "m7_certificate"}


@pytest.mark.parametrize("name", sorted(set(oracle.SQL) - WITH_ARROW))
def test_no_python_and_no_cross_join(name, spark, sf):
    plan = plan_of(catalog.registered()[name](spark, sf))
    assert not re.search(r"EvalPython|MapIn|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize(
    "build",
    [counts.word_counts, counts.bigram_counts, tfidf.term_statistics, lambda df: counts.group_count(df, "label")],
)
def test_groups_are_combined_before_the_single_shuffle(build, corpus_rows):
    plan = plan_of(build(corpus_rows))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")


def test_counting_reads_only_the_tokens(corpus_rows):
    for df in (counts.word_counts(corpus_rows), tfidf.vocabulary(corpus_rows), counts.type_token_ratio(corpus_rows)):
        assert re.findall(r"ReadSchema: (\S+)", plan_of(df)) == ["struct<tokens:array<string>>"]


def test_weights_need_no_shuffle_of_the_corpus(spark, corpus_rows, tmp_path):
    path = str(tmp_path / "terms")
    tfidf.with_idf(tfidf.vocabulary(corpus_rows, 100), corpus_rows).write.parquet(path)
    plan = plan_of(tfidf.tfidf_rows(corpus_rows, spark.read.parquet(path), "doc_id", "generator"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_comparison_is_one_aggregate(spark, sf):
    scored = catalog.rule_predictions(spark, sf)
    assert plan_of(evaluation.compare_models(scored)).count("partial_count") >= 1
    assert plan_of(evaluation.compare_models(scored)).count("Exchange hashpartitioning(model") == 1


def test_one_word_in_a_third_of_all_places(spark):
    """A hot word reaches the shuffle as one row per task, whatever its count."""
    rows = spark.range(0, 3000, 1, 6).select(
        F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id") % 50), F.concat(F.lit("v"), F.col("id"))).alias("tokens")
    )
    got = {r.word: r["count"] for r in counts.top(counts.word_counts(rows), "word", 51).collect()}
    assert got["hot"] == 3000 and sum(got.values()) == 6000
    stats = {r.term: (r.cf, r.df) for r in tfidf.vocabulary(rows, 51, 2).collect()}
    assert stats["hot"] == (3000, 3000) and stats["w7"] == (60, 60)


@pytest.mark.parametrize("name", ["a3_word_count", "a7_feature_means", "a8_idf", "a9_vocabulary", "t1_top_20_words", "t3_sorted_word_count", "s5_word_count_csv"])
def test_words_are_counted_without_storing_the_corpus(name, spark, sf, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(catalog.stages, "write_table", lambda df, path, *a: written.append(path))
    monkeypatch.setattr(catalog.corpus, "write_table", lambda df, path, *a: written.append(path))
    monkeypatch.setattr(catalog.Stored, "_made", {})
    assert catalog.registered()[name](spark, sf).columns and not written


def test_streamed_lines_are_compared_by_digest(spark, sf, monkeypatch):
    """Grouping and joining by the text itself shuffled every line three times."""
    texts = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0)], "text string, prediction double")
    monkeypatch.setattr(catalog, "_scored_stream", lambda spark, sf: texts)
    plan = plan_of(catalog.x3_stream_equals_batch(spark, sf))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["line"] and "Join" not in plan
