"""The registered queries against SQL, and the pipeline from end to end."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from penmark.llm import oracle, queries
from tests.llm.test_jaccard_join import by_brute_force


def test_every_operator_is_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(oracle.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(name, spark, sf):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    result = con.execute(oracle.SQL[name])
    columns = [d[0] for d in result.description]
    got = queries.registered()[name](spark, sf).select(columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, result.fetchall()))


def test_contract_columns(spark, sf):
    expected = {
        "op1_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op4_source_mix": {"doc_id", "size", "source_size", "target", "taken"},
        "op11_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
        "op10_ring_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    }
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = {"op11_whitening": 16 * spark.read.parquet(f"{sf}/embeddings.parquet").count()}
    for name, columns in expected.items():
        df = queries.registered()[name](spark, sf)
        assert columns <= set(df.columns) and df.count() == rows.get(name, n)


def test_pipeline(spark, sf, monkeypatch):
    between = {}

    def recorded(df, name, write=corpus_pipeline.stored):
        between[name] = write(df, name)
        return between[name]

    monkeypatch.setattr(corpus_pipeline, "stored", recorded)
    ids = corpus_pipeline.run(spark, sf)
    assert list(between) == [name for name, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good, distinct, single, mixed, last = between.values()
    assert good.columns == distinct.columns == single.columns == mixed.columns == docs.columns
    assert good.exceptAll(docs).count() == 0
    best = {}
    for r in good.collect():
        best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
    kept = {r.doc_id: r.text for r in distinct.collect()}
    assert {t: i for i, t in kept.items()} == best
    want = {c for _, _, c in by_brute_force(kept.items(), 5, (80, 100))}
    assert {r.doc_id for r in single.collect()} == want
    assert 0 < mixed.count() and last.columns == ids.columns == ["doc_id", "n_tokens", "ids"]
    assert ids.where(F.size("ids") != F.col("n_tokens")).count() == 0 and ids.count() == mixed.count()
