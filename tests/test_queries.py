"""Every registered query against its SQL on the smallest data folder."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from penmark.plans import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

WITHOUT_SQL = {
    "m3_logistic_regression",
    "m4_linear_svm",
    "m5_random_forest",
    "m6_batch_scoring",
    "m7_pca",
    "m7_m9_corpus_projection",
    "m8_boundary",
    "m9_plot_points",
    "s9_s10_model_round_trip",
    "a15_trained_model_comparison",
    "x3_stream_scoring",
    "f11_processing_time",
}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_registry_and_sql_belong_together():
    names = set(catalog.registered())
    assert set(oracle.SQL) | WITHOUT_SQL == names
    assert not set(oracle.SQL) & WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(name, spark, sf, duck):
    df = contract.queries()[name](spark, sf)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {c: kinds[t] for c, t in df.dtypes} == {d[0]: str(d[1]) for d in result.description}
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()]
    assert ordered(got) == ordered(result.fetchall())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_gives_rows(name, spark, sf):
    rows = catalog.registered()[name](spark, sf).collect()
    assert rows
    for value in rows[0]:
        assert not (isinstance(value, float) and math.isnan(value))


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["word", "count"]
    assert len(df.collect()) == 20
