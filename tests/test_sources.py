import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penmark import session
from penmark.operators import counts
from penmark.sources import corpus, tables

TRICKY = [
    (1, 'says "hi", twice', " lead and trail ", "line\nbreak", None, "x"),
    (2, "plain", "a,b", '"', "ي\nى", None),
]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "wide")
    df = spark.createDataFrame(TRICKY, corpus.WIDE_SCHEMA)
    corpus.write_wide_csv(df, path)
    back = corpus.scan_csv(spark, path, corpus.WIDE_SCHEMA)
    assert sorted(map(tuple, back.collect())) == TRICKY


def test_wide_csv_is_packed(spark, tmp_path):
    """Versions of one text in a row, in all folders: a tenth of their size at most, and the same rows again."""
    text = [" ".join(f"w{i * k % 997}" for k in range(200)) for i in range(60)]
    rows = [(i, t, t + " x", "y " + t, t, t, corpus.GENERATION_METHODS[i % 3]) for i, t in enumerate(text)]
    df = spark.createDataFrame(rows, T.StructType([*corpus.WIDE_SCHEMA, T.StructField("generation_method", T.StringType())]))
    corpus.write_wide_csv(df.drop("generation_method").coalesce(1), f"{tmp_path}/wide")
    corpus.write_wide_csv(df.coalesce(1), f"{tmp_path}/by_method", partition_by="generation_method")
    for folder in ("wide", "by_method"):
        files = [f for f in (tmp_path / folder).rglob("part-*")]
        assert files and all(f.name.endswith(".csv.gz") for f in files)
        assert sum(f.stat().st_size for f in files) < 0.15 * sum(len(c) for r in rows for c in r[1:6])
        back = corpus.scan_csv(spark, f"{tmp_path}/{folder}", corpus.WIDE_SCHEMA).collect()
        assert sorted(map(tuple, back)) == [r[:6] for r in rows]


def test_byte_order_mark_and_doubled_quotes(spark, tmp_path):
    path = tmp_path / "by_polishing.csv"
    path.write_text('﻿original_abstract,extra\n"He said ""no""\nand left",7\n', encoding="utf-8")
    df = corpus.scan_csv(spark, str(path))
    assert df.columns == ["original_abstract", "extra"]
    assert df.first().original_abstract == 'He said "no"\nand left'


def test_wrong_header_is_refused(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("doc_id,wrong_name,a,b,c,d\n1,x,x,x,x,x\n")
    with pytest.raises(Exception):
        corpus.scan_csv(spark, str(path), corpus.WIDE_SCHEMA).collect()


def test_origins_with_missing_columns(spark, tmp_path):
    (tmp_path / "by_polishing.csv").write_text("original_abstract,openai_generated_abstract\nh1,o1\n")
    (tmp_path / "from_title.csv").write_text("original_abstract\nh2\n")
    paths = {m: str(tmp_path / f"{m}.csv") for m in ("by_polishing", "from_title")}
    rows = {r.original_abstract: r for r in corpus.scan_origins(spark, paths).collect()}
    assert rows["h1"].openai_generated_abstract == "o1" and rows["h1"].generation_method == "by_polishing"
    assert rows["h2"].openai_generated_abstract is None and rows["h2"].generation_method == "from_title"


def test_one_scan_tags_files_and_folders(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, corpus.WIDE_SCHEMA)
    corpus.write_wide_csv(df, str(tmp_path / "from_title"))
    (tmp_path / "by_polishing.csv").write_text(",".join(corpus.WIDE_SCHEMA.names) + "\n9,a,b,c,d,e\n")
    paths = [str(tmp_path / "from_title"), str(tmp_path / "by_polishing.csv")]
    tagged = corpus.scan_tagged_csv(spark, paths, corpus.WIDE_SCHEMA)
    assert {(r.doc_id, r.generation_method) for r in tagged.collect()} == {
        (1, "from_title"),
        (2, "from_title"),
        (9, "by_polishing"),
    }


def test_report_is_one_file(spark, tmp_path):
    path = str(tmp_path / "report")
    corpus.write_report_csv(spark.range(10).repartition(4), path)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert corpus.read_report_csv(spark, path, "id long").count() == 10


def test_partitioned_table_reads_one_split(spark, tmp_path):
    rows = spark.range(10).withColumn("split", F.when(F.col("id") < 4, "train").otherwise("test"))
    table = corpus.write_table(rows, str(tmp_path / "t"), "split")
    scan = table.where("split = 'train'")
    assert len(scan.inputFiles()) > 0 and scan.count() == 4
    assert "PartitionFilters: [isnotnull(split" in scan._jdf.queryExecution().executedPlan().toString()


def test_profile_counts_nulls_and_blanks(spark):
    df = spark.createDataFrame([(1, "a"), (2, " "), (None, None)], "n int, s string")
    got = {r.column_name: tuple(r)[1:] for r in corpus.profile(df).collect()}
    assert got == {"n": ("int", 3, 1, 0), "s": ("string", 3, 1, 1)}


def test_spreading_is_the_callers_choice(spark, sf):
    one_file = tables.read_table(spark, sf, "documents", "doc_id")
    assert corpus.spread(one_file, None) is one_file
    assert corpus.spread(one_file, 6).rdd.getNumPartitions() == 6


def test_headers_in_other_orders_keep_their_labels(spark, tmp_path):
    (tmp_path / "a.csv").write_text('original_abstract,allam_generated_abstract\nhuman1,"allam\n1"\n')
    (tmp_path / "b.csv").write_text('allam_generated_abstract,"original_abstract"\nallam2,human2\n')
    (tmp_path / "c.csv").write_text("original_abstract\nhuman3\n")
    (tmp_path / "_hidden.csv").write_text("x\n1\n")
    rows = sorted(tuple(r) for r in corpus.scan_csv(spark, str(tmp_path)).select(corpus.HUMAN_COLUMN, "allam_generated_abstract").collect())
    assert rows == [("human1", "allam\n1"), ("human2", "allam2"), ("human3", None)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("original_abstract", "allam_generated_abstract")])
    rows = sorted(tuple(r) for r in corpus.scan_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema).collect())
    assert rows == [("human1", "allam\n1"), ("human2", "allam2")]
    with pytest.raises(ValueError, match="c.csv"):
        corpus.scan_csv(spark, str(tmp_path / "c.csv"), schema)


def test_unknown_origin_is_refused(spark, tmp_path):
    (tmp_path / "elsewhere").mkdir()
    (tmp_path / "elsewhere" / "x.csv").write_text("original_abstract\nt\n")
    with pytest.raises(Exception, match="no generation method"):
        corpus.scan_tagged_csv(spark, [str(tmp_path / "elsewhere")]).collect()


def test_lists_and_sizes_are_what_they_are_stated_to_be(sf, spark):
    """Counted here by hand, as queries and SQL share the lists."""
    from penmark.functions import lexicon as lx

    assert (len(lx.STREAM_STOP_WORDS), len(lx.FOLD_FROM), len(lx.FOLD_TO)) == (37, 7, 7)
    assert (len(corpus.TEXT_COLUMNS), len(corpus.GENERATION_METHODS), len(tables.MARKER_WORDS)) == (5, 3, 10)


def test_derived_corpus_exercises_the_rules(spark, sf, corpus_rows):
    assert counts.row_count(corpus_rows).first().n_rows == 1000
    row = corpus_rows.agg(
        F.count_if(F.col("text").isNull()).alias("nulls"),
        F.count_if(F.col("text").contains("ـ")).alias("tatweel"),
        F.count_if(F.size("tokens") > 0).alias("tokens"),
    ).first()
    assert min(row) > 0


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def last_plan(spark):
    executed = spark._jsparkSession.sharedState().statusStore().executionsList()
    return executed.apply(executed.size() - 1).physicalPlanDescription()


def test_partitions_are_written_without_sorting_the_rows(spark, tmp_path):
    """A sort by partition holds and spills whole texts."""
    rows = [(i, *[f"{i} {c}" for c in corpus.TEXT_COLUMNS], corpus.GENERATION_METHODS[i % 3] if i % 4 else None) for i in range(40)]
    df = spark.createDataFrame(rows, T.StructType([*corpus.WIDE_SCHEMA, T.StructField("generation_method", T.StringType())])).repartition(2)
    table = corpus.write_table(df, f"{tmp_path}/t", partition_by="generation_method")
    assert "Sort" not in last_plan(spark)
    assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))
    corpus.write_wide_csv(df, f"{tmp_path}/csv", partition_by="generation_method")
    assert "Sort" not in last_plan(spark)
    assert spark.conf.get(corpus.OPEN_FILES, None) in (None, "0")


def test_more_partitions_than_open_files_are_all_written(spark, tmp_path):
    df = spark.range(0, 400, 1, 2).selectExpr("id", "id % 25 AS part")
    table = corpus.write_table(df, f"{tmp_path}/t", partition_by="part")
    assert sorted((r.id, r.part) for r in table.collect()) == [(i, i % 25) for i in range(400)]


def test_every_core_has_as_many_tasks(spark, tmp_path):
    spark.range(20000).selectExpr("id", "md5(string(id)) AS text").coalesce(1).write.parquet(f"{tmp_path}/t")
    cores = spark.sparkContext.defaultParallelism
    for parts in (3, 7, 20):
        size = sum(p.stat().st_size for p in (tmp_path / "t").iterdir() if p.name.startswith("part-"))
        assert corpus.tasks_for(spark, f"{tmp_path}/t", size // parts) % cores == 0
