"""One query for each operator: production parameters, whole tables, whole texts.

The operators keep their own interfaces; a query derives the columns it returns from
what its operator gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.llm import byte_bpe, conversation_repair, exact_dedup, jaccard_join, line_crf, quality_rules, ring_sharding, source_mix, substring_dedup, suffix_dedup, token_counts, warc, whitening
from penmark.llm.common import text_or_empty

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_queries)


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


@query
def op1_quality_rules(spark, sf):
    scored, _ = quality_rules.score(table(spark, sf, "documents", "doc_id", "text"))
    return scored.select("row.doc_id", *quality_rules.FEATURES, "base_failed", "kept", "posterior")


@query
def op2_exact_dedup(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    digest = F.sha2(text_or_empty("text"), 256).alias("text_sha256")
    return exact_dedup.mark_copies(docs, carry=[digest])


PREDICT_FROM = 0.3


@query
def op3_line_crf(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 5
    labels = table(spark, sf, "labels", "doc_id", "quality").where(fold != 0)
    scored = line_crf.label_lines(docs, line_crf.fit(docs, labels))
    return scored.select(
        "doc_id",
        (fold == 0).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
        F.size("line_good").alias("n_lines"),
        F.size(F.filter("line_good", lambda p: p < 0.5)).alias("n_bad_lines"),
    )


@query
def op4_source_mix(spark, sf):
    return source_mix.taken(source_mix.mix(table(spark, sf, "documents", "doc_id", "text", "source")))


@query
def op5_jaccard_join(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return jaccard_join.similarity_groups(docs, n_words=4, threshold=(85, 100))


@query
def op6_byte_bpe(spark, sf):
    encoded = byte_bpe.encode(table(spark, sf, "documents", "doc_id", "text"))
    return byte_bpe.decode(encoded).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        byte_bpe.ids_digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_substring_dedup(spark, sf):
    return substring_dedup.shared_passages(table(spark, sf, "documents", "doc_id", "text"))


@query
def op8_warc(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    records = warc.read_archives(spark, warc.write_archives(pages), with_payload=False)
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("key").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query
def op9_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents", "doc_id", "text"))


@query
def op10_ring_sharding(spark, sf):
    placed = ring_sharding.assign(table(spark, sf, "documents", "doc_id", "text"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings", "vec_id", "embedding"))


@query
def op12_conversation_repair(spark, sf):
    return conversation_repair.repair_damaged(table(spark, sf, "conversations", "conv_id", "turn", "role", "text"))


@query
def op13_suffix_array_dedup(spark, sf):
    return suffix_dedup.remove_repeated(table(spark, sf, "documents", "doc_id", "text"))
