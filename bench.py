"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from penmark.plans import catalog
from penmark.session import build_session

HEADLINE = (
    "t1_top_20_words",
    "t2_top_20_bigrams",
    "a3_word_count",
    "a4_bigram_count",
    "a6_type_token_ratio",
    "a7_feature_means",
    "a8_tfidf",
    "a9_vocabulary",
    "a13_weighted_f1",
    "a15_model_comparison",
    "f5_clean_text",
    "f6_tokens",
    "f8_entity_diversity",
    "p3_wide_to_long",
    "p9_range_trim",
    "s1_csv_scan",
    "s4_parquet_sink",
    "s11_profile",
    "t5_seeded_sample",
    "t6_hash_split",
    "x2_stream_features",
    "m3_logistic_regression",
    "m4_linear_svm",
    "m5_random_forest",
    "m6_batch_scoring",
    "m7_m9_corpus_projection",
    "x3_stream_scoring",
    "x6_stream_restart",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(2 * int(cpus)),
            catalog.SCAN_PARTITIONS: cpus,
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = catalog.registered()

    def run(name: str) -> None:
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # One untimed run starts the executor threads and compiles the text code.
    run("f6_tokens")

    seconds = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    # Tables that several queries read are timed on their own.
    timed("token_table", lambda: catalog.Stored.get(spark, sf_dir).tokens)
    timed("feature_table", lambda: catalog.Stored.get(spark, sf_dir).featured)
    timed("vector_table", lambda: catalog.Stored.get(spark, sf_dir).vectors)
    for name in HEADLINE:
        timed(name, lambda: run(name))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
