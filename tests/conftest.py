import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from penmark.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
            "penmark.scanPartitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def corpus_rows(spark, sf, tmp_path_factory):
    """The prepared corpus of the smallest data folder, stored once."""
    from penmark.plans import catalog
    from penmark.sources.corpus import write_table

    return write_table(catalog.prepared(spark, sf), str(tmp_path_factory.mktemp("corpus") / "t"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
