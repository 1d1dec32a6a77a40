import pytest

# Names that the operators use inside.
CLASHING = ["keep_id", "kept", "key", "id", "n", "class", "size", "digest", "row", "place", "cell", "shard", "filter_slot"]

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PROSE = " ".join(f"word{i * i % 251} goes" for i in range(60))

TRICKY = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n\x0b\r ", "b"),
    (4, "one", None),
    (5, "one", None),
    (6, PROSE, "b"),
    (6, PROSE, "b"),
    (7, PROSE, "a"),
    (8, PROSE.upper(), "c"),
    (None, PROSE, None),
    (None, None, None),
    (9, LONG, "a"),
    (10, LONG + " end", "a"),
    (11, "x" * 5000, "c"),
    (12, "naïve ✓ 中文 😀 the end\n\n\nagain\n", "c"),
    (13, PROSE + "\n" + PROSE, "d"),
]


def documents(spark, rows, partitions=3):
    """Rows of (doc_id, text, source) with further columns whose names clash."""
    df = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], _schema())
    return df.repartition(partitions)


def _schema():
    return "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)


@pytest.fixture(scope="session")
def tricky(spark):
    return documents(spark, TRICKY)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
