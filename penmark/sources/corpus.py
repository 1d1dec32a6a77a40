"""Reading and writing corpora, word lists, metrics and models."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wide corpus and its three origins.
HUMAN_COLUMN = "original_abstract"
GENERATED_COLUMNS = (
    "allam_generated_abstract",
    "jais_generated_abstract",
    "llama_generated_abstract",
    "openai_generated_abstract",
)
TEXT_COLUMNS = (HUMAN_COLUMN, *GENERATED_COLUMNS)
GENERATION_METHODS = ("by_polishing", "from_title", "from_title_and_content")

# Stored bytes of texts for one task.
SPLIT_BYTES = 8 << 20

# Partitions of a table that a task writes side by side; with more of them it sorts its rows first, texts and all.
OPEN_PARTITIONS = 8
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# Half the time of the default level for a ninth more bytes.
GZIP_LEVEL = ("zlib.compress.level", "FIVE")

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

WIDE_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS]
)


def csv_headers(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header. The driver reads the first line of every file."""
    jvm, found = spark._jvm, {}
    conf = spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    for path in [paths] if isinstance(paths, str) else paths:
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(conf)
        matched = fs.globStatus(root)
        if not matched:
            raise FileNotFoundError(path)
        for top in matched:
            files = fs.listFiles(top.getPath(), True)
            base = top.getPath().toString()
            while files.hasNext():
                file = files.next().getPath()
                # Hidden files and folders are not data.
                if re.search(r"/[._]", file.toString().removeprefix(base)):
                    continue
                codec = codecs.getCodec(file)
                stream = fs.open(file)
                try:
                    content = codec.createInputStream(stream) if codec else stream
                    line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8")).readLine()
                finally:
                    stream.close()
                if line is not None:
                    header = tuple(next(csv.reader([line.removeprefix("\ufeff")])))
                    found.setdefault(header, []).append(file.toString())
    return found


def scan_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, origin: Column | None = None
) -> DataFrame:
    """RFC 4180 CSV with doubled quotes and line breaks inside fields.

    Columns are matched by the name in each file's own header, in whatever order they
    stand there: files are scanned once per distinct header. Without ``schema`` all
    columns are strings, and columns that some files lack are null there; with it the
    headers must have its names. A file whose fields hold line breaks cannot be split,
    so land large corpora as many files. ``origin``, an expression over ``_metadata``, is
    added as ``generation_method``.
    """
    types = {f.name: f.dataType for f in schema} if schema else {}
    parts = []
    for header, files in sorted(csv_headers(spark, paths).items()):
        if schema and set(header) != set(types):
            raise ValueError(f"the header {', '.join(header)} of {files[0]} does not have the columns {', '.join(types)}")
        own = T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in header])
        # Spark compares every file's header with the schema instead of trusting positions.
        reader = spark.read.schema(own).option("enforceSchema", False).option("header", True)
        part = reader.option("multiLine", True).option("quote", '"').option("escape", '"').csv(files)
        parts.append(part.withColumn("generation_method", origin) if origin is not None else part)
    if not parts:
        parts = [spark.createDataFrame([], schema or T.StructType([]))]
    rows = union_all(parts, allow_missing=True)
    order = [*(schema.names if schema else rows.columns)]
    return rows.select(*order, *[c for c in rows.columns if c not in order])


def scan_origins(spark: SparkSession, paths: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """One scan per origin, tagged with it; columns an origin lacks are null."""
    parts = [
        scan_csv(spark, path, schema).withColumn("generation_method", F.lit(method))
        for method, path in paths.items()
    ]
    return union_all(parts, allow_missing=True)


def scan_tagged_csv(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """One scan over all files; the origin is the name of a file or of a folder above it.

    Reading a file under none of the known names is an error.
    """
    path = F.col("_metadata.file_path")
    tag = "/(?:generation_method=)?(" + "|".join(GENERATION_METHODS) + r")(?:\.csv|/[^/]*)$"
    unknown = F.raise_error(F.concat(F.lit("no generation method is named by "), path)).cast("string")
    return scan_csv(spark, paths, schema, F.coalesce(F.nullif(F.regexp_extract(path, tag, 1), F.lit("")), unknown))


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal a scan of few splits over ``partitions`` tasks; None leaves it as it is.

    A CSV file with line breaks in its fields is one split, and a single task would do
    all its text work. Dealing costs one shuffle of the rows.
    """
    return df.repartition(partitions) if partitions else df


def tasks_for(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> int | None:
    """Tasks for the text work on a table, each with about ``split_bytes`` of its files; None for a table of that size.

    A text takes many times its stored size in versions and tokens, and a file of one row
    group is one split whatever its size. All cores have as many tasks.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = root.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(root).getLength()
    cores = spark.sparkContext.defaultParallelism
    return -(-size // (split_bytes * cores)) * cores if size > split_bytes else None


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    """Settings of a write: shuffles below it are deleted when it ends, and a task
    that writes several partitions keeps a file open for each instead of sorting its rows."""
    settings = {OPEN_FILES: OPEN_PARTITIONS, SHUFFLE_CLEANUP: True}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Overwrite a Parquet table and return a scan of it, which also cuts the lineage.

    The versions of one text stand close together; zstd packs what they share.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with _writing(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_wide_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """The wide corpus as gzip CSV: its versions of one text stand side by side, and no file could be split anyway."""
    writer = df.write.mode("overwrite").option("compression", "gzip").option(*GZIP_LEVEL)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with _writing(df.sparkSession):
        (
            writer
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )


def write_lines(texts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One column of texts as packed text files, one line per line of text."""
    with _writing(texts.sparkSession):
        texts.write.mode(mode).option("compression", "gzip").text(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file. Give it a frame that is already limited."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_counts_csv(counts: DataFrame, path: str) -> None:
    """All counts as CSV, in order over many files: a whole vocabulary does not fit one task."""
    counts.write.mode("overwrite").csv(path, header=True, escape='"')


def read_report_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, escape='"')


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, nulls and blank strings, all in one pass."""

    def entry(field: T.StructField):
        c = F.col(f"`{field.name}`")
        blank = (F.trim(c) == "") if isinstance(field.dataType, T.StringType) else F.lit(False)
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(c.isNull()).alias("n_null"),
            F.count_if(blank).alias("n_blank"),
        )

    return df.agg(F.array(*map(entry, df.schema.fields)).alias("entries")).select(F.inline("entries"))
