"""Command line: one command per step of the work.

    spark-submit ... -m penmark prepare --raw /data/raw --workspace /data/work
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from penmark.operators import classify, counts, evaluation, sampling
from penmark.operators.reshape import with_source_key
from penmark.plans import stages
from penmark.session import build_session
from penmark.sources import corpus
from penmark.streaming import scoring


def read_raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    paths = {m: f"{args.raw}/{args.file_pattern.format(method=m)}" for m in corpus.GENERATION_METHODS}
    return corpus.scan_origins(spark, paths)


def show(title: str, df: DataFrame, rows: int = 20) -> None:
    print(f"== {title}")
    df.show(rows, truncate=100)


def explore(spark, args):
    wide = read_raw(spark, args)
    show("Columns", corpus.profile(wide), 100)
    show("Rows by generation method", counts.group_count(wide, "generation_method"))
    show("Sample", sampling.peek(wide, 5, "generation_method", corpus.HUMAN_COLUMN), 5)


def prepare(spark, args):
    wide = corpus.spread(read_raw(spark, args), args.partitions)
    table = stages.build_corpus(wide if "doc_id" in wide.columns else with_source_key(wide), args.ws)
    show("Rows", counts.row_count(table))
    show("Rows by label", counts.group_count(table, "label"))


def eda(spark, args):
    table = stages.open_table(spark, args.ws, "corpus")
    show("Rows", counts.row_count(table))
    show("Rows by label", counts.group_count(table, "label"))
    show("Top 20 words", counts.top(counts.word_counts(table), "word", 20))
    show("Top 20 bigrams", counts.top(counts.bigram_counts(table), "bigram", 20))
    show("Vocabulary richness", counts.type_token_ratio(table, approximate=args.approximate))


def word_count(spark, args):
    words = counts.word_counts(stages.open_table(spark, args.ws, "corpus"))
    corpus.write_counts_csv(counts.sorted_counts(words, "word"), args.ws.report("word_count"))
    written = corpus.read_report_csv(spark, args.ws.report("word_count"), "word string, count bigint")
    show(f"Top {args.top} words", counts.top(written, "word", args.top), args.top)


def features(spark, args):
    table = stages.build_features(
        stages.open_table(spark, args.ws, "corpus"), args.ws, keep_texts=args.keep_texts
    )
    show("Feature means by label", counts.feature_means(table))
    show("Rows by split", counts.group_count(table, "split"))


def vectors(spark, args):
    table, _ = stages.build_vectors(
        stages.open_table(spark, args.ws, "features"), args.ws, args.vocab_size, args.min_df, args.fit_scope
    )
    show("Vectors by split", counts.group_count(table, "split"))


def train(spark, args):
    table = stages.open_table(spark, args.ws, "vectors")
    feature_model = corpus.load_model(args.ws.model("features"))
    models = stages.train_models(table, feature_model, args.ws, tuple(args.models), args.balanced)
    scored = stages.store_predictions(table, models, args.ws, sampling.SPLITS[1])
    show("Validation", evaluation.compare_models(scored))
    show("Confusion counts", evaluation.confusion_counts(scored, "model"))


def evaluate(spark, args):
    models = stages.load_models(args.ws, tuple(args.models))
    scored = stages.store_predictions(stages.open_table(spark, args.ws, "vectors"), models, args.ws, sampling.SPLITS[2])
    show("Test", stages.report_comparison(scored, args.ws))
    show("Recall by class", evaluation.class_recall(evaluation.confusion_cells(scored, "model"), "model"))


def project(spark, args):
    points, line = stages.build_projection(
        stages.open_table(spark, args.ws, "vectors"),
        args.ws,
    )
    show("Points by class", counts.group_count(points, "Class"))
    show("Boundary", line.orderBy("point"), 5)


def stream(spark, args):
    model = corpus.load_model(args.ws.model(args.model))
    lines = scoring.read_lines(
        spark,
        args.input,
        max_files_per_trigger=args.max_files,
        max_file_age=args.max_file_age,
        clean_source=args.clean_source,
        archive_dir=args.archive_dir,
    )
    scored = scoring.scored_lines(scoring.featured_lines(lines, skip_blank=args.skip_blank), model)
    if args.output:
        query = scoring.write_to_table(scored, args.output, args.checkpoint, args.interval)
    else:
        query = scoring.write_to_console(scored, args.checkpoint, args.interval)
    query.awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="penmark", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    def command(run, raw: bool = False, workspace: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__.replace("_", "-"))
        sub.set_defaults(run=run)
        if raw:
            sub.add_argument("--raw", required=True, help="folder with the raw CSV of each generation method")
            sub.add_argument("--file-pattern", default="{method}.csv")
        if workspace:
            sub.add_argument("--workspace", required=True, help="shared folder for tables, models and reports")
        return sub

    command(explore, raw=True, workspace=False)
    command(prepare, raw=True).add_argument("--partitions", type=int, help="deal few unsplittable files over so many tasks")
    command(eda).add_argument("--approximate", action="store_true", help="estimate the distinct words")
    sub = command(word_count)
    sub.add_argument("--top", type=int, default=30, help="words to show; all are written")
    command(features).add_argument("--keep-texts", action="store_true")
    sub = command(vectors)
    sub.add_argument("--vocab-size", type=int, default=stages.VOCAB_SIZE)
    sub.add_argument("--min-df", type=int, default=stages.MIN_DF)
    sub.add_argument("--fit-scope", choices=("train", "all"), default="train")
    names = list(classify.CLASSIFIER_SETTINGS)
    sub = command(train)
    sub.add_argument("--models", nargs="+", choices=names, default=names)
    sub.add_argument("--balanced", action="store_true", help="weigh both classes alike")
    command(evaluate).add_argument("--models", nargs="+", choices=names, default=names)
    command(project)
    sub = command(stream)
    sub.add_argument("--input", required=True)
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--output", help="Parquet folder; without it the console")
    sub.add_argument("--model", choices=names, default=classify.LINEAR_SVM)
    sub.add_argument("--interval", default=scoring.TRIGGER_INTERVAL)
    sub.add_argument("--max-files", type=int)
    sub.add_argument("--max-file-age")
    sub.add_argument("--clean-source", choices=("archive", "delete"))
    sub.add_argument("--archive-dir")
    sub.add_argument("--skip-blank", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if "workspace" in args:
        args.ws = stages.Workspace(args.workspace.rstrip("/"))
    spark = build_session(f"penmark {args.command}")
    args.run(spark, args)


if __name__ == "__main__":
    main()
