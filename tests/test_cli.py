import os

import pytest

from penmark import __main__ as cli
from penmark.sources import corpus


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Three CSV files without a row key, one of them without a column."""
    folder = tmp_path_factory.mktemp("raw")
    words = ["قمر", "شمس", "بحر", "جبل", "نهر", "ورد", "كتاب"]
    for n, method in enumerate(corpus.GENERATION_METHODS):
        columns = list(corpus.TEXT_COLUMNS if n else corpus.TEXT_COLUMNS[:-1])
        lines = [",".join(columns)]
        for i in range(60):
            cells = [
                f'"{words[i % 7]} {words[(i * k) % 7]} {words[i // 7 % 7]}, {"كتبت بنفسي" if k == 0 else "تهدف الدراسة"}\nسطر {i}"'
                for k in range(len(columns))
            ]
            lines.append(",".join(cells))
        (folder / f"{method}.csv").write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def test_every_step_from_raw_files_to_scored_stream(spark, raw, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda *_: spark)
    ws = str(tmp_path / "ws")
    cli.main(["explore", "--raw", raw])
    cli.main(["prepare", "--raw", raw, "--workspace", ws])
    cli.main(["eda", "--workspace", ws])
    cli.main(["word-count", "--workspace", ws, "--top", "5"])
    cli.main(["features", "--workspace", ws])
    cli.main(["vectors", "--workspace", ws, "--vocab-size", "30"])
    cli.main(["train", "--workspace", ws])
    cli.main(["evaluate", "--workspace", ws])
    cli.main(["project", "--workspace", ws])
    shown = capsys.readouterr().out
    for title in ("Columns", "Rows by generation method", "Top 20 bigrams", "Vocabulary richness", "Validation", "Test", "Boundary"):
        assert f"== {title}" in shown
    assert spark.read.parquet(f"{ws}/tables/corpus").count() == 5 * 180
    assert sorted(os.listdir(f"{ws}/tables/vectors"))[-3:] == ["split=test", "split=train", "split=validation"]
    assert spark.read.csv(f"{ws}/reports/word_count", header=True).count() > 5

    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "x.txt").write_text("كتبت بنفسي\n", encoding="utf-8")
    queries = []
    monkeypatch.setattr(cli.scoring, "write_to_table", _stopping(cli.scoring.write_to_table, queries))
    cli.main(["stream", "--workspace", ws, "--input", str(inbox), "--checkpoint", str(tmp_path / "ck"), "--output", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def _stopping(start, queries):
    def wrapped(*args):
        query = start(*args)
        query.processAllAvailable()
        query.stop()
        queries.append(query)
        return query

    return wrapped
