"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad. A line's features are shares of its characters
and words, those of the lines before and after it, and whether an earlier line equals
it; two neighbouring labels have a weight of their own. Forward-backward sums give each
line's probability of being good, and a document's score is their mean, weighted by the
lengths of the lines.

Labels are given for documents only: in training, all lines of a document have its
label. The model is fitted on at most SAMPLE_DOCS labelled documents, those with the
smallest hashes of their ids; that bound is a parameter. Log-likelihood and gradient
are summed by Spark from the written features of the sample; the driver holds the
weights alone, and minimises by limited-memory BFGS.

Defined results. A document without a line with a word, or with null text, scores 0.
Without any labelled document every other score is 0.5. Rows may repeat; a document
with several labels has the smallest. Null ids are kept, scored, and never learned from.
An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from penmark.llm.common import stored
from penmark.llm.shingles import BLANKS, hash_words

SAMPLE_DOCS = 6000
ITERATIONS = 30
RIDGE = 1e-3
MEMORY = 8
LINE_FEATURES = (
    "length", "symbols", "not_letters", "capitals", "digits", "shouts", "bare_words",
    "mean_word", "same_as_before", "distinct_words", "sentence_end", "seen_line",
)
# The line, the one before, the one after, first, last, constant.
WIDTH = 3 * len(LINE_FEATURES) + 3
# And one weight for two neighbouring labels that are equal.
SIZE = WIDTH + 1


def _members(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


SYMBOLS = _members(b"#*$%&|<>{}[]=_^~@\\/+")
SHOUTS = _members(b"!?")
CAPITALS = _members(bytes(range(0x41, 0x5B)))
DIGITS = _members(b"0123456789")
LETTERS = _members(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
ENDS = _members(b".!?:;\"')")


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with a word, their lengths, and the number of such lines per text."""
    encoded = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    text_ends = np.cumsum([len(e) + 1 for e in encoded])
    line_ends = np.flatnonzero(data == 0x0A)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1])
    first_byte, words = hash_words(data)
    word_line = np.searchsorted(line_ends, first_byte)
    n_words = np.bincount(word_line, minlength=len(line_ends))
    filled = np.flatnonzero(n_words)
    if not len(filled):
        return np.empty((0, WIDTH), np.float32), np.empty(0), np.zeros(len(texts), np.int64)

    def per_line(member: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(member)])
        return (sums[line_ends] - sums[line_starts])[filled].astype(float)

    number = np.full(len(line_ends), -1)
    number[filled] = np.arange(len(filled))
    line = number[word_line]
    words_in = n_words[filled].astype(float)
    same_line = line[1:] == line[:-1]
    repeats = np.bincount(line[1:][same_line & (words[1:] == words[:-1])], minlength=len(filled))
    order = np.lexsort((words, line))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (line[order][1:] != line[order][:-1]) | (words[order][1:] != words[order][:-1])
    distinct = np.bincount(line[order][fresh], minlength=len(filled))
    # A word is bare if none of its bytes is a letter or digit.
    solid = np.concatenate([[0], np.cumsum(LETTERS[data] | DIGITS[data])])
    blank = np.flatnonzero(BLANKS[data])
    word_end = blank[np.searchsorted(blank, first_byte)]
    bare = np.bincount(line[solid[word_end] == solid[first_byte]], minlength=len(filled))
    last_word = np.searchsorted(first_byte, line_ends[filled]) - 1

    characters = per_line(~BLANKS[data])
    # Lines equal by their words in order; the sum of place-dependent hashes stands for the line.
    place = np.arange(len(words)) - (np.cumsum(words_in) - words_in).astype(np.int64)[line]
    mixed_in = words * (2 * place.astype(np.uint64) + np.uint64(1))
    starts = np.flatnonzero(np.diff(line, prepend=-1))
    content = np.add.reduceat(mixed_in, starts)
    text_of = np.searchsorted(text_ends, line_starts[filled], "right")
    order = np.lexsort((np.arange(len(filled)), content, text_of))
    seen = np.zeros(len(filled), bool)
    seen[order[1:]] = (content[order][1:] == content[order][:-1]) & (text_of[order][1:] == text_of[order][:-1])

    own = np.stack(
        [
            np.minimum(np.log1p(words_in) / 6, 1),
            np.minimum(per_line(SYMBOLS[data]) / words_in, 1),
            1 - per_line(LETTERS[data]) / characters,
            per_line(CAPITALS[data]) / characters,
            per_line(DIGITS[data]) / characters,
            np.minimum(per_line(SHOUTS[data]) / words_in, 1),
            bare / words_in,
            np.minimum(characters / words_in / 20, 1),
            repeats / words_in,
            distinct / words_in,
            ENDS[data[word_end[last_word] - 1]],
            seen,
        ],
        axis=1,
    ).astype(np.float32)
    counts = np.bincount(text_of, minlength=len(texts))
    first = np.diff(text_of, prepend=-1) != 0
    last = np.diff(text_of, append=-1) != 0
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    constant = np.ones(len(filled))
    return np.column_stack([own, before, after, first, last, constant]).astype(np.float32), characters, counts


def chain_sums(good: np.ndarray, same: float, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all documents at once.

    ``good``: each line's score for good against bad. Returns the log-partition and the
    expected number of equal neighbours per document, and each line's P(good).
    """
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    longest = int(counts.max(initial=0))
    # Lines of the documents that have a line number t, longest documents first.
    alive = np.searchsorted(-counts[order], -np.arange(longest), "left")
    state = np.stack([np.zeros_like(good), good], axis=1)
    step = np.array([[same, 0.0], [0.0, same]])
    forward, backward = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    for t in range(longest):
        at = starts[order[: alive[t]]] + t
        if t:
            reach = forward[at - 1][:, :, None] + step
            forward[at] = np.logaddexp(reach[:, 0], reach[:, 1]) + state[at]
        else:
            forward[at] = state[at]
    for t in range(longest - 2, -1, -1):
        at = starts[order[: alive[t + 1]]] + t
        reach = (backward[at + 1] + state[at + 1])[:, None, :] + step
        backward[at] = np.logaddexp(reach[:, :, 0], reach[:, :, 1])
    filled = counts > 0
    total = np.zeros(len(counts))
    ends = forward[(starts + counts - 1)[filled]]
    total[filled] = np.logaddexp(ends[:, 0], ends[:, 1])
    by_line = np.repeat(total, counts)
    probability = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - by_line, 0))
    equal = np.zeros(len(counts))
    inner = np.ones(len(good), bool)
    inner[starts[filled]] = False
    at = np.flatnonzero(inner)
    if len(at):
        both = sum(np.exp(forward[at - 1, s] + same + state[at, s] + backward[at, s] - by_line[at]) for s in (0, 1))
        equal = np.bincount(np.repeat(np.arange(len(counts)), counts)[at], both, minlength=len(counts))
    return total, equal, probability


def _loss(weights: np.ndarray):
    """Partial negative log-likelihood, gradient and number of documents of the rows of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, n = 0.0, np.zeros(SIZE), 0
        for batch in batches:
            for label, counts, held in zip(*(batch.column(k).to_pylist() for k in range(3))):
                labels, counts = np.array(label), np.array(counts)
                features = np.frombuffer(held, np.float32).reshape(-1, WIDTH).astype(float)
                lines = np.repeat(labels, counts)
                scores = features @ weights[:WIDTH]
                total, equal, probability = chain_sums(scores, weights[WIDTH], counts)
                pairs = np.maximum(counts - 1, 0)
                loss += total.sum() - scores[lines == 1].sum() - weights[WIDTH] * pairs.sum()
                gradient[:WIDTH] += features.T @ (probability - lines)
                gradient[WIDTH] += equal.sum() - pairs.sum()
                n += int((counts > 0).sum())
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([gradient.tolist()]), pa.array([n])], ["loss", "gradient", "n"])

    return run


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            part = batch.slice(start, 128)
            features, _, counts = line_features(part.column(0).to_pylist())
            columns = [pa.array([part.column(1).to_pylist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([features.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["labels", "counts", "features"])


def minimise(value, size: int, iterations: int) -> np.ndarray:
    """Limited-memory BFGS; ``value(x)`` returns the function and its gradient."""
    x = np.zeros(size)
    f, g = value(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        direction, kept = g.copy(), []
        for s, y in reversed(steps):
            a = s @ direction / (s @ y)
            kept.append(a)
            direction -= a * y
        if steps:
            s, y = steps[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(kept)):
            direction += (a - y @ direction / (s @ y)) * s
        length = 1.0 if steps else 1 / max(1.0, float(np.abs(g).sum()))
        slope = float(g @ direction)
        for _ in range(12):
            new = x - length * direction
            f_new, g_new = value(new)
            if f_new <= f - 1e-4 * length * slope:
                break
            length /= 2
        else:
            return x
        if (new - x) @ (g_new - g) > 1e-12:
            steps = [*steps, (new - x, g_new - g)][-MEMORY:]
        done = f - f_new < 1e-6 * max(1.0, abs(f))
        x, f, g = new, f_new, g_new
        if done:
            break
    return x


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
) -> np.ndarray:
    """Weights learned from at most ``sample_docs`` rows of ``labels`` and the documents with their ids."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(id_col).agg(F.min(label_col).cast("int").alias("_label"))
    sample = stored(known.orderBy(F.xxhash64(id_col), id_col).limit(sample_docs), "labelled")
    # sample has at most sample_docs rows.
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_text")).join(F.broadcast(sample), id_col)
    held = stored(
        rows.select("_text", "_label").mapInArrow(_features, "labels array<bigint>, counts array<bigint>, features binary"),
        "line-features",
    )

    def value(weights: np.ndarray) -> tuple[float, np.ndarray]:
        parts = held.mapInArrow(_loss(weights), "loss double, gradient array<double>, n bigint").collect()
        n = max(1, sum(p.n for p in parts))
        loss = sum(p.loss for p in parts) / n + RIDGE / 2 * weights @ weights
        gradient = sum((np.array(p.gradient) for p in parts), np.zeros(SIZE)) / n
        return loss, gradient + RIDGE * weights

    return minimise(value, SIZE, ITERATIONS)


def label_lines(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, and P(good) of each of its lines that has a word."""
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                features, lengths, counts = line_features(part.column(1).to_pylist())
                _, _, good = chain_sums(features @ weights[:WIDTH], weights[WIDTH], counts)
                doc = np.repeat(np.arange(len(counts)), counts)
                weight = np.bincount(doc, lengths, minlength=len(counts))
                score = np.bincount(doc, lengths * good, minlength=len(counts)) / np.maximum(weight, 1)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                lines = pa.ListArray.from_arrays(offsets, pa.array(good, pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(id_type), pa.array(np.clip(score, 0, 1)), lines], [id_col, "score", "line_good"]
                )

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"`{id_col}` {kind.simpleString()}, score double, line_good array<float>")
