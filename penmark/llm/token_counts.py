"""Token counts under a unigram model, from one dynamic program over a trie.

The pieces are a vocabulary's tokens; a piece of rank r has the log probability
-ln(r + 1) less the logarithm of the sum of all 1 / (r + 1). The distinct pre-tokens
of the corpus are sorted, which is the order of a depth-first walk through their
trie: a task keeps the forward scores of the current path only, and a prefix that
pre-tokens share is scored once. The count of the best segmentation is stored where a
pre-token ends, joined back to the blocks, and summed per document.

Of segmentations with equal scores the one with fewer pieces counts. Every single byte
is a piece, so every text has a segmentation.

Defined results. A null or empty text has no pre-token, no token and score 0. Rows may
repeat; null ids are kept. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from penmark.llm.byte_bpe import RANKS, load_ranks
from penmark.llm.pretokens import for_distinct_words, pretoken_blocks, reassemble


def unigram_scores(path: str) -> dict[bytes, float]:
    ranks = load_ranks(path)
    total = math.log(math.fsum(1 / (rank + 1) for rank in ranks.values()))
    return {token: -math.log(rank + 1) - total for token, rank in ranks.items()}


class TrieWalk:
    """Forward scores along the path from the root to the last pre-token."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.path = b""
        # After each prefix: (score, -pieces) of its best segmentation.
        self.best: list[tuple[float, int]] = [(0.0, 0)]

    def visit(self, word: bytes) -> tuple[int, float]:
        """Count and score of a pre-token; only what follows the shared prefix is computed."""
        shared = 0
        for a, b in zip(self.path, word):
            if a != b:
                break
            shared += 1
        del self.best[shared + 1 :]
        self.path = word
        for end in range(shared + 1, len(word) + 1):
            found = (-math.inf, 0)
            for start in range(max(0, end - self.longest), end):
                score = self.scores.get(word[start:end])
                if score is not None:
                    before = self.best[start]
                    found = max(found, (before[0] + score, before[1] - 1))
            self.best.append(found)
        score, pieces = self.best[-1]
        return -pieces, score


def _count_words(ranks: str):
    """Count and score of sorted distinct pre-tokens, along one walk through their trie."""

    def compute(words: pa.StringArray) -> pa.ListArray:
        trie = TrieWalk(unigram_scores(ranks))
        return pa.array([trie.visit(w.encode()) for w in words.to_pylist()], pa.list_(pa.float64()))

    return compute


def _sum(ids_type: pa.DataType, id_col: str):
    def make(ids: pa.Array, lengths: np.ndarray, positions: np.ndarray, counts: np.ndarray, flat: np.ndarray):
        ends = np.cumsum(lengths)
        columns = [ids.cast(ids_type), pa.array(lengths.astype(np.int64))]
        for each, kind in ((flat[0::2], np.int64), (flat[1::2], np.float64)):
            total = np.concatenate([[0], np.cumsum(each[positions])])
            columns.append(pa.array((total[ends] - total[ends - lengths]).astype(kind)))
        yield pa.RecordBatch.from_arrays(columns, [id_col, "n_pretokens", "n_tokens", "score"])

    return make


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str = RANKS,
) -> DataFrame:
    """One row per document: its id, n_pretokens, n_tokens and the score of its best segmentation."""
    blocks = pretoken_blocks(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType
    schema = f"`{id_col}` {kind.simpleString()}, n_pretokens bigint, n_tokens bigint, score double"
    values = for_distinct_words(blocks, _count_words(ranks))
    return reassemble(blocks, values, _sum(to_arrow_type(kind), id_col), schema)
