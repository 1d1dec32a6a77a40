"""Byte-level BPE encoding and decoding.

Texts are split into pre-tokens with their positions; each distinct pre-token of the
whole corpus is encoded once; its ids are joined back and each document is reassembled
by position. Decoding joins ids with the table of token bytes, whose size is that of
the vocabulary, in the tasks that hold the ids.

Defined results. A null or empty text has no ids and decodes to nothing. Strings that
look like special tokens are ordinary text. Rows may repeat; null ids are kept. An
empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StructField, StructType

from penmark.llm.pretokens import for_distinct_words, pretoken_blocks, reassemble, slices, spread

# Positions that are encoded, and ids that are decoded, at a time.
MAKE_POSITIONS = 1 << 18
DECODE_IDS = 1 << 18
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x)}


def _encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})


def _encode_words(ranks: str):
    """Byte-pair merges of each pre-token as it stands, without splitting it again."""

    def compute(words: pa.StringArray) -> pa.ListArray:
        one = _encoding(ranks)._encode_single_piece
        return pa.array([one(w) for w in words.to_pylist()], pa.list_(pa.int32()))

    return compute


def _concatenate(ids_type: pa.DataType, id_col: str):
    def make(
        ids: pa.Array, lengths: np.ndarray, positions: np.ndarray, counts: np.ndarray, flat: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        starts = np.cumsum(counts) - counts
        at = 0
        # A few documents at a time, so that the indices stay small.
        for first, last in slices(lengths, MAKE_POSITIONS):
            part = positions[at : at + lengths[first:last].sum()]
            at += len(part)
            sizes = counts[part]
            tokens = flat[spread(starts[part], sizes)]
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lengths[first:last])])]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()))
            yield pa.RecordBatch.from_arrays([ids[first:last].cast(ids_type), lists], [id_col, "ids"])

    return make


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str = RANKS,
) -> DataFrame:
    """One row per document: its id and ``ids``, the token ids of its whole text."""
    blocks = pretoken_blocks(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType
    schema = f"`{id_col}` {kind.simpleString()}, ids array<int>"
    values = for_distinct_words(blocks, _encode_words(ranks))
    return reassemble(blocks, values, _concatenate(to_arrow_type(kind), id_col), schema)


def decode(encoded: DataFrame, ids_col: str = "ids", ranks: str = RANKS, out: str = "decoded") -> DataFrame:
    """``encoded`` with binary column ``out``, the bytes of its ids. Null ids give null."""
    names = [*encoded.columns, out]
    at = encoded.columns.index(ids_col)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_ranks(ranks)
        tokens = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            tokens[rank] = token
        sizes = np.array([len(t) for t in tokens])
        starts, data = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            per_row = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for first, end in slices(per_row, DECODE_IDS):
                part = batch.slice(first, end - first)
                lists = part.column(at)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                counts = sizes[ids]
                ends = np.concatenate([[0], np.cumsum(counts)])
                offsets = ends[np.concatenate([[0], np.cumsum(per_row[first:end])])].astype(np.int32)
                content = data[spread(starts[ids], counts)].tobytes()
                decoded = pa.Array.from_buffers(
                    pa.binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(content)]
                )
                decoded = pc.if_else(lists.is_valid(), decoded, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names)

    return encoded.mapInArrow(join, StructType([*encoded.schema.fields, StructField(out, BinaryType())]))


def ids_digest(ids: str = "ids"):
    """Lower-case hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)
