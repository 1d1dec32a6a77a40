"""Pre-tokens of a corpus in blocks, and values of distinct pre-tokens joined back.

A block holds whole documents of about BLOCK_BYTES together: their ids, its distinct
pre-tokens, and the sequence of positions as numbers of those, most frequent first.
The blocks are written once, laid out by their number; every later step reads what was
written.

* Shuffle by word: a block sends each of its distinct words once, packed with the others
  of the same bucket. A bucket has the words of some prefixes, so it meets each distinct
  word of the corpus once and words with a common prefix together. No word has more
  uses than there are blocks.
* Shuffle by block: the values go back to the blocks, where they take the places of
  the words. The positions, which are most of a block, stay where they were written.

Pre-tokens are the matches of ``public_tokenizers.PATTERN``, found for all texts of a
slice at once from the classes of neighbouring characters.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from penmark.llm.common import stored_by
from penmark.llm.shingles import mixed

BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
# Text per bucket of words, and the bytes of a word that choose its bucket.
BUCKET_BYTES = 16 << 20
PREFIX_BYTES = 4

OTHER, LETTER, NUMBER, SPACE = range(4)
QUOTE, BLANK = 0x27, 0x20
# What a quote takes along as one pre-token.
SHORT = ("s", "t", "m", "d", "re", "ve", "ll")


def character_classes() -> bytes:
    """The class of every code point, one byte each, compressed."""
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
    classes = np.zeros(len(every), np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            classes[found.start() : found.end()] = kind
    return zlib.compress(classes.tobytes())


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to at most ``limit``, or of one item."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, end
        at = end


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start .. start + length - 1 of every run, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def split_texts(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Pre-tokens per text, and all of them in order."""
    joined = "".join(texts)
    char = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(char)
    ends = np.cumsum([len(t) for t in texts])
    kind = classes[char]
    first = np.zeros(n + 1, bool)  # of a text
    first[0], first[ends] = True, True
    begins = first.copy()
    begins[1:n] |= kind[1:] != kind[:-1]

    # Of white space before something else, the last character stands apart; a blank joins what follows.
    after = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n]) + 1
    begins[after - 1] = True
    begins[after[char[after - 1] == BLANK]] = False

    quotes = np.flatnonzero((char == QUOTE) & begins[:n])
    for short in SHORT:
        size = len(short) + 1
        found = quotes[quotes + size <= n]
        for k, letter in enumerate(short, 1):
            found = found[(char[found + k] == ord(letter)) & ~first[found + k]]
        begins[found + 1] = False
        begins[found + size] = True

    starts = np.flatnonzero(begins[:n])
    width = 1 + (char >= 0x80).astype(np.int32) + (char >= 0x800) + (char >= 0x10000)
    byte = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
    offsets = np.append(byte[starts], byte[n]).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
    return np.diff(np.searchsorted(starts, ends), prepend=0), tokens


def split_block(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Pre-tokens per text, their numbers in order, and the distinct pre-tokens."""
    lengths, tokens = [], []
    for at, end in slices(np.array([len(t) for t in texts]), SLICE_BYTES):
        n, found = split_texts(texts[at:end], classes)
        lengths.append(n)
        tokens.append(found)
    encoded = pa.chunked_array(tokens, pa.string()).dictionary_encode().unify_dictionaries()
    numbers = [c.indices.to_numpy(zero_copy_only=False) for c in encoded.chunks]
    words = encoded.chunk(0).dictionary if numbers else pa.array([], pa.string())
    return np.concatenate(lengths), np.concatenate(numbers) if numbers else np.empty(0, np.int32), words


def pack(lengths: np.ndarray, flat: np.ndarray) -> bytes:
    """Lists of numbers, byte planes apart so that they compress."""
    planes = [x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in (lengths.astype("<u4"), np.ascontiguousarray(flat))]
    head = np.array([len(lengths), len(flat)], "<u4").tobytes() + flat.dtype.str.encode().ljust(4)
    return head + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(data, "<u4", 2).tolist()
    kind = np.dtype(data[8:12].decode().strip())
    size = 4 * n + kind.itemsize * m
    body = np.frombuffer(pa.decompress(data[12:], size, codec="zstd", asbytes=True), np.uint8)
    lengths = body[: 4 * n].reshape(4, n).T
    flat = body[4 * n :].reshape(kind.itemsize, m).T
    return np.ascontiguousarray(lengths).view("<u4").reshape(n), np.ascontiguousarray(flat).view(kind).reshape(m)


def _offsets(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]


def pack_words(words: pa.StringArray) -> bytes:
    offsets = _offsets(words)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return pack(np.diff(offsets), data)


def unpack_words(data: bytes) -> pa.StringArray:
    lengths, flat = unpack(data)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(flat))


def buckets_of(words: pa.StringArray, n_buckets: int) -> np.ndarray:
    """By a hash of the first PREFIX_BYTES bytes."""
    offsets = _offsets(words)
    data = np.append(np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(PREFIX_BYTES, np.uint8))
    sizes = np.diff(offsets)
    prefix = np.zeros(len(words), np.uint64)
    for k in range(PREFIX_BYTES):
        prefix = prefix * np.uint64(257) + np.where(sizes > k, data[offsets[:-1] + k].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return (mixed(prefix) % np.uint64(n_buckets)).astype(np.int64)


def pretoken_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written table: block, ids, positions (packed lengths and numbers), and its words by bucket."""
    id_type = docs.schema[id_col].dataType
    ids_type = pa.list_(to_arrow_type(id_type))
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    n_buckets = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES
    packed_classes = character_classes()
    word_type = pa.list_(pa.struct([("bucket", pa.int64()), ("words", pa.binary()), ("numbers", pa.binary())]))
    names = ["block", "ids", "positions", "words"]

    def pack_block(block: int, ids: list, texts: list[str], classes: np.ndarray) -> pa.RecordBatch:
        lengths, numbers, words = split_block(texts, classes)
        order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words))
        bucket = buckets_of(words, n_buckets)
        by_word = pc.sort_indices(words).to_numpy()
        by_bucket = by_word[np.argsort(bucket[by_word], kind="stable")]
        starts = np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1))
        parts = []
        for start, end in zip(starts, [*starts[1:], len(words)]):
            chosen = by_bucket[start:end]
            packed = pack_words(words.take(pa.array(chosen)))
            parts.append({"bucket": int(bucket[chosen[0]]), "words": packed, "numbers": pack(np.empty(0), rank[chosen])})
        columns = [
            pa.array([block]),
            pa.array([ids], ids_type),
            pa.array([pack(lengths, rank[numbers])], pa.binary()),
            pa.array([parts], word_type),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.frombuffer(zlib.decompress(packed_classes), np.uint8)
        block = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    text = text or ""
                    if texts and held + len(text) > BLOCK_BYTES:
                        yield pack_block(block, ids, texts, classes)
                        ids, texts, held, block = [], [], 0, block + 1
                    ids.append(key)
                    texts.append(text)
                    held += len(text)
        if texts:
            yield pack_block(block, ids, texts, classes)

    schema = (
        f"block bigint, ids array<{id_type.simpleString()}>, positions binary, "
        "words array<struct<bucket: bigint, words: binary, numbers: binary>>"
    )
    return stored_by(rows.mapInArrow(split, schema), "pretokens", "block")


def for_distinct_words(blocks: DataFrame, compute: Callable[[pa.StringArray], pa.ListArray]) -> DataFrame:
    """Packed values of every block's words, from one computation for each distinct word.

    ``compute`` gets sorted distinct words and returns a list of numbers for each. A task
    holds one bucket at a time.
    """

    def finish(bucket: int, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        words = [unpack_words(w) for _, w in held]
        encoded = pa.concat_arrays(words).dictionary_encode()
        distinct = encoded.dictionary
        by_word = pc.sort_indices(distinct).to_numpy()
        place = np.empty(len(by_word), np.int64)
        place[by_word] = np.arange(len(by_word))
        values = compute(distinct.take(pa.array(by_word)))
        used, at, packed = place[encoded.indices.to_numpy(zero_copy_only=False)], 0, []
        for size in map(len, words):
            chosen = values.take(pa.array(used[at : at + size]))
            packed.append(pack(np.diff(_offsets(chosen)), chosen.flatten().to_numpy(zero_copy_only=False)))
            at += size
        columns = [[b for b, _ in held], [bucket] * len(held), packed]
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "bucket", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            for block, bucket, words in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held and bucket != current:
                    yield finish(current, held)
                    held = []
                current = bucket
                held.append((block, words))
        if held:
            yield finish(current, held)

    uses = blocks.select("block", F.inline(F.transform("words", lambda w: F.struct(w["bucket"], w["words"]))).alias("bucket", "words"))
    uses = uses.repartition("bucket").sortWithinPartitions("bucket")
    return uses.mapInArrow(run, "block bigint, bucket bigint, packed binary")


def reassemble(blocks: DataFrame, values: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Put the values in the places of the words, and run ``make`` on every block.

    ``make(ids, lengths, positions, counts, flat)`` yields record batches: pre-tokens per
    document, their numbers in order, and the list of each number as count and flat values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, positions, numbers, packed = (batch.column(k)[row] for k in range(4))
                lengths, order = (x.astype(np.int64) for x in unpack(positions.as_py()))
                parts = [unpack(x) for x in packed.as_py() or []]
                if not parts:
                    yield from make(ids.values, lengths, order, np.empty(0, np.int64), np.empty(0, np.int32))
                    continue
                counts = np.concatenate([c for c, _ in parts]).astype(np.int64)
                flat = np.concatenate([f for _, f in parts])
                by_number = np.argsort(np.concatenate([unpack(x)[1] for x in numbers.as_py()]))
                starts = (np.cumsum(counts) - counts)[by_number]
                counts = counts[by_number]
                yield from make(ids.values, lengths, order, counts, flat[spread(starts, counts)])

    # As many parts as the block has buckets of words.
    parts = values.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "packed"))).alias("parts"))
    rows = blocks.join(parts.hint("merge"), "block", "left")
    return rows.select("ids", "positions", "words.numbers", "parts.packed").mapInArrow(run, schema)
