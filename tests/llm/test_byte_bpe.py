import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import functions as F

from penmark.llm import byte_bpe, pretokens

PIECES = [
    "'", "'s", "'re", "'ll", "'S", "'ve", " ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "ß", "1", "²", "٣", "Ⅷ", "中", "。",
    "!", "...", " ", " ", "　", "\x1c", "\x85", "​", "́", "😀", " the", "\x00", "﻿", "<|endoftext|>",
]


def random_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)] + ["", "'", " ", "\n ", "a" * 3000]


def test_splitting_equals_the_pattern():
    classes = np.frombuffer(zlib.decompress(pretokens.character_classes()), np.uint8)
    texts = random_texts(20_000)
    lengths, numbers, words = pretokens.split_block(texts, classes)
    words, pattern, at = words.to_pylist(), regex.compile(public_tokenizers.PATTERN), 0
    for text, n in zip(texts, lengths.tolist()):
        assert [words[i] for i in numbers[at : at + n]] == pattern.findall(text), text
        at += n


def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(byte_bpe.RANKS), special_tokens={}
    )


def test_ids_equal_the_library_and_decode_to_the_text(spark, docs, tricky, monkeypatch):
    monkeypatch.setattr(pretokens, "BLOCK_BYTES", 20_000)
    made = spark.createDataFrame(list(enumerate(random_texts(2000), 10_000)), "doc_id bigint, text string").repartition(4)
    rows = docs.select("doc_id", "text").union(tricky.select("doc_id", "text")).union(made)
    texts = {}
    for r in rows.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    encoding = library()
    got = byte_bpe.decode(byte_bpe.encode(rows)).withColumn("sha", byte_bpe.ids_digest()).collect()
    assert len(got) == rows.count()
    for r in got:
        text = bytes(r.decoded).decode()
        assert text in texts[r.doc_id]
        ids = encoding.encode_ordinary(text)
        assert r.ids == ids
        assert r.sha == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_edge_cases(spark, nothing):
    assert byte_bpe.decode(byte_bpe.encode(nothing)).count() == 0
    empty = spark.createDataFrame([("a", None), ("b", ""), (None, " ")], "doc_id string, text string")
    rows = {r.doc_id: r for r in byte_bpe.decode(byte_bpe.encode(empty)).collect()}
    assert rows["a"].ids == rows["b"].ids == [] and bytes(rows["a"].decoded) == b"" and bytes(rows[None].decoded) == b" "
    nulls = spark.createDataFrame([(1, None), (2, [220])], "n int, ids array<int>")
    assert [r.decoded for r in byte_bpe.decode(nulls).orderBy("n").select(F.col("decoded").isNull().alias("decoded")).collect()] == [True, False]
