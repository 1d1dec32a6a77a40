"""WARC archives: one gzip member per record, written and read record by record.

Each task writes archives of its own and reports them, so the table of paths, once
written, names exactly the complete ones: what a failed attempt left is not in it.
Reading goes through an archive once, in chunks: zlib inflates a member at a time,
the header gives the length of the block, and block and payload digests are
verified. Memory holds one record and one output batch.

Payloads of at least MIN_REVISIT bytes that occur again become revisit records of
the one with the largest id. Only payload digests are shuffled to find them; the
payloads that move are those a key filter leaves as possible repeats.

Defined results. A null payload counts as empty and is a response. A null id is
written as an empty name and read as null; null ids count as smallest. Rows that
repeat id and payload are all responses if that id is the largest. Null URLs get the
record's own name. An empty table gives no archive and no record. Records that are
cut off or whose digest differs raise an error naming archive and offset. Other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.llm.common import join_groups, key_filter, mark_possible, scratch, stored

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
# Tasks that read archives, at most.
READ_TASKS = 1 << 14
CHUNK = 1 << 18
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:page:"


def _sha1(data: bytes) -> str:
    """As WARC headers carry it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _hex(digest: str) -> str:
    return base64.b32decode(digest.partition(":")[2]).hex()


def _name(key: str | None) -> str:
    return f"<{NAME}{quote(key or '', safe='')}>"


def _key(name: str | None) -> str | None:
    return unquote(name.strip("<>").removeprefix(NAME)) or None if name else None


def encode_record(key: str | None, url: str | None, payload: bytes, revisits: str | None = None, is_revisit: bool = False) -> bytes:
    """One compressed record: an HTTP response, without its payload if it revisits another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() if is_revisit else http.encode() + payload
    name = _name(key)
    # Header values are one line each.
    target = quote(url, safe="/:?#[]@!$&'()*+,;=%~") if url else name.strip("<>")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: {_sha1(payload)}",
        f"WARC-Block-Digest: {_sha1(block)}",
    ]
    if is_revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_name(revisits)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return deflate.compress(head + block + b"\r\n\r\n") + deflate.flush()


def members(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple[int, Iterator[bytes]]]:
    """The offset of each gzip member and its content in pieces; take all pieces before the next member."""
    offset, waiting = 0, b""
    while True:
        waiting = waiting or stream.read(chunk)
        if not waiting:
            return
        inflate = zlib.decompressobj(31)
        used = 0

        def pieces() -> Iterator[bytes]:
            nonlocal waiting, used
            while not inflate.eof:
                if not waiting:
                    waiting = stream.read(chunk)
                    if not waiting:
                        raise EOFError("the archive ends inside a record")
                before = len(waiting)
                piece = inflate.decompress(waiting, chunk)
                waiting = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                used += before - len(waiting)
                if piece:
                    yield piece

        yield offset, pieces()
        offset += used


def _read_exactly(pieces: Iterator[bytes], held: bytes, n: int) -> tuple[bytes, bytes]:
    parts, have = [held], len(held)
    while have < n:
        part = next(pieces, None)
        if part is None:
            raise ValueError("the record is shorter than its Content-Length")
        parts.append(part)
        have += len(part)
    data = b"".join(parts)
    return data[:n], data[n:]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(stream: BinaryIO, where: str = "") -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """Header fields, HTTP fields and payload of each record, verified."""
    for offset, pieces in members(stream):
        try:
            held = b""
            while b"\r\n\r\n" not in held:
                piece = next(pieces, None)
                if piece is None:
                    raise ValueError("the record has no end of header")
                held += piece
            head, _, held = held.partition(b"\r\n\r\n")
            if not head.startswith(b"WARC/1."):
                raise ValueError("not a WARC record")
            fields = _fields(head)
            block, held = _read_exactly(pieces, held, int(fields["content-length"]))
            end, held = _read_exactly(pieces, held, 4)
            if end != b"\r\n\r\n" or held or next(pieces, None):
                raise ValueError("the record is longer than its Content-Length")
            if _sha1(block) != fields["warc-block-digest"]:
                raise ValueError("the block digest differs")
            http, _, payload = block.partition(b"\r\n\r\n")
            if fields["warc-type"] == "response" and _sha1(payload) != fields["warc-payload-digest"]:
                raise ValueError("the payload digest differs")
        except (ValueError, KeyError, EOFError, zlib.error) as e:
            raise ValueError(f"{where}, record at byte {offset}: {e}") from e
        yield fields, _fields(http), payload


def _write_batches(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pa.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, done, n, size = None, [], 0, 0

        def close() -> None:
            nonlocal out, n, size
            if out is not None:
                out.close()
                done.append((path, n, size))
            out, n, size = None, 0, 0

        for batch in batches:
            for key, url, payload, revisits, is_revisit in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{base}/{path.rpartition('/')[2]}", compression=None)
                size += out.write(encode_record(key, url, payload, revisits, is_revisit))
                n += 1
                if size >= archive_bytes:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["path", "n_records", "n_bytes"])

    return write


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    folder: str | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archives in ``folder``, a URI that executors can write to; returns path, n_records, n_bytes."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    long = F.octet_length("payload") >= MIN_REVISIT
    rows = rows.withColumn("digest", F.when(long, F.sha1("payload")))
    groups = rows.where("digest is not null").groupBy("digest").agg(F.count("*").alias("n"), F.max("_id").alias("keep"))
    groups = stored(groups.where("n > 1"), "payloads")
    rows = mark_possible(rows, key_filter(groups, "digest"), "possible", F.col("digest"))
    again = rows.where(F.col("possible") & F.col("digest").isNotNull()).drop("possible")
    again = join_groups(again, groups, "digest", "n", F.xxhash64("_id", "url"))
    first = rows.where(~F.col("possible") | F.col("digest").isNull()).drop("possible")
    first = first.withColumn("n", F.lit(None).cast("bigint")).withColumn("keep", F.lit(None).cast(rows.schema["_id"].dataType))
    every = again.unionByName(first).select(
        F.col("_id").cast("string").alias("key"),
        "url",
        "payload",
        F.col("keep").cast("string").alias("revisits"),
        (F.col("n").isNotNull() & ~F.col("_id").eqNullSafe(F.col("keep"))).alias("is_revisit"),
    )
    folder = folder or scratch(spark, "warc")
    if not re.match(r"\w+:/", folder):
        folder = f"file://{folder}"
    write = _write_batches(folder, archive_bytes)
    return stored(every.mapInArrow(write, "path string, n_records bigint, n_bytes bigint"), "archives")


def _read_batches(with_payload: bool):
    names = ["key", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            store, place = pa.fs.FileSystem.from_uri(path)
            with store.open_input_stream(place, compression=None) as stream:
                for fields, http, payload in records(stream, path):
                    revisit = fields["warc-type"] == "revisit"
                    rows.append(
                        (
                            _key(fields["warc-record-id"]),
                            fields["warc-type"],
                            fields["warc-target-uri"],
                            _key(fields.get("warc-refers-to")),
                            _hex(fields["warc-payload-digest"]),
                            int(http["content-length"]) if revisit else len(payload),
                            payload if with_payload and not revisit else None,
                        )
                    )
                    size += len(payload) if with_payload else 0
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema=schema)

    return read


def read_archives(spark: SparkSession, archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives named in column ``path``."""
    # Paths are small rows for much reading: a stated number of tasks, which re-planning leaves alone.
    tasks = min(max(archives.count(), 1), READ_TASKS)
    paths = archives.select("path").repartition(tasks, F.col("path"))
    return paths.mapInArrow(
        _read_batches(with_payload),
        "key string, record_type string, target_uri string, refers_to string, payload_digest string, "
        "payload_bytes bigint, payload binary",
    )
