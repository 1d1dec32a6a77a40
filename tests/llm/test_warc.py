import gzip
import hashlib
import io
from pathlib import Path

import pyarrow.fs  # noqa: F401
import pytest

from penmark.llm import warc

PAGES = [
    (1, "http://a/ö x", "p" * 1000),
    (2, "http://b", "p" * 1000),
    (3, "http://c", "p" * 999),
    (4, "http://d", "p" * 999),
    (5, None, None),
    (6, "http://e\r\nInjected: 1", "é" * 500),
    (6, "http://e", "é" * 500),
    (7, "u", "é" * 500 + "!"),
    (None, "n", "p" * 1000),
    (None, None, ""),
    (8, "big", "lorem ipsum " * 200_000),
]


def table(spark, rows, n=3):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, digest string, key string").repartition(n)


def expected(rows):
    best = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000:
            best.setdefault(h, []).append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = best.get(h, [])
        keep = max((x for x in same if x is not None), default=None)
        again = len(same) > 1 and i != keep
        out.append((str(i) if i is not None else None, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", str(keep) if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes", [1, 1 << 30])
def test_round_trip(spark, tmp_path, archive_bytes):
    archives = warc.write_archives(table(spark, PAGES), folder=str(tmp_path / "w"), archive_bytes=archive_bytes)
    read = warc.read_archives(spark, archives).collect()
    got = sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read), key=str)
    assert got == expected(PAGES)
    texts = {(h or "").encode() for _, _, h in PAGES}
    assert {bytes(r.payload) for r in read if r.record_type == "response"} == texts
    assert all(r.payload is None for r in read if r.record_type == "revisit")
    files = list((tmp_path / "w").glob("*.warc.gz"))
    assert len(files) == archives.count() and sum(r.n_records for r in archives.collect()) == len(PAGES)
    # Any reader of gzip sees the same bytes, and no header was smuggled in.
    content = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert content.count(b"WARC/1.1\r\n") == len(PAGES) and b"\r\nInjected" not in content


def test_each_record_is_a_member_of_its_own():
    parts = [warc.encode_record(str(i), "u", b"x" * n) for i, n in enumerate((0, 10, 500_000))]
    stream = io.BytesIO(b"".join(parts))
    offsets = [(at, sum(map(len, pieces))) for at, pieces in warc.members(stream, chunk=100)]
    assert [at for at, _ in offsets] == [0, len(parts[0]), len(parts[0]) + len(parts[1])]
    read = list(warc.records(io.BytesIO(b"".join(parts))))
    assert [len(p) for _, _, p in read] == [0, 10, 500_000]


@pytest.mark.parametrize("damage", ["cut", "digest", "length", "junk"])
def test_damage_is_reported(damage):
    good = warc.encode_record("1", "u", b"payload")
    text = gzip.decompress(good)
    bad = {
        "cut": good[:-20],
        "digest": gzip.compress(text.replace(b"payload", b"pAyload")),
        "length": gzip.compress(text.replace(b"payload", b"payloads")),
        "junk": gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"),
    }[damage]
    with pytest.raises(ValueError, match=f"archive, record at byte {len(good)}"):
        list(warc.records(io.BytesIO(good + bad), "archive"))


def test_empty_table(spark):
    assert warc.read_archives(spark, warc.write_archives(table(spark, []))).count() == 0


def test_archives_lie_in_the_shared_folder(spark):
    path = warc.write_archives(table(spark, PAGES[:2])).first().path
    shared = spark.conf.get("spark.checkpoint.dir")
    assert Path(path.removeprefix("file://")).is_relative_to(shared.removeprefix("file://"))
