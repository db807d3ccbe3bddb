"""WARC writer and splittable reader against a sequential reader of whole files."""

import base64
import gzip
import hashlib
import random
import zlib

import pandas as pd
import pytest

from roadcast.llm.warc import archives, page_records, read_archives, write_archives
from roadcast.session import scratch_path

from .helpers import SF, table

PAGES = "page_id long, url string, html string, path string, offset long, PAYLOAD string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 3, "x") for r in rows], PAGES)


def brute(rows):
    """(page_id, html) rows -> sorted result rows."""
    held = {}
    for i, h in rows:
        held.setdefault((h or "").encode(), []).append(i)
    out = []
    for body, ids in held.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        known = [i for i in ids if i is not None]
        for i in ids:
            again = bool(known) and i != min(known)
            out.append((i, len(body), digest, "revisit" if again else "response", min(known) if again else None))
    return sorted(out, key=str)


def got(df):
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def sequential(path):
    """Members of a whole file, one after the other: (offset, inflated bytes)."""
    data, at = open(local(path), "rb").read(), 0
    while at < len(data):
        z = zlib.decompressobj(31)
        body = z.decompress(data[at:])
        yield at, body
        at = len(data) - len(z.unused_data)


def test_given_table(spark):
    p = pd.read_parquet(f"{SF}/pages.parquet")
    assert got(page_records(table(spark, "pages"))) == brute(list(zip(p.page_id.tolist(), p.html)))


@pytest.mark.parametrize("split", [7, 1000, 1 << 20])
def test_any_range_size_finds_every_record_once(spark, split):
    rng = random.Random(split)
    rows = [(i, f"http://h/{i}", "".join(chr(rng.choice([rng.randrange(32, 127), 233, 0x1F])) for _ in range(rng.randrange(200))))
            for i in range(20 if split == 7 else 120)]
    files = write_archives(pages(spark, rows), archive_bytes=4000)
    if split == 7:                   # hundreds of ranges: one small archive will do
        files = spark.createDataFrame(files.orderBy("length").limit(1).collect(), files.schema)
    want = sorted((f["path"], at) for f in files.collect() for at, _ in sequential(f["path"]))
    assert sorted((r["path"], r["offset"]) for r in read_archives(files, split).collect()) == want


def test_nulls_repeats_long_payloads(spark):
    long = "".join(random.Random(1).choices("abc é\n", k=3_000_000))
    rows = [(5, "u", "same"), (3, None, "same"), (3, "u v\r\nX: y", "same"), (None, "u", "same"), (7, "u", None), (8, "u", ""),
            (None, None, "lonely"), (None, None, "lonely"), (9, "", long), (10, "u", long), (-4, "u", "neg"), (11, "u", "WARC/1.1\r\n\r\n")]
    assert got(page_records(pages(spark, rows), split_bytes=5000)) == brute([(r[0], r[2]) for r in rows])


def test_min_bytes_and_payloads(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    files = write_archives(pages(spark, rows), min_bytes=3)
    found = {r["record_id"]: r for r in read_archives(files, with_payload=True).collect()}
    assert {k: (r["record_type"], r["payload"], r["refers_to"], r["digest_ok"]) for k, r in found.items()} == {
        "urn:page:1": ("response", b"ab", None, True), "urn:page:2": ("response", b"ab", None, True),
        "urn:page:3": ("response", b"abcd", None, True), "urn:page:4": ("revisit", None, "urn:page:3", None)}


def test_files_are_ordinary_gzip(spark):
    folder = scratch_path(spark, "warc-test")
    write_archives(pages(spark, [(1, "http://a", "<p>1</p>"), (2, "http://b", "<p>1</p>")]), path=folder)
    listed = archives(spark, f"{folder}/*.warc.gz")
    text = "".join(gzip.open(local(r["path"]), "rt", newline="").read() for r in listed.collect())
    assert text.count("WARC/1.1\r\n") == 2 and text.count("WARC-Refers-To: <urn:page:1>") == 1 and text.count("<p>1</p>") == 1
    assert read_archives(listed, 64).count() == 2


def test_archive_inside_a_payload(spark):
    """Members stored unpacked inside a record are no records, whatever range starts among them."""
    folder = scratch_path(spark, "warc-test")
    noise = random.Random(4).randbytes

    def record(name, body):
        head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{name}>\r\nContent-Type: x/y\r\nContent-Length: {len(body)}\r\n\r\n"
        z = zlib.compressobj(0, zlib.DEFLATED, 31)
        return z.compress(head.encode() + body + b"\r\n\r\n") + z.flush()

    inner = b"".join(record(f"in{i}", noise(50)) for i in range(40))
    data = record("a", noise(300)) + record("b", inner) + record("c", inner) + record("d", b"x")
    files = write_archives(pages(spark, [(1, "u", "x")]), path=folder)
    path = local(files.first()["path"])
    with open(path + ".more.warc.gz", "wb") as f:
        f.write(data)
    files = spark.createDataFrame([(path + ".more.warc.gz", len(data))], "path string, length long")
    for split in (700, 3000):
        found = read_archives(files, split).collect()
        assert sorted(r["record_id"] for r in found) == ["a", "b", "c", "d"]


def test_damage_and_empty(spark):
    assert page_records(pages(spark, [(1, "u", "x")]).limit(0)).count() == 0
    files = write_archives(pages(spark, [(1, "u", "y" * 500)]))
    path = local(files.first()["path"])
    data = open(path, "rb").read()
    with open(path + ".cut.gz", "wb") as f:
        f.write(data[:-6])
    with pytest.raises(Exception, match="archive ends inside a record"):
        read_archives(spark.createDataFrame([(path + ".cut.gz", len(data) - 6)], "path string, length long")).collect()
