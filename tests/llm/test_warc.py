"""Archives written and read back, over many input splits and against payloads that look like archives."""

import hashlib
import random
from collections import defaultdict

import pytest

from newsframe.llm import warc

PAGES = "page_id long, url string, html string, file string, offset string, bytes long, sha string, salt int"


def fake(length, body="x"):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: {length}\r\n\r\n{body}\r\n\r\n"


def rows():
    rng = random.Random(3)
    out = [(i, f"http://h/{i}", "".join(rng.choice("abc \n\r<é\U0001F600") for _ in range(rng.randint(0, 3000)))) for i in range(40)]
    long = "same " * 400
    out += [(200 + i, "http://same/", long) for i in range(40)] + [(239, "http://same/", long), (None, None, long), (300, None, None), (301, "a\r\nContent-Length: 5", "")]
    out += [(310 + i, "http://small/", "tiny") for i in range(3)] + [(None, "u", "n" * 1500), (None, "u", "n" * 1500)]
    whole = "lead\r\n\r\n" + fake(1) + fake(1) + fake(10 ** 6)
    out += [(400, "http://WARC/1.1/", whole), (401, "u", "\nWARC/1." * 60), (402, "u", whole * 12), (403, "u", whole * 12), (404, "u", "\r\n\r\n" * 900)]
    out += [(405, "u", "z" * 9000 + "\n" + fake(3, "abc") * 60), (406, "u", "\n" + fake(0, "") + "\nWARC/1.1\r\n")]
    return out


def brute(given):
    groups = defaultdict(list)
    for i, _, h in given:
        if len(b := (h or "").encode()) >= 1000:
            groups[b].append(i)
    want = []
    for i, _, h in given:
        b = (h or "").encode()
        top = max((x for x in groups.get(b, []) if x is not None), default=None)
        again = top is not None and len(groups[b]) > 1 and i != top
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(want, key=str)


def read(spark, path, **kw):
    return warc.read_archives(spark, path, **kw).withColumn("page_id", warc.page_of("record_id")).withColumn("ref", warc.page_of("refers_to")).collect()


@pytest.mark.parametrize("split", ["3000", "64m"])
def test_round_trip_over_splits(spark, tmp_path, split):
    given = rows()
    df = spark.createDataFrame([(*r, "f", "o", 1, "s", 2) for r in given], PAGES).repartition(3)
    path = warc.write_archives(df, f"file://{tmp_path}/w")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "2000" if split == "3000" else "4m")
    try:
        got = read(spark, path, payloads=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.warc_type, r.ref) for r in got), key=str) == brute(given)
    assert all(r.intact for r in got if r.warc_type == "response")
    texts = defaultdict(set)
    for i, _, h in given:
        texts[i].add((h or "").encode())
    assert all(bytes(r.payload) in texts[r.page_id] for r in got if r.warc_type == "response")


def test_archives_are_plain_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/", "<p>é</p>"), (2, "b\nc", None)], "page_id long, url string, html string").coalesce(1)
    path = warc.write_archives(df, f"file://{tmp_path}/w")
    raw = b"".join(f.read_bytes() for f in sorted((tmp_path / "w").glob("part-*")))
    at, seen = 0, 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = raw[at:end].decode()
        assert head.startswith("WARC/1.1\r\n") and "WARC-Date:" in head
        length = int(head.split("Content-Length: ")[1])
        assert raw[end + 4 + length: end + 8 + length] == b"\r\n\r\n"
        at, seen = end + 8 + length, seen + 1
    assert seen == 2
    got = read(spark, path)
    assert {(r.page_id, r.target_uri, r.payload) for r in got} == {(1, "http://a/", None), (2, "b%0Ac", None)}


def test_foreign_broken_and_empty_files(spark, tmp_path):
    def record(i, body, kind="resource", version="1.0"):
        return f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{i}>\r\ncontent-length:{len(body)}\r\n\r\n{body}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((record(1, "one") + record(2, "two", version="1.1") + record(3, "cut")[:-6]).encode())
    (tmp_path / "b.warc").write_bytes(("junk\n" + record(4, "x")).encode())
    (tmp_path / "c.warc").write_bytes((record(5, "five") + "gap" + record(6, "six")).encode())
    (tmp_path / "d.warc").write_bytes(record(7, "a\nWARC/1.1\r\nb" * 3)[:-20].encode())
    (tmp_path / "e.warc").write_bytes(b"")
    got = read(spark, f"file://{tmp_path}", payloads=True)
    assert sorted((r.page_id, bytes(r.payload).decode(), r.offset > 0, r.intact) for r in got) == [(1, "one", False, None), (2, "two", True, None), (5, "five", False, None)]


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert read(spark, warc.write_archives(df, f"file://{tmp_path}/w")) == []
