"""WARC archives: exact round trips, members against their index, broken and foreign archives."""

import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import Row

from larder.llm import warc

PAGES = "page_id long, url string, html string, payload string, key string, first long, n int"


def rows_of(rng):
    big, big2 = "é" * 500, "x" * 1000
    texts = [None, "", "a", "a", big, big, big2, big2, big2, "x" * 999, "x" * 999, "line\r\n\r\nWARC/1.1\r\n\r\n" * 80, "long " * 300_000]
    rows = [(10 + 3 * k, None if k % 4 == 0 else f"http://h/ä b\r\n{k}", t) for k, t in enumerate(texts)]
    rows += [(None, None, big2), (None, "u", "y" * 2000), (None, "u", "y" * 2000), rows[8], rows[8], (-5, "u", "z" * 1500), (-7, "u", "z" * 1500)]
    rows += [(100 + k, "http://r", "".join(rng.choices("<p>\r\n é漢", k=rng.randint(0, 3000)))) for k in range(40)]
    return rows


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "t")
    rows = [(*r, "p", "k", 1, 2) for r in rows_of(random.Random(5))]
    spark.createDataFrame(rows, PAGES).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def brute(rows, limit=1000):
    """Result rows of the contract; of equal largest ids one row is the response."""
    out, groups = [], {}
    for page, text in rows:
        data = (text or "").encode()
        groups.setdefault(data, []).append(page)
    for data, ids in groups.items():
        digest = hashlib.sha1(data).hexdigest()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(ids):
            again = k > 0 and len(data) >= limit
            out.append((str(i), len(data), digest, "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=repr)


def test_round_trip(pages):
    want = brute([(r.page_id, r.html) for r in pages.select("page_id", "html").collect()])
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect()]
    assert sorted(got, key=repr) == want


def test_members_follow_the_index_and_hold_the_same_bytes(spark, pages, tmp_path):
    whole = warc.write_archives(warc.planned_records(pages), f"file://{tmp_path}/a")
    index = warc.normalise(whole, f"file://{tmp_path}/b").collect()
    before = sorted(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/a/*.warc.gz"))
    after = sorted(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/b/*.warc.gz"))
    assert before == after and len(index) == pages.count()
    lines = sorted(line.split("\t") for f in glob.glob(f"{tmp_path}/b/*.idx") for line in open(f).read().splitlines())
    assert lines == sorted(["" if x is None else str(x) for x in r] for r in index)
    for r in index:
        with open(r.archive.removeprefix("file://"), "rb") as f:
            f.seek(r.offset)
            raw = gzip.decompress(f.read(r.length))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and r.record_id.encode() in raw
    ends = {}
    for r in sorted(index, key=lambda r: (r.archive, r.offset)):
        assert ends.get(r.archive, 0) == r.offset
        ends[r.archive] = r.offset + r.length


def test_payloads_come_back(pages):
    whole = warc.write_archives(warc.planned_records(pages, min_bytes=1 << 40), warc.new_folder(pages.sparkSession, "t"))
    read = warc.read_records(warc.normalise(whole, warc.new_folder(pages.sparkSession, "t")), payloads=True, split_bytes=100)
    assert sorted(bytes(r.payload) for r in read.collect()) == sorted((r.html or "").encode() for r in pages.collect())


def test_foreign_archives(spark, tmp_path):
    """Several members, records without HTTP, blank lines between records, pieces cut anywhere."""
    rng = random.Random(2)
    blocks = [rng.randbytes(rng.randint(0, 5000)) for _ in range(30)] + [b"", b"\r\n\r\n" * 9, rng.randbytes(3 * warc.CHUNK)]
    made = [warc.record([("WARC-Type", "resource"), ("WARC-Record-ID", f"<r{k}>")], b) for k, b in enumerate(blocks)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(made)))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in made[:9]) + gzip.compress(b""))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"\r\n" + made[3] + b"\r\n" + made[4]))
    (tmp_path / "d.warc.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "e.warc.gz").write_bytes(b"")
    files = spark.createDataFrame([Row(archive=f"file://{tmp_path}/{n}.warc.gz") for n in "abcde"])
    read = warc.read_records(warc.normalise(files, f"file://{tmp_path}/out"), payloads=True).collect()
    assert sorted(bytes(r.payload) for r in read) == sorted(blocks + blocks[:9] + blocks[3:5])


@pytest.mark.parametrize("bad", ["cut", "tail", "text"])
def test_broken_archives_raise(spark, tmp_path, bad):
    good = gzip.compress(warc.record([("WARC-Type", "resource")], b"x" * 5000))
    data = {"cut": good[:-40], "tail": good + gzip.compress(b"WARC/1.1\r\nContent-Length: 7"), "text": gzip.compress(b"<html>\r\n\r\n")}[bad]
    (tmp_path / "a.warc.gz").write_bytes(data)
    files = spark.createDataFrame([Row(archive=f"file://{tmp_path}/a.warc.gz")])
    with pytest.raises(Exception, match="gzip stream ends|inside a record|no WARC record"):
        warc.normalise(files, f"file://{tmp_path}/out")


def test_empty(spark, tmp_path):
    spark.createDataFrame([], PAGES).write.parquet(str(tmp_path / "t"))
    out = warc.archived_pages(spark.read.parquet(str(tmp_path / "t")))
    assert out.count() == 0 and out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
