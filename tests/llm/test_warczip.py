import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from tests.llm.helpers import LONG, clashing
from veil.llm import warczip


def pages(spark):
    big = "<p>same</p>" * 20
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, big), (2, None, big), (None, "http://n/", big), (3, "http://c/é", "tiny"), (4, "u", "tiny"), (5, "u", None), (6, "u", ""), (7, "u", LONG), (8, "u", LONG), (9, "u", "é\r\n\r\n" * 60)]
    return clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string")), rows


def expected(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        first = min((p for p, _, h in rows if h == html and p is not None), default=None)
        revisit = len(payload) >= 100 and page != first
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    df, rows = pages(spark)
    got = warczip.round_trip(df)
    found = got.collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(rows)
    payloads = {r.page_id: bytes(r.payload) for r in found if r.record_type == "response"}
    assert payloads[9] == ("é\r\n\r\n" * 60).encode() and payloads[5] == b""
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    assert {r.url for r in found if r.page_id == 1} == {"http://a/%20b%0D%0AX:%20y"}
    assert warczip.round_trip(df.limit(0)).count() == 0


def test_several_members_ranges_and_packages(spark, monkeypatch, tmp_path):
    package = warczip._Package(str(tmp_path / "p"))
    monkeypatch.setattr(warczip, "MEMBER_BYTES", 2000)
    monkeypatch.setattr(warczip, "RANGE_BYTES", 1500)
    for k in range(40):
        payload = hashlib.sha256(str(k).encode()).hexdigest().encode() * 4
        package.add(warczip.record(k, f"http://h/{k}", payload, hashlib.sha256(payload).hexdigest(), None, False))
    path, records, _ = package.close()
    assert records == 40 and package.members > 3
    ranges = list(warczip.ranges_of(path))
    assert sum(len(sizes) for _, _, sizes in ranges) == 40 and len(ranges) > package.members
    assert all(length == sum(sizes) <= 1500 for _, length, sizes in ranges)
    with zipfile.ZipFile(path) as standard:  # a package that others can read
        assert standard.testzip() is None and standard.namelist()[-1] == warczip.INDEX
    got = warczip.read_packages(spark.createDataFrame([(path,)], "path string"))
    assert sorted(int(r.page_id) for r in got.select("page_id").collect()) == list(range(40))


def directory(data):
    return warczip.read_directory(pa.BufferReader(data))


def zipped(method=zipfile.ZIP_STORED, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        z.writestr("a", b"first" * 10)
        with z.open("b", "w", force_zip64=True) as f:
            f.write(b"second" * 30)
        z.comment = comment
    return out.getvalue()


def read(data, entry):
    _, method, offset, size = entry
    assert method == 0
    return data[offset : offset + size]


def test_directories(monkeypatch):
    plain = zipped(comment=b"a comment with PK\x05\x06 inside")
    assert [e[0] for e in directory(plain)] == ["a", "b"] and read(plain, directory(plain)[1]) == b"second" * 30
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    large = zipped()
    assert warczip.END64 in large and warczip.LOCATOR64 in large
    assert [read(large, e) for e in directory(large)] == [b"first" * 10, b"second" * 30]


def test_broken_packages():
    good = zipped()
    for bad in (b"", b"no zip at all", good[:-30], good.replace(warczip.ENTRY, b"XXXX")):
        with pytest.raises(ValueError):
            directory(bad)
    assert directory(zipped(zipfile.ZIP_DEFLATED))[0][1] == 8


def test_a_changed_payload_is_noticed():
    payload = b"x" * 200
    data = warczip.record(1, None, payload, hashlib.sha256(payload).hexdigest(), None, False)
    assert warczip.parse_record(data)["payload"] == payload
    with pytest.raises(ValueError):
        warczip.parse_record(data.replace(b"xxxx", b"yyyy", 1))


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    """Adaptive execution does not merge the few rows that stand for megabytes."""
    pages = spark.range(2000).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "repeat(sha2(cast(id AS string), 512), 200) AS html").repartition(12)
    packages = warczip.write_packages(pages, str(tmp_path))
    assert packages.agg({"bytes": "sum"}).first()[0] > 0
    read = warczip.read_packages(packages, tasks=6)
    read.write.parquet(str(tmp_path / "out"))
    from pyspark.sql import functions as F

    used = warczip.read_packages(packages, tasks=6).select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 3 and spark.read.parquet(str(tmp_path / "out")).count() == 2000
