import hashlib
import io
import zipfile
from collections import Counter, defaultdict
from urllib.parse import quote

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftlog.llm import warc_zip as Z
from driftlog.llm.scratch import shared_folder

from .conftest import SF


def expected(rows):
    """(id, bytes, digest, type, refers_to, url) of every page."""
    ids = defaultdict(list)
    for i, _, h in rows:
        ids[h or ""].append(i)
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        top = max((x for x in ids[h or ""] if x is not None), default=None)
        again = len(data) >= 1000 and len(ids[h or ""]) > 1 and i != top
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None,
                    None if u is None else quote(u, safe=Z.URI_CHARACTERS)))
    return out


def as_rows(records):
    num = lambda x: None if x is None else int(x)
    return [(num(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, num(r.refers_to), r.uri) for r in records]


@pytest.fixture(scope="module")
def pages(spark):
    page = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    big, small = "x" * 1000, "y" * 999
    odd = [(900_001, "a b\r\nc: d", big), (900_002, None, big), (900_003, "u", big), (900_004, "u", small), (900_005, "u", small),
           (None, "no id", big), (None, None, None), (900_006, "http://x/%20?q=é", "é\r\n\r\nWARC/1.1\r\n"), (900_007, "u", ""),
           (900_008, "long", "z" * 3_000_000)]
    more = page.where("page_id % 5 = 0").withColumn("page_id", F.col("page_id") + 10_000)
    return page.unionAll(more).unionAll(spark.createDataFrame(odd, page.schema)).withColumn("digest", F.lit("clash"))


def test_every_page_comes_back(spark, pages):
    rows = [tuple(r)[:3] for r in pages.collect()]
    packages = Z.write_packages(pages, shared_folder(spark, "t"), package_bytes=5_000)
    assert packages.count() > 5
    got = Z.read_records(packages, with_payload=True).collect()
    assert Counter(as_rows(got)) == Counter(expected(rows))
    bodies = {i: (h or "").encode() for i, _, h in rows if i is not None}
    assert all(bytes(r.payload) == bodies[int(r.record_id)] for r in got if r.record_type == "response" and r.record_id)


def test_empty_table(spark, pages):
    assert Z.archive_and_read(spark, pages.limit(0)).collect() == []


def test_repeated_rows_are_responses(spark):
    rows = spark.createDataFrame([(1, "u", "x" * 2000)] * 3 + [(0, "u", "x" * 2000)], "page_id bigint, url string, html string")
    got = as_rows(Z.archive_and_read(spark, rows).collect())
    assert Counter((r[0], r[3], r[4]) for r in got) == {(1, "response", None): 3, (0, "revisit", 1): 1}


def _file(data):
    return pa.OSFile(data, "rb") if isinstance(data, str) else pa.BufferReader(data)


def test_zip64_and_deflated_members(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("stored.bin"), b"s" * 500)
        z.writestr("packed.bin", b"p" * 500, zipfile.ZIP_DEFLATED)
        z.writestr("ünï.bin", b"tail")
        z.comment = b"a comment that holds PK\x05"
    data = out.getvalue()
    assert Z.END64_RECORD in data and Z.END64_LOCATOR in data
    found = {m.name: data[m.start:m.start + m.size] for m in Z.central_directory(_file(data))}
    assert found == {"stored.bin": b"s" * 500, "ünï.bin": b"tail"}


@pytest.mark.parametrize("data", [b"", b"not a zip", b"PK\x05\x06" + b"\xff" * 18])
def test_broken_packages_raise(data):
    with pytest.raises(ValueError):
        Z.central_directory(_file(data))


def test_archive_without_an_index_is_walked(spark, pages, tmp_path):
    rows = [(i, "u", f"page {i}" * 300, hashlib.sha1(f"page {i}".encode() * 300).hexdigest(), None) for i in range(40)]
    data = b"".join(Z._gzip(Z._record(*r[:2], r[2].encode(), *r[3:])) for r in rows)
    path = str(tmp_path / "plain.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("archive/other.warc.gz", data)
    got = Z.read_records(spark.createDataFrame([(path, 40)], Z.PACKAGES)).collect()
    assert sorted(int(r.record_id) for r in got) == list(range(40))
    assert {r.payload_digest for r in got} == {r[3] for r in rows}
