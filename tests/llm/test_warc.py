import base64
import hashlib
import io
import zipfile
import zlib

import pytest

from patronage.llm import warc
from tests.llm.conftest import TESTDATA


def want(rows):
    first = {}
    for i, _, h in rows:
        k = (h or "").encode()
        if i is not None:
            first[k] = min(first.get(k, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = first.get(p) is not None and i != first[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


ROWS = [(3, "http://a/ b\r\nX: y", "<p>hé</p>"), (1, None, "<p>hé</p>"), (2, "http://b", None), (7, "http://c", ""), (9, "u", "x\r\n\r\ny" * 50000),
        (None, "n", "null id"), (8, "u", "null id"), (8, "u", "null id"), (-4, "m", "minus")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, payload string, digest int")


def test_round_trip(spark, tmp_path, monkeypatch):
    packages = warc.write_packages(frame(spark, ROWS), f"file://{tmp_path}/w")
    back = warc.read_packages(packages).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == want(ROWS)
    bodies = {r.page_id: bytes(r.payload) for r in back if r.record_type == "response"}
    assert bodies[9] == ("x\r\n\r\ny" * 50000).encode() and bodies[2] == b""
    assert next(r.url for r in back if r.page_id == 3) == "http://a/%20b%0D%0AX:%20y"
    for r in packages.collect():
        with zipfile.ZipFile(r.uri.removeprefix("file://")) as z:
            assert z.testzip() is None and set(z.namelist()) == {warc.ARCHIVE, warc.INDEX}
            assert z.getinfo(warc.ARCHIVE).compress_type == zipfile.ZIP_STORED


def test_small_payloads_stay_responses_below_the_bound(spark, tmp_path):
    rows = [(1, "a", "tiny"), (2, "b", "tiny"), (3, "c", "long enough"), (4, "d", "long enough")]
    back = warc.read_packages(warc.write_packages(frame(spark, rows), f"file://{tmp_path}/w", least_bytes=5)).collect()
    assert sorted((r.page_id, r.record_type) for r in back) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty_table(spark, tmp_path):
    assert warc.read_packages(warc.write_packages(frame(spark, []), f"file://{tmp_path}/w")).count() == 0


@pytest.mark.parametrize("index", [True, False])
def test_zip64_directories_and_missing_index(tmp_path, monkeypatch, index):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)  # every field overflows
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    records = [warc.record(k, f"u{k}", b"z" * k * 999, warc.payload_digest(b"z" * k * 999), None, False) for k in range(5)]
    packed = []
    for r in records:
        c = zlib.compressobj(9, zlib.DEFLATED, 31)
        packed.append(c.compress(r) + c.flush())
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}" * 100)
        z.writestr(warc.ARCHIVE, b"".join(packed))
        if index:
            at, lines = 0, []
            for k, p in enumerate(packed):
                lines.append(f"{k} {at} {len(p)}\n")
                at += len(p)
            z.writestr(zipfile.ZipInfo(warc.INDEX), "".join(lines), zipfile.ZIP_DEFLATED)
        z.comment = b"a comment"
    data = out.getvalue()
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    path = tmp_path / "p.zip"
    path.write_bytes(data)
    got = [warc.parsed(zlib.decompress(data[a:a + n], 31)) for a, n in warc.places(f"file://{path}")]
    assert [(g["page_id"], g["payload_bytes"]) for g in got] == [(k, k * 999) for k in range(5)]
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(b"no zip"), 6)


def test_a_changed_payload_is_noticed():
    r = warc.record(1, "u", b"abc", warc.payload_digest(b"abc"), None, False)
    with pytest.raises(ValueError):
        warc.parsed(r.replace(b"abc", b"abd"))


def test_op6_on_the_table(spark):
    sf = f"{TESTDATA}/sf0.01"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, warc.op6_warc(spark, sf).collect()), key=str) == want(rows)
