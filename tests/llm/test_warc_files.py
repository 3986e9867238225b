"""WARC files of other programs read back exactly."""

import gzip
import uuid

import pytest

from tillroll.llm import warc, warc_files

DATE = "2024-01-02T03:04:05Z"


def record(version, kind, payload, http=True, newline="\r\n", length=None, **fields):
    lines = [f"WARC/{version}", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in fields.items()]
    if http:
        lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(payload) if length is None else length}")
    return newline.join(lines).encode() + newline.encode() * 2 + payload + b"\r\n\r\n"


def answer(status, body, *headers):
    return "\r\n".join([f"HTTP/1.1 {status} X", *headers]).encode() + b"\r\n\r\n" + body


BINARY = bytes(range(256)) * 50
QUOTED = b"before WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n after WARC/1."
RECORDS = [
    record("1.0", "warcinfo", b"software: x WARC/1.0\r\nformat: WARC File Format 1.0\r\n", http=False, WARC_Date=DATE),
    record("1.0", "response", answer(200, BINARY, 'ETag: "1"'), WARC_Target_URI="http://a.example/x", WARC_Date=DATE),
    record("1.1", "response", answer(200, QUOTED), WARC_Target_URI="<http://a.example/q>", WARC_Date="2024-01-02T03:04:06.123456Z"),
    record("1.1", "response", answer(200, b""), WARC_Target_URI="http://a.example/é", WARC_Date=DATE),
    record("1.1", "revisit", answer(304, b"", 'ETag: "1"'), WARC_Target_URI="http://a.example/x", WARC_Date="2024-01-02T04:00:00Z",
           WARC_Profile="http://netpreserve.org/warc/1.1/revisit/server-not-modified", WARC_Refers_To_Target_URI="http://a.example/x",
           WARC_Refers_To_Date=DATE, WARC_Refers_To="<urn:uuid:1>"),
    record("1.0", "response", answer(200, b"lines\nonly"), newline="\n", WARC_Target_URI="http://b.example/", WARC_Date=DATE),
]


@pytest.mark.parametrize("kind", ["members", "one", "plain"])
def test_records_read_back(spark, tmp_path, kind):
    data = b"".join(gzip.compress(r) for r in RECORDS) if kind == "members" else b"".join(RECORDS)
    path = tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")
    path.write_bytes(gzip.compress(data) if kind == "one" else data)
    rows = warc_files.read_warc(spark, str(path), strict=True).collect()
    assert [r["warc_type"] for r in rows] == ["warcinfo", "response", "response", "response", "revisit", "response"]
    assert [r["version"] for r in rows] == ["WARC/1.0", "WARC/1.0", "WARC/1.1", "WARC/1.1", "WARC/1.1", "WARC/1.0"]
    assert all(r["complete"] and r["record_id"].startswith("urn:uuid:") and r["captured"] for r in rows)
    assert [bytes(r["body"]) for r in rows[1:4]] == [BINARY, QUOTED, b""] and bytes(rows[5]["body"]) == b"lines\nonly"
    assert bytes(rows[0]["body"]).startswith(b"software: x WARC/1.0") and rows[0]["http_head"] is None
    assert [r["url"] for r in rows[2:4]] == ["http://a.example/q", "http://a.example/é"]
    assert [r["status"] for r in rows] == [None, 200, 200, 200, 304, 200] and rows[1]["headers"] == {"etag": '"1"'}
    assert rows[4]["refers_to_date"] == DATE and rows[4]["refers_to_id"] == "urn:uuid:1" and rows[4]["profile"].endswith("not-modified")
    assert rows[2]["captured"].microsecond == 123456


def test_revisits_of_foreign_files(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, RECORDS)))
    records = warc_files.read_warc(spark, str(tmp_path)).where("url IS NOT NULL")
    found = {r["url"]: r for r in warc.resolve_revisits(records).where("warc_type = 'revisit'").collect()}
    (full,) = records.where("url = 'http://a.example/x' AND status = 200").collect()
    assert found["http://a.example/x"]["outcome"] == "resolved" and found["http://a.example/x"]["refers_to"] == full["record_id"]


def test_records_that_end_early(spark, tmp_path):
    short = record("1.1", "response", answer(200, b"short"), length=9999, WARC_Date=DATE)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(RECORDS[1] + short))
    rows = warc_files.read_warc(spark, str(tmp_path)).collect()
    assert [r["complete"] for r in rows] == [True, False]
    with pytest.raises(Exception, match="incomplete WARC record"):
        warc_files.read_warc(spark, str(tmp_path), strict=True).collect()
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b""))
    assert warc_files.read_warc(spark, str(tmp_path)).count() == 0
