import base64
import gzip
import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from nutq.llm import warc

SCHEMA = "page_id long, url string, html string, key string, payload string, n long, record_type string"
BODIES = ["<p>a</p>", "x\r\n\r\ny", "ends\r\n", "\r\n\r\n", "", None, "WARC/1.1\r\nWARC-Type: response\r\n\r\nz", "ü" * 5000, "<p>b</p>\n"]


def base32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_rows():
    rows = [(i, f"http://h/{i}", BODIES[i % len(BODIES)]) for i in range(60)]
    rows += [rows[5], rows[5], (None, None, "<p>a</p>"), (None, "u", "lonely"), (1000, "odd\r\nurl ", "<p>c</p>"), (1001, None, "d")]
    return [(*r, "k", "p", 7, "t") for r in rows]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(page_rows(), SCHEMA).repartition(3)


def expected(rows, least=0):
    """Of equal payloads the last by id, null first, is the original."""
    out, groups = [], {}
    for page_id, _, html, *_ in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    for payload, ids in groups.items():
        ids.sort(key=lambda x: (x is not None, x))
        for i, page_id in enumerate(ids):
            again = len(payload) >= least and i < len(ids) - 1
            out.append((page_id, len(payload), base32(payload), "revisit" if again else "response", ids[-1] if again else None))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least", [0, 9, 10**9])
def test_every_page_is_a_response_or_a_revisit(spark, pages, least):
    assert as_rows(warc.archive_pages(spark, pages, least=least)) == expected(page_rows(), least)


def test_hot_payloads_are_sent_to_their_records(spark, monkeypatch):
    monkeypatch.setattr(warc, "LEAST_HOT", 2)
    rows = [(i, "u", "same" if i % 3 else f"{i % 7}", *[None] * 4) for i in range(200)]
    df = spark.createDataFrame([(*r[:3], "k", "p", 1, "t") for r in rows], SCHEMA)
    assert as_rows(warc.archive_pages(spark, df)) == expected(rows)


def test_an_empty_table_gives_no_rows(spark):
    assert warc.archive_pages(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_archives_are_warc(spark, pages, tmp_path):
    """A reader of its own: records one after another by their lengths, digests of blocks and payloads as stated."""
    path = str(tmp_path / "out")
    warc.archive(spark, warc.captures(pages), path, date="2020-01-02T03:04:05Z")
    seen, ids, payloads = {"response": 0, "revisit": 0, "warcinfo": 0}, set(), {}
    for file in glob.glob(path + "/*.gz"):
        data = gzip.open(file).read()
        first = True
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            header = dict(line.split(": ", 1) for line in lines)
            n = int(header["Content-Length"])
            block, end, data = rest[:n], rest[n : n + 4], rest[n + 4 :]
            assert version == "WARC/1.1" and end == b"\r\n\r\n" and header["WARC-Date"] == "2020-01-02T03:04:05Z"
            assert first == (header["WARC-Type"] == "warcinfo")
            first = False
            seen[header["WARC-Type"]] += 1
            ids.add(header["WARC-Record-ID"])
            if header["WARC-Type"] != "warcinfo":
                assert header["WARC-Block-Digest"] == "sha1:" + base32(block)
                http, _, payload = block.partition(b"\r\n\r\n")
                assert http.startswith(b"HTTP/1.1 200 OK\r\n") and "WARC-Payload-Digest" in header
                if header["WARC-Type"] == "response":
                    assert header["WARC-Payload-Digest"] == "sha1:" + base32(payload)
                    payloads[header["WARC-Record-ID"]] = header["WARC-Payload-Digest"]
                else:
                    assert payload == b"" and header["WARC-Profile"].endswith("identical-payload-digest")
                    ids.add(header["WARC-Refers-To"])
    assert seen["response"] + seen["revisit"] == len(page_rows()) and seen["revisit"] == len([r for r in expected(page_rows()) if r[3] == "revisit"])
    assert len(ids) == sum(seen.values())  # revisits refer to records that are there


def test_payloads_come_back(spark, pages, tmp_path):
    path = str(tmp_path / "out")
    warc.archive(spark, warc.captures(pages), path)
    read = warc.resolve(spark, warc.read_archives(spark, path)).collect()
    assert sorted((r.key, bytes(r.payload)) for r in read if r.key) == sorted((str(r[0]), (r[2] or "").encode()) for r in page_rows() if r[0] is not None)
    assert {r.target_uri for r in read if r.key == "1000"} == {"odd%0D%0Aurl%20"}
    assert all(r.payload_digest == r.header_digest == base32(bytes(r.payload)) for r in read)


def test_archives_with_revisits_are_rewritten(spark, tmp_path):
    """Old revisits are resolved by id or by digest, archives are deduplicated among each other."""
    a, b, c = (str(tmp_path / x) for x in "abc")
    frame = lambda rows: spark.createDataFrame(rows, "key long, target_uri string, payload string").withColumn("payload", F.col("payload").cast("binary"))
    warc.archive(spark, frame([(1, "u", "same"), (2, "u", "same"), (3, "u", "other")]), a)
    warc.archive(spark, frame([(4, "u", "same"), (5, "u", "new")]), b)
    lost = "WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:0>\r\nX-Key: 6\r\nWARC-Payload-Digest: sha1:" + base32(b"new") + "\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    nowhere = lost.replace("X-Key: 6", "X-Key: 7").replace(base32(b"new"), base32(b"nowhere"))
    with gzip.open(b + "/extra.gz", "wb") as file:
        file.write((lost + nowhere).encode())
    both = warc.resolve(spark, warc.read_archives(spark, f"{tmp_path}/[ab]")).collect()
    assert {(r.key, r.refers_to, r.payload and bytes(r.payload)) for r in both if r.record_type == "revisit"} == {("1", "2", b"same"), ("6", "5", b"new"), ("7", None, None)}
    warc.rewrite(spark, f"{tmp_path}/[ab]", c)
    out = {r.key: (r.record_type, r.refers_to, bytes(r.payload)) for r in warc.resolve(spark, warc.read_archives(spark, c)).collect()}
    assert out == {"1": ("revisit", "4", b"same"), "2": ("revisit", "4", b"same"), "3": ("response", None, b"other"), "4": ("response", None, b"same"), "5": ("revisit", "6", b"new"), "6": ("response", None, b"new")}


def test_damaged_archives_are_errors(spark, tmp_path):
    for name, data in (("cut", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort\r\n\r\n"), ("other", b"no archive\r\n\r\n")):
        (tmp_path / name).mkdir()
        with gzip.open(tmp_path / name / "x.gz", "wb") as file:
            file.write(data)
        with pytest.raises(Exception, match="ends within a record|not a WARC record"):
            warc.read_archives(spark, str(tmp_path / name)).collect()


def test_bytes_that_are_no_text_survive(spark, tmp_path):
    data = bytes(range(256)) * 3 + b"\r\n\r\n\xff"
    df = spark.createDataFrame([(1, "u", bytearray(data))], "key long, target_uri string, payload binary")
    warc.archive(spark, df, str(tmp_path / "x"))
    assert bytes(warc.read_archives(spark, str(tmp_path / "x")).first().payload) == data
