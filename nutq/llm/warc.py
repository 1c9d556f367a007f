"""WARC archives whose repeated payloads are revisits of one response.

Headers alone are shuffled by payload digest to find each payload's original;
payloads move once, to their record's decision, and those of revisits are left
out.  Archives are gzip text parts that Spark writes and reads: records end in
``CR LF CR LF``, so that is the line end of the writer, and a reader's task puts
the pieces between these together again by the records' lengths, one record at
a time.  What a third of all records share is no hot key: originals of such
payloads are few by construction and are sent to the records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

#: A key of more rows than this and than one of MOST_HOT of all rows is hot; there are at most MOST_HOT hot keys.
LEAST_HOT = 1_000
MOST_HOT = 10_000
_FIELDS = ["record_type", "record_id", "target_uri", "date", "key", "refers_to_id", "header_digest"]
HEADERS = ", ".join(f"{name} string" for name in _FIELDS) + ", payload_bytes long, payload_digest string"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of binary data in upper-case base32: 20 bits of it, five hexadecimal digits, are four letters."""
    digest = F.sha1(data)
    part = lambda i: F.translate(F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0"), _DIGITS, _BASE32)
    return F.concat(*[part(i) for i in range(8)])


def joined_by_key(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """Inner join to ``right``, which has ``key`` once and ``n``, the number of ``left`` rows that have it.

    Hot keys have more than ``rows / MOST_HOT`` rows each, so there are at most
    MOST_HOT of them and they may be broadcast; what is left has no hot key.
    """
    most = max(LEAST_HOT, -(-rows // MOST_HOT))
    hot = F.broadcast(right.where(F.col("n") > most).drop("n"))
    cold = right.where(F.col("n") <= most).drop("n")
    return left.join(hot, key).unionByName(left.join(F.broadcast(right.where(F.col("n") > most).select(key)), key, "left_anti").join(cold, key))


def _urn(token: str, *parts: Column) -> Column:
    """A record id that reruns of a task repeat."""
    h = F.md5(F.concat_ws(" ", F.lit(token), *parts))
    piece = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("urn:uuid:"), piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-8"), piece(14, 3), F.lit("-a"), piece(18, 3), F.lit("-"), piece(21, 12))


def captures(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """key, target_uri, payload of a table of pages; a null body is an empty payload."""
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary") if dict(pages.dtypes)[body] != "binary" else F.coalesce(F.col(body), F.lit(b""))
    return pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("target_uri"), payload.alias("payload"))


def _written(value: Column) -> Column:
    """A header's value without what would end or trim it."""
    for found, instead in (("\r", "%0D"), ("\n", "%0A"), ("^[ \t]", "%20"), ("[ \t]$", "%20")):
        value = F.regexp_replace(value, found, instead)
    return value


def _block(lines: dict[str, Column], first: Column) -> Column:
    """Header lines; a null value has none."""
    return F.concat_ws("\r\n", first, *[F.concat(F.lit(f"{name}: "), value) for name, value in lines.items()])


def archive(spark: SparkSession, records: DataFrame, path: str, least: int = 0, date: str = "") -> None:
    """Write ``key, target_uri, payload`` as deduplicated archives below ``path``, with fresh headers.

    Of records with equal payloads of at least ``least`` bytes the one with the
    largest key (null is the smallest, repeated keys in any one order) is a
    response; the others become revisits that refer to it.  Smaller payloads
    are all responses.  Every part begins with a ``warcinfo`` record; a
    record's headers are made anew from this run.  A null URI or key has no
    header line; line ends in a URI are percent-encoded.  A payload is one
    value in one task: about four times the longest one must fit there.
    """
    now = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    token = uuid.uuid4().hex
    columns = ["_row", "key", "target_uri", "digest", "bytes", "payload"]
    made = records.select("key", "target_uri", "payload", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes")).withColumn("_row", F.monotonically_increasing_id())
    table = kernel.write_table(spark, made.select(*columns), "zstd")
    # Headers only, combined before the shuffle by digest.
    headers = table.where(F.col("bytes") >= least).select("_row", "key", "target_uri", "digest")
    groups = headers.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("key", "_row", "target_uri")).alias("_first")).where("n > 1")
    groups = kernel.write_table(spark, groups)
    first = F.col("_first")
    revisits = joined_by_key(headers, groups, "digest", table.count()).where(F.col("_row") != first["_row"]).select("_row", first["_row"].alias("_of"), first["target_uri"].alias("_of_uri"), F.lit(True).alias("_again"))
    decided = table.join(revisits, "_row", "left")
    again = F.col("_again").isNotNull()
    http = F.concat_ws("\r\n", F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string")))
    block = F.concat(F.concat(http, F.lit(END)).cast("binary"), F.when(again, F.lit(b"")).otherwise(F.col("payload")))
    angle = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    lines = {
        "WARC-Type": F.when(again, "revisit").otherwise("response"),
        "WARC-Record-ID": angle(_urn(token, F.col("_row").cast("string"))),
        "WARC-Date": F.lit(now),
        "WARC-Target-URI": _written(F.col("target_uri")),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
        "WARC-Block-Digest": F.concat(F.lit("sha1:"), base32_sha1(F.col("_block"))),
        "WARC-Profile": F.when(again, PROFILE),
        "WARC-Refers-To": F.when(again, angle(_urn(token, F.col("_of").cast("string")))),
        "WARC-Refers-To-Target-URI": F.when(again, _written(F.col("_of_uri"))),
        "WARC-Refers-To-Date": F.when(again, F.lit(now)),
        "X-Key": _written(F.col("key").cast("string")),
        "Content-Type": F.lit("application/http; msgtype=response"),
        "Content-Length": F.octet_length("_block").cast("string"),
    }
    record = F.concat(F.concat(_block(lines, F.lit(VERSION)), F.lit(END)).cast("binary"), F.col("_block"))
    note = b"software: nutq\r\nformat: WARC File Format 1.1\r\n"
    about = {"WARC-Type": F.lit("warcinfo"), "WARC-Record-ID": angle(_urn(token, F.lit("part"), F.spark_partition_id().cast("string"))), "WARC-Date": F.lit(now), "Content-Type": F.lit("application/warc-fields"), "Content-Length": F.lit(str(len(note)))}
    info = F.concat(F.concat(_block(about, F.lit(VERSION)), F.lit(END)).cast("binary"), F.lit(note), F.lit(END.encode()))
    first_of_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    out = decided.withColumn("_block", block).select(F.concat(F.when(first_of_part, info).otherwise(F.lit(b"")), record).cast("string").alias("value"))
    out.write.text(path, compression="gzip", lineSep=END)
    for frame in (groups, table):
        kernel.drop_table(spark, frame)


class _Parser:
    """Puts the pieces of one archive together, record by record."""

    def __init__(self):
        self.held: list[bytes] = []
        self.size = 0
        self.header: dict[str, str] | None = None
        self.need = 0

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.held += [piece, END.encode()]
        self.size += len(piece) + len(END)
        while self.size >= self.need:
            data = b"".join(self.held)
            if self.header is None:
                head, found, rest = data.partition(END.encode())
                if not found:
                    self.need = self.size + 1
                    self.held = [data]
                    return
                if not head.lstrip(b"\r\n").startswith(b"WARC/"):
                    raise ValueError(f"not a WARC record: {head[:60]!r}")
                pairs = (line.partition(":") for line in head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")[1:])
                self.header = {name.strip().lower(): value.strip(" \t") for name, _, value in pairs}
                self.need = int(self.header["content-length"]) + len(END)
            else:
                yield self.header, data[: self.need - len(END)]
                rest, self.header, self.need = data[self.need :], None, 1
            self.held, self.size = [rest], len(rest)

    def close(self) -> None:
        if self.header is not None or b"".join(self.held).strip(b"\r\n"):
            raise ValueError("an archive ends within a record")


def _parse(with_payload: bool):
    def read(header: dict[str, str], block: bytes) -> tuple:
        bare = lambda name: header[name].strip("<>") if name in header else None
        kind = header["warc-type"]
        http = header.get("content-type", "").startswith("application/http")
        payload = block.partition(END.encode())[2] if http else block
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        said = header.get("warc-payload-digest")
        fields = (kind, bare("warc-record-id"), header.get("warc-target-uri"), header.get("warc-date"), header.get("x-key"), bare("warc-refers-to"), said and said.partition(":")[2])
        if kind == "revisit":  # the payload is its original's
            return (*fields, None, None, None)
        return (*fields, len(payload), digest, payload if with_payload else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parser = None, _Parser()
        names = [*_FIELDS, "payload_bytes", "payload_digest"] + ["payload"] * with_payload
        kinds = [pa.string()] * len(_FIELDS) + [pa.int64(), pa.string()] + [pa.binary()] * with_payload
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)
        rows, held = [], 0
        for batch in batches:
            for name, piece in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if name != file:
                    parser.close()
                    file, parser = name, _Parser()
                for header, block in parser.feed(piece):
                    if header["warc-type"] in ("response", "revisit", "resource"):
                        rows.append(read(header, block))
                        held += len(block) if with_payload else 0
                        if len(rows) == 5_000 or held > kernel.CHUNK_BYTES:
                            yield pack(rows)
                            rows, held = [], 0
        parser.close()
        if rows:
            yield pack(rows)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The response, resource and revisit records of gzip archives, one task a file, one record at a time.

    A revisit has no payload of its own: ``payload_bytes``, ``payload_digest``
    and ``payload`` are null until ``resolve`` finds its original.  Digests are
    computed from the bytes; ``header_digest`` is what the record says.  Text
    that is no WARC record, or an archive that ends within one, is an error.
    """
    kernel.short_batches(spark)
    pieces = spark.read.text(path, lineSep=END, pathGlobFilter="*.gz").select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_parse(with_payload), HEADERS + ", payload binary" * with_payload)


def resolve(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Add ``refers_to``, the original's key, and fill the payload's columns of each revisit from its original.

    An original is looked up by the record id that a revisit refers to and,
    where that is missing or unknown, by payload digest (the response with the
    largest record id).  A revisit without either keeps nulls.
    """
    payload = [c for c in ("payload_bytes", "payload_digest", "payload") if c in records.columns]
    own = [c for c in records.columns if c not in payload]
    is_revisit = F.col("record_type") == "revisit"
    responses = records.where(~is_revisit)
    light = [c for c in payload if c != "payload"]
    revisits = kernel.write_table(spark, records.where(is_revisit).select(*own).withColumn("_r", F.monotonically_increasing_id()))
    found = responses.select("record_id", F.col("key").alias("refers_to"), *light)
    asked = revisits.where("refers_to_id IS NOT NULL").groupBy(F.col("refers_to_id").alias("record_id")).agg(F.count("*").alias("n"))
    # A record id that several records have is that of one of them.
    originals = found.join(asked, "record_id").groupBy("record_id", "n").agg(F.max(F.struct("refers_to", *light)).alias("_o"))
    originals = kernel.write_table(spark, originals.select(F.col("record_id").alias("refers_to_id"), "n", "_o.*"))
    rows = revisits.count()
    by_id = kernel.write_table(spark, joined_by_key(revisits, originals, "refers_to_id", rows))
    columns = [*own, "refers_to", *light]
    solved, open_ = by_id.select(*columns), revisits.join(by_id.select("_r"), "_r", "left_anti")
    if not open_.isEmpty():  # what no record id names is looked up by digest
        wanted = kernel.write_table(spark, open_.where("header_digest IS NOT NULL").groupBy("header_digest").agg(F.count("*").alias("n")))
        held = responses.withColumn("header_digest", F.col("payload_digest")).join(wanted.select("header_digest"), "header_digest", "left_semi")
        held = held.groupBy("header_digest").agg(F.max(F.struct("record_id", F.col("key").alias("refers_to"), *light)).alias("_o"))
        held = kernel.write_table(spark, held.join(wanted, "header_digest").select("header_digest", "n", F.col("_o.record_id").alias("_id"), "_o.refers_to", *[f"_o.{c}" for c in light]))
        by_digest = kernel.write_table(spark, joined_by_key(open_, held, "header_digest", rows).withColumn("refers_to_id", F.col("_id")))
        lost = open_.join(by_digest.select("_r"), "_r", "left_anti").withColumns({c: F.lit(None).cast(kind) for c, kind in {"refers_to": "string", **{c: records.schema[c].dataType for c in light}}.items()})
        solved = solved.unionByName(by_digest.select(*columns)).unionByName(lost.select(*columns))
    if "payload" in payload:
        bodies = responses.select(F.col("record_id").alias("refers_to_id"), "payload")
        solved = solved.join(bodies, "refers_to_id", "left")
    original = responses.select(*own, F.lit(None).cast("string").alias("refers_to"), *payload)
    return original.unionByName(solved.select(*original.columns))


def rewrite(spark: SparkSession, source: str, path: str, least: int = 0) -> None:
    """Deduplicate archives, old revisits included: each gets its original's payload back, then all are archived anew.

    Keys are the ``X-Key`` headers, compared as text; a revisit whose original is nowhere is left out.
    """
    records = resolve(spark, read_archives(spark, source))
    archive(spark, records.where("payload IS NOT NULL").select("key", "target_uri", "payload"), path, least)


def archive_pages(spark: SparkSession, pages: DataFrame, path: str = "", least: int = 0, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Write one record a page, read the archives back: key, payload_bytes, payload_digest, record_type, refers_to.

    Payloads are the bodies in UTF-8, null as empty; sizes and digests are those
    of the full payload, a revisit's from its original.  Repeated rows are
    records of their own, of which one can be the response; rows without key
    are archived without one; other columns are not read; an empty table gives no rows.
    """
    path = path or f"{kernel.shared_root(spark)}/nutq-{uuid.uuid4().hex}-warc"
    archive(spark, captures(pages, key, url, body), path, least)
    read = kernel.write_table(spark, resolve(spark, kernel.write_table(spark, read_archives(spark, path, with_payload=False))))
    kind = pages.schema[key].dataType
    return read.select(F.col("key").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
