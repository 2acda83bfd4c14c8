"""WARC archives: write pages as records, read archives back and reassemble segments."""

from __future__ import annotations

import gzip
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import scratch, table

#: Payloads shorter than this are never written as revisits.
LEAST_REVISIT = 100
SEGMENT_BYTES = 16384
CHUNK_BYTES = 4096
#: Records of one archive file; with the segment size this bounds a file, which is read whole.
RECORDS_PER_FILE = 1000

# Fixed values of the format (ISO 28500, RFC 9112).
VERSION = "WARC/1.1"
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def _raw(c: Column) -> Column:
    """Text as its UTF-8 bytes; pieces of binary stay as they are when joined as strings."""
    return c.cast("binary")


def chunked(payload: Column, size: int = CHUNK_BYTES) -> Column:
    """The payload (binary) in chunked transfer framing, as a string of the same bytes."""
    n = F.octet_length(payload)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    pieces = F.transform(starts, lambda at: F.concat(
        F.hex(F.least(F.lit(size), n - at).cast("long")), F.lit(CRLF),
        F.substring(payload, at + 1, F.lit(size)).cast("string"), F.lit(CRLF)))
    return F.concat(F.array_join(pieces, ""), F.lit(f"0{CRLF}{CRLF}"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def warc_records(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url",
                 segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row ``record`` (a string of the record's bytes, without the final blank lines) per
    WARC record of ``pages``.

    Equal payloads meet by their digest: the owners (least key, null keys last) are found by
    an aggregate with map-side combine, and only the join back shuffles payloads, so a
    payload that a third of the pages share is split by AQE like any skewed join key.
    Rows are told apart by scan position, so ``pages`` must be a table scan or a projection
    of one.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    target = F.col(url).cast("string") if url in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(key).alias("__key"), F.regexp_replace(target, "[\\r\\n]+", " ").alias("__url"), body.alias("__body"),
                        F.monotonically_increasing_id().alias("__row"))
    rows = rows.withColumns({"__digest": F.sha2("__body", 256), "__n": F.octet_length("__body")})
    owner = F.min(F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("key"), F.col("__row").alias("row")))
    owners = rows.where(f"__n >= {LEAST_REVISIT}").groupBy("__digest").agg(owner.alias("__owner"))
    rows = rows.join(owners, "__digest", "left")

    def record_id(k, row):
        return F.concat(F.lit("<urn:page:"), F.coalesce(k.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))

    revisit = F.coalesce(F.col("__owner.row") != F.col("__row"), F.lit(False))
    rows = rows.withColumns({
        "__revisit": revisit, "__id": record_id(F.col("__key"), F.col("__row")),
        "__refers": F.when(revisit, record_id(F.col("__owner.key"), F.col("__owner.row"))),
        "__block": F.when(revisit, F.lit("").cast("binary"))
                    .otherwise(F.concat(F.lit(HTTP_HEAD), chunked(F.col("__body"))).cast("binary"))})
    size = F.octet_length("__block")
    segments = F.greatest(F.lit(1), F.ceil(size / F.lit(segment_bytes)).cast("int"))
    rows = rows.withColumns({"__total": size, "__segments": segments}).drop("__body")
    rows = rows.select("*", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("__segments")),
        lambda i: F.struct(i.alias("no"), F.substring(F.col("__block"), (i - 1) * segment_bytes + 1, F.lit(segment_bytes)).alias("bytes"))
    )).alias("__part")).drop("__block")
    no, part = F.col("__part.no"), F.col("__part.bytes")
    split, first = F.col("__segments") > 1, no == 1
    kind = F.when(~first, "continuation").when(F.col("__revisit"), "revisit").otherwise("response")
    record = F.concat(
        F.lit(VERSION + CRLF), _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.when(first, F.col("__id")).otherwise(
            F.concat(F.substring_index("__id", ">", 1), F.lit(":"), no.cast("string"), F.lit(">")))),
        _field("WARC-Date", F.lit(DATE)), _field("WARC-Target-URI", F.col("__url")),
        _field("Content-Type", F.when(first & ~F.col("__revisit"), "application/http; msgtype=response")),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha256:"), F.col("__digest")))),
        _field("WARC-Payload-Length", F.when(first, F.col("__n"))),
        _field("WARC-Profile", F.when(F.col("__revisit"), REVISIT_PROFILE)),
        _field("WARC-Refers-To", F.when(first, F.col("__refers"))),
        _field("WARC-Segment-Number", F.when(split, no)),
        _field("WARC-Segment-Origin-ID", F.when(~first, F.col("__id"))),
        _field("WARC-Segment-Total-Length", F.when(split & (no == F.col("__segments")), F.col("__total"))),
        _field("Content-Length", F.octet_length(part)),
        F.lit(CRLF), part.cast("string"))
    return rows.select(record.alias("record"))


def write_warc(pages: DataFrame, path: str, key: str = "page_id", payload: str = "html", url: str = "url",
               segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write gzip archives below ``path`` on any file system that Spark writes to.

    The two blank lines that end a record are the line separator of Spark's text writer, so
    files are committed by task like any other output. A file is one gzip member; a long
    page's segments may lie in different files.
    """
    (warc_records(pages, key, payload, url, segment_bytes).write.option("lineSep", CRLF * 2)
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


RECORD_SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, payload_length long, "
                 "refers_to string, segment_number int, origin_id string, total_length long, block binary")


def parse_archive(data: bytes):
    """The records of one archive (plain, or gzip with one or many members), as header fields and block."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while True:
        while data[at: at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = data[end + 4: end + 4 + size]
        if len(block) != size:
            raise ValueError(f"record at byte {at} is cut short")
        yield fields, block
        at = end + 4 + size


def _parse(batches):
    def number(x):
        return None if x is None else int(x)

    for pdf in batches:
        for data in pdf["content"]:
            rows = []
            for f, block in parse_archive(data):
                rows.append((f["warc-type"], f["warc-record-id"], f.get("warc-target-uri"), f.get("warc-payload-digest"),
                             number(f.get("warc-payload-length")), f.get("warc-refers-to"), number(f.get("warc-segment-number")),
                             f.get("warc-segment-origin-id"), number(f.get("warc-segment-total-length")), block))
            yield pd.DataFrame(rows, columns=["record_type", "record_id", "target_uri", "payload_digest", "payload_length", "refers_to",
                                              "segment_number", "origin_id", "total_length", "block"]).astype(
                {"payload_length": "Int64", "segment_number": "Int32", "total_length": "Int64"})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, segments still apart."""
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(_parse, RECORD_SCHEMA)


def reassemble(records: DataFrame) -> DataFrame:
    """Logical records: continuations joined to their origin in segment order.

    ``complete`` is false where a segment is missing or repeated, or the joined length is
    not the total length that the last segment states. The segments of a group are those of
    one record; records that were not split are only passed on.
    """
    whole = records.where("segment_number is null").withColumn("complete", F.lit(True))
    parts = records.where("segment_number is not null").withColumn("__id", F.coalesce("origin_id", "record_id"))
    firsts = [F.max(F.when(F.col("segment_number") == 1, F.col(c))).alias(c)
              for c in ("record_type", "target_uri", "payload_digest", "payload_length", "refers_to")]
    joined = parts.groupBy("__id").agg(
        *firsts, F.max("total_length").alias("total_length"),
        F.sort_array(F.collect_list(F.struct("segment_number", "block"))).alias("__parts"))
    block = F.array_join(F.transform("__parts", lambda p: p["block"].cast("string")), "").cast("binary")
    numbers = F.transform("__parts", lambda p: p["segment_number"])
    complete = ((numbers == F.sequence(F.lit(1), F.size("__parts")))
                & (F.col("total_length") == F.octet_length("block")) & F.col("record_type").isNotNull())
    joined = joined.withColumn("block", block).withColumn("complete", F.coalesce(complete, F.lit(False)))
    columns = ["record_type", F.col("__id").alias("record_id"), "target_uri", "payload_digest", "payload_length", "refers_to", "block", "complete"]
    return whole.select("record_type", "record_id", "target_uri", "payload_digest", "payload_length", "refers_to", "block", "complete").union(
        joined.select(*columns))


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response block, with chunked framing decoded."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        piece = body[end + 2: end + 2 + size]
        if len(piece) != size or body[end + 2 + size: end + 4 + size] != b"\r\n":
            raise ValueError("chunk is cut short")
        out.append(piece)
        at = end + 4 + size


def _payloads(batches):
    for pdf in batches:
        sizes, digests = [], []
        for kind, block, size, digest in zip(pdf["record_type"], pdf["block"], pdf["payload_length"], pdf["payload_digest"]):
            said = digest.partition(":")[2]
            if kind == "response":
                body = http_payload(block)
                found = hashlib.sha256(body).hexdigest()
                if found != said or len(body) != size:
                    raise ValueError("payload does not match its record")
                size = len(body)
            sizes.append(int(size))
            digests.append(said)
        yield pd.DataFrame({"record_id": pdf["record_id"], "record_type": pdf["record_type"], "refers_to": pdf["refers_to"],
                            "target_uri": pdf["target_uri"], "payload_bytes": sizes, "payload_digest": digests})


def payloads(records: DataFrame) -> DataFrame:
    """Size and digest of each logical record's payload; of responses, checked against the bytes.

    An incomplete record is an error: nothing is dropped without a word. A revisit carries
    no payload, so its size and digest are those its record states.
    """
    checked = records.withColumn("block", F.when(F.col("complete"), F.col("block")).otherwise(
        F.raise_error(F.concat(F.lit("incomplete record "), F.col("record_id")))))
    return checked.select("record_id", "record_type", "refers_to", "target_uri", "payload_length", "payload_digest", "block").mapInPandas(
        _payloads, "record_id string, record_type string, refers_to string, target_uri string, payload_bytes long, payload_digest string")


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through archives and back.

    Defined cases: null html is an empty payload; rows that share page_id and payload are
    told apart by scan position (one is the response); null keys come back null and are
    owners only of payloads without a keyed page; line breaks in a URL become a space; an
    empty table gives no rows.
    """
    pages = table(spark, sf_dir, "pages")
    path = scratch(spark, "warc")
    write_warc(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()

    def page(c):
        return F.nullif(F.regexp_extract(c, "^<urn:page:(.*):\\d+>$", 1), F.lit("")).cast(kind)

    return payloads(reassemble(read_warc(spark, path))).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE = f"""
SELECT page_id, strlen(p) AS payload_bytes, sha256(p) AS payload_digest,
       CASE WHEN strlen(p) >= {LEAST_REVISIT} AND page_id <> min(page_id) OVER g THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(p) >= {LEAST_REVISIT} AND page_id <> min(page_id) OVER g THEN min(page_id) OVER g END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS p FROM pages) WINDOW g AS (PARTITION BY p)
"""
