"""Legacy ARC archives into WARC, and back into rows.

An ARC file starts with a version block that names the fields of the one-line record headers; each header ends with the length
of the record that follows. The converter reads both header versions, and synthesises what WARC wants and ARC lacks: a record id
(from the record's url, address, date, headers and payload digest, so reruns agree whatever the files are called; only records
alike in all of these take theirs from file and offset), an ISO timestamp, the record type, payload and block digests. Of records with
equal payloads the one with the smallest order number becomes the response, the others revisit it and keep only their
HTTP headers.

Archives are written by Spark's text writer (a WARC record ends with two line breaks, an ARC record with one, so
the separator closes the record), hence on any file system and with its commit protocol. They are read as
whole files, one per task's output, and parsed as streams.

Defined cases: a null or empty body is a payload of 0 bytes; a null or empty url is written as ``urn:none``; blanks and control
characters in urls are escaped; a record cut off by its file's end is kept and marked truncated; a header line that
does not parse is skipped; rows with one order number and one payload are all responses; a null order number comes
last; an empty table gives no archive and no row; very long bodies are kept whole; only id, url and body are read, so no
further column can clash. An archive is one value while it is parsed: files of 2 GB and more must be split before.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import shared_dir
from tidemark.llm.common import bounded_batches, longs, materialize

#: Header fields of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ORDER_HEADER = "X-Order"
FIRST_IN_TASK = (1 << 33) - 1
#: Decisions (revisits, repeated records) that are broadcast: at most so many, some 60 MB.
BROADCAST_REVISITS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _row_in_task() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(FIRST_IN_TASK))


def write_arc(pages: DataFrame, path: str, version: int = 1, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> None:
    """Pages as gzipped ARC files of the given version, one per task, in DataFrame operations."""
    page_id, url = F.col(f"`{id_col}`"), F.col(f"`{url_col}`")
    body = F.coalesce(F.col(f"`{body_col}`"), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit(f"\r\n{ORDER_HEADER}: "), F.coalesce(page_id.cast("string"), F.lit("")), F.lit("\r\n\r\n"))
    when = F.date_format(F.timestamp_seconds(F.lit(1_262_304_000) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(86_400_000))), "yyyyMMddHHmmss")
    safe = F.when(F.length(url) > 0, F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")).otherwise(F.lit("urn:none"))
    length = (F.octet_length(head) + F.octet_length(body)).cast("string")
    middle = [F.lit("text/html")] if version == 1 else [F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc")]
    line = F.concat_ws(" ", safe, F.lit("0.0.0.0"), when, *middle, length)
    about = f"{version} 0 pages\n{ARC_FIELDS[version]}\n"
    block = f"filedesc://pages.arc 0.0.0.0 20100101000000 text/plain {'' if version == 1 else '200 - - 0 pages.arc '}{len(about)}\n{about}\n"
    record = F.concat(F.when(_row_in_task() == 0, F.lit(block)).otherwise(F.lit("")), line, F.lit("\n"), head, body)
    pages.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(path)


def read_arc(stream: io.BufferedIOBase, name: str) -> Iterator[dict]:
    """Records of one ARC file."""
    fields, at = ARC_FIELDS[1].split(), 0
    while line := stream.readline():
        start, at = at, at + len(line)
        text = line.strip().decode("utf-8", "replace")
        if not text:
            continue
        if text.startswith("filedesc://"):
            length = _number(text.rsplit(" ", 1)[-1])
            about = stream.read(length or 0)
            at += len(about)
            lines = about.decode("utf-8", "replace").split("\n")
            version = _number(lines[0].split(" ")[0]) or 1
            named = lines[1].split() if len(lines) > 1 else []
            fields = named if "Archive-length" in named else ARC_FIELDS.get(version, ARC_FIELDS[1]).split()
            continue
        values = text.rsplit(" ", len(fields) - 1)
        length = _number(values[-1])
        if len(values) < len(fields) or length is None:
            continue
        block = stream.read(length)
        at += len(block)
        yield dict(zip(fields, values, strict=True)) | {"offset": start, "file": name, "block": block, "truncated": len(block) < length}


def _number(text: str) -> int | None:
    return int(text) if re.fullmatch(r"\d+", text) else None


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with the empty line that ends them, and the payload. A block without HTTP headers is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    if found := re.search(rb"\r?\n\r?\n", block):
        return block[:found.end()], block[found.end():]
    return block, b""


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(stamp: str) -> str:
    """An ARC date of 4 to 14 digits as a WARC timestamp; what is missing is the earliest."""
    digits = re.sub(r"\D", "", stamp)[:14]
    full = digits + "00000101000000"[len(digits):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


RECORD = ("place string, record_id string, order_no long, uri string, ip string, date string, http boolean, payload_digest string, payload_bytes long,"
          " truncated boolean")


def parse_arcs(spark: SparkSession, path: str, with_content: bool) -> DataFrame:
    """Records of all ARC files below ``path`` with their WARC fields; the bytes only if they are wanted."""
    bounded_batches(spark)
    schema = RECORD + (", head binary, payload binary, block_digest string, head_digest string" if with_content else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows, held = [], 0
                for record in read_arc(_open(content), file):
                    rows.append(_warc_fields(record, with_content))
                    held += len(record["block"])
                    if held > 8_000_000 or len(rows) >= 5000:
                        yield _records(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _records(rows, names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def _open(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if content[:2] == b"\x1f\x8b" else raw


def _warc_fields(record: dict, with_content: bool) -> tuple:
    head, payload = split_http(record["block"])
    order = http_field(head, ORDER_HEADER)
    digest = base32(payload)
    name = " ".join([record["URL"], record["IP-address"], record["Archive-date"], digest, head.decode("latin-1")])
    row = (_uuid(f"{record['file']}#{record['offset']}"), f"<urn:uuid:{_uuid(name)}>", _signed(order), record["URL"], record["IP-address"],
           iso_date(record["Archive-date"]), bool(head), digest, len(payload), record["truncated"])
    return row + ((head, payload, base32(record["block"]), base32(head)) if with_content else ())


def _uuid(name: str) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def _signed(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def _records(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).assign(order_no=longs(r[2] for r in rows))


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_revisit_bytes: int = 0) -> None:
    """All ARC files below ``arc_path`` as WARC files in ``warc_path``.

    The files are parsed twice: once for the small columns, from which each payload's first record follows, and once
    for the bytes. What decides meets the bytes by place (file and offset), which is unique, so copies of one payload stay
    spread; few decisions travel to the bytes, many meet them in a shuffle.
    """
    slim = materialize(parse_arcs(spark, arc_path, with_content=False).select(
        "place", "record_id", "order_no", "uri", "date", "payload_digest", "payload_bytes"), "warc-records")
    repeated = materialize(slim.groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1").select("record_id"), "warc-repeated")
    # records alike in all that makes an id are told apart by their place
    renamed = slim.join(repeated, "record_id", "left_semi").select("place", F.concat(F.lit("<urn:uuid:"), "place", F.lit(">")).alias("own_id"))
    any_repeated = not repeated.isEmpty()
    if any_repeated:
        renamed = materialize(renamed, "warc-renamed")
        slim = slim.join(renamed, "place", "left").withColumn("record_id", F.coalesce("own_id", "record_id")).drop("own_id")
    large = slim.where(F.col("payload_bytes") >= min_revisit_bytes)
    rank = F.struct(F.coalesce("order_no", F.lit((1 << 63) - 1)).alias("o"), "record_id")
    first = (large.groupBy("payload_digest", "payload_bytes").agg(F.min_by(F.struct("record_id", "order_no", "uri", "date"), rank).alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    known = large.select("place", "record_id", "order_no", "payload_digest", "payload_bytes")
    decided = (known.join(first, ["payload_digest", "payload_bytes"])
               .where((F.col("first.record_id") != F.col("record_id")) & ~F.col("order_no").eqNullSafe(F.col("first.order_no")))
               .select("place", F.col("first.record_id").alias("of_id"), F.col("first.uri").alias("of_uri"), F.col("first.date").alias("of_date")))
    decided = decided.join(renamed, "place", "full") if any_repeated else decided.withColumn("own_id", F.lit(None).cast("string"))
    decided = materialize(decided, "warc-decided")
    if decided.count() <= BROADCAST_REVISITS:
        decided = F.broadcast(decided)
    full = parse_arcs(spark, arc_path, with_content=True).join(decided, "place", "left").withColumn("record_id", F.coalesce("own_id", "record_id"))
    again = F.col("of_id").isNotNull()
    kind = F.when(again, "revisit").when(F.col("http"), "response").otherwise("resource")
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    lines = [
        F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), "record_id"), F.concat(F.lit("WARC-Date: "), "date"),
        F.concat(F.lit("WARC-Target-URI: "), "uri"), F.concat(F.lit("WARC-IP-Address: "), "ip"),
        F.when(again, F.lit(f"WARC-Profile: {PROFILE}")), F.concat(F.lit("WARC-Refers-To: "), "of_id"),
        F.concat(F.lit("WARC-Refers-To-Target-URI: "), "of_uri"), F.concat(F.lit("WARC-Refers-To-Date: "), "of_date"),
        F.concat(F.lit("Content-Type: "), F.when(F.col("http"), "application/http; msgtype=response").otherwise("text/plain")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), F.when(again, F.col("head_digest")).otherwise(F.col("block_digest"))),
        F.when(F.col("truncated") & ~again, F.lit("WARC-Truncated: unspecified")),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    about = "software: arc converter\r\nformat: WARC File Format 1.1\r\n"
    info_id = F.regexp_replace(F.md5(F.concat(F.lit("warcinfo "), "record_id").cast("binary")), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    info = F.concat(F.lit("WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:"), info_id, F.lit(
        f">\r\nWARC-Date: 2010-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"))
    text = F.concat(F.when(_row_in_task() == 0, info).otherwise(F.lit("")), F.lit("WARC/1.1\r\n"), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))
    # concat of binaries keeps the bytes as they are, whatever their encoding
    value = F.concat(text.cast("binary"), block).cast("string")
    full.select(value.alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(warc_path)


def read_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of one WARC file."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields.get("content-length", "0")))


READ = "order_no long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_id string, uri string, intact boolean"


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files below ``path`` (information records aside). Sizes and digests of
    whole records are taken anew from their bytes; ``intact`` says whether the stored digests agree."""
    bounded_batches(spark)
    names = [c.split()[0] for c in READ.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for fields, block in read_warc(_open(content)):
                    if fields.get("warc-type") == "warcinfo":
                        continue
                    head, payload = split_http(block)
                    stored = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    again = fields.get("warc-type") == "revisit"
                    digest = stored if again else base32(payload)
                    size = _signed(http_field(head, "Content-Length")) if again else len(payload)
                    rows.append((_signed(http_field(head, ORDER_HEADER)), size, digest, fields.get("warc-type"), fields.get("warc-record-id"),
                                 fields.get("warc-refers-to"), fields.get("warc-target-uri"),
                                 digest == stored and fields.get("warc-block-digest") == f"sha1:{base32(block)}"))
                if rows:
                    yield pd.DataFrame(rows, columns=names).assign(order_no=longs(r[0] for r in rows), payload_bytes=longs(r[1] for r in rows))

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, READ)


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Pages into ARC files of both versions, these into WARC, and the WARC files back into rows."""
    spark = pages.sparkSession
    home = shared_dir(spark, "archives")
    half = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(2))
    for version in (1, 2):
        write_arc(pages.where(half == version - 1), f"{home}/arc/v{version}", version)
    convert(spark, f"{home}/arc/*", f"{home}/warc", min_revisit_bytes)
    back = materialize(read_back(spark, f"{home}/warc"), "warc-rows")
    answer = back.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("order_no").alias("refers_to"))
    return (back.join(answer, "refers_to_id", "left")
            .select(F.col("order_no").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "intact"))
