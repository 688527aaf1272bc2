"""WARC archives without repeated payloads: revisit records, resolved by the payload's digest.

Headers alone are shuffled by digest to find each payload's original; every other record of it becomes a
revisit that names the original. One copy of each payload then meets its record, and archives are written
with fresh headers. Records are gzip members of their own, as archive readers expect. Such a member ends with
the top byte of its length, which is 0 below 16 MiB; so a text file whose lines, members without that byte,
end in "\\0" is an archive, and Spark's own writer and reader carry it to and from any store.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, small_batches

#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"

#: Bytes of a record in one gzip member; more are told off by an empty member, which ends with 0 again.
MEMBER = 1 << 24
LEVEL = 6
#: Packed bytes handed to the unpacker at a time, and bytes after which a batch of rows is passed on.
PIECE, YIELDED = 1 << 14, 4_000_000
RECORD = "record_id STRING, record_type STRING, page_id LONG, url STRING, date STRING, payload_bytes LONG, payload_digest STRING, refers_to_id STRING, payload BINARY"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 characters of base 32: five hex digits are four of them."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column, url: Column, digest: Column, copy: Column) -> Column:
    """The same name for the same record whenever it is made, so a repeated task writes the same bytes."""
    h = F.md5(F.to_json(F.struct(page_id.alias("p"), url.alias("u"), digest.alias("d"), copy.alias("c"))).cast("binary"))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def page_headers(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload_digest, payload_bytes, n): a header per page; ``n`` rows that agree in all are one."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    heads = pages.select("page_id", "url", base32_sha1(payload).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    return heads.groupBy(*heads.columns).agg(F.count(F.lit(1)).alias("n"))


def resolve_revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A record per page: ``response`` for the largest page_id of its payload, else ``revisit`` of that one.

    Payloads below ``least_bytes`` are not compared; all their records are responses. Of equal largest ids the
    one of the largest url is the response, of rows that agree in both the first copy.
    """
    original = (
        headers.where(F.col("payload_bytes") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max(F.struct("page_id", "url")).alias("_first"))
    )
    found = headers.join(original, F.col("payload_digest") == F.col("_digest"), "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    itself = F.col("page_id").eqNullSafe(F.col("_first.page_id")) & F.col("url").eqNullSafe(F.col("_first.url")) & (F.col("copy") == 1)
    revisit = F.col("_first").isNotNull() & ~itself
    return found.select(
        "page_id", "url", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("page_id"), F.col("url"), F.col("payload_digest"), F.col("copy")).alias("record_id"),
        F.when(revisit, _record_id(F.col("_first.page_id"), F.col("_first.url"), F.col("payload_digest"), F.lit(1).cast("long"))).alias("refers_to_id"),
        F.when(revisit, F.col("_first.url")).alias("refers_to_url"),
    )


def _uri(url: str) -> str:
    """A URI that keeps to its line: white space and characters that don't print are percent-encoded."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_bytes(row: dict, date: str) -> bytes:
    """One record with its headers, its HTTP block (headers alone in a revisit) and the two line ends after it."""
    payload = row["payload"] if row["record_type"] == "response" else b""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode() + payload
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date), ("Content-Type", HTTP),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _uri(row["url"])))
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", row["page_id"]))
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{row['refers_to_id']}>"), ("WARC-Refers-To-Date", date)]
        if row["refers_to_url"] is not None:
            fields.append(("WARC-Refers-To-Target-URI", _uri(row["refers_to_url"])))
    fields.append(("Content-Length", str(len(block))))
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """``data`` as gzip whose last byte is 0; the same data always give the same bytes."""
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = pack.compress(data) + pack.flush()
    if len(data) >= MEMBER:
        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += pack.compress(b"") + pack.flush()
    return out


def _members(date: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held, size = [], 0
            for row in pdf.to_dict("records"):
                held.append(gzip_member(record_bytes(row, date))[:-1])
                size += len(held[-1])
                if size >= YIELDED:
                    yield pd.DataFrame({"member": held})
                    held, size = [], 0
            yield pd.DataFrame({"member": held})

    return run


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str | None = None) -> None:
    """Writes a record per page below ``path``, each payload once; ``date`` is that of all records, now by default.

    One copy of a payload is taken by an aggregate that tasks begin before the exchange, so copies of one page
    never meet; revisits carry no payload. Files are named as Spark names them.
    """
    spark = pages.sparkSession
    small_batches(spark)
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    scratch = Scratch(spark, "warc-headers")
    records = scratch.table(resolve_revisits(page_headers(pages), least_bytes).withColumn("page_id", F.col("page_id").cast("string")), "records", few=True)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    payloads = pages.select(base32_sha1(payload).alias("_digest"), payload.alias("payload")).groupBy("_digest").agg(F.first("payload").alias("payload"))
    responses = records.where("record_type = 'response'").join(payloads, F.col("payload_digest") == F.col("_digest")).drop("_digest")
    revisits = records.where("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    members = responses.unionByName(revisits).mapInPandas(_members(date), "member BINARY")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("compression", "none").text(path)
    scratch.drop("records")


def inflate(data: bytes) -> Iterator[bytes]:
    """The members of an archive, one after the other, unpacked; zeros between them are passed over."""
    view, at = memoryview(data), 0
    while at < len(view):
        if view[at] == 0:
            at += 1
            continue
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if at >= len(view):
                raise ValueError("a gzip member is cut short")
            piece = view[at : at + PIECE]
            out.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        yield b"".join(out)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record in unpacked archive bytes."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record begins at byte {at}")
        lines = data[at:end].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start, n = end + 4, int(fields["content-length"])
        if data[start + n : start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield fields, data[start : start + n]
        at = start + n + 4


def _read(keep_payload: bool):
    def record(fields: dict[str, str], block: bytes) -> dict:
        named = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        body = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
        own = None if body is None else base64.b32encode(hashlib.sha1(body).digest()).decode()
        if own and named and own != named:
            raise ValueError(f"the payload of {fields['warc-record-id']} is not the one its header names")
        return {
            "record_id": fields["warc-record-id"].strip("<>"), "record_type": fields["warc-type"], "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
            "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "payload_bytes": None if body is None else len(body), "payload_digest": own or named,
            "refers_to_id": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None, "payload": body if keep_payload else None,
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for pdf in batches:
            for content in pdf["content"]:
                held, size = [], 0
                for member in inflate(content):
                    for fields, block in parse_records(member):
                        held.append(record(fields, block))
                        size += len(block) if keep_payload else 0
                    if len(held) >= 1000 or size >= YIELDED:
                        yield _frame(held, names)
                        held, size = [], 0
                if held:
                    yield _frame(held, names)

    return run


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "payload_bytes"):
        pdf[c] = pd.array([r[c] for r in rows], dtype="Int64")
    return pdf


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Every record of the archives below ``path``; payloads, checked against their digests, only if asked for.

    A file is read whole by one task: ``write_archives`` makes files of about a shuffle partition each.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_read(payload), RECORD)


def follow_revisits(records: DataFrame) -> DataFrame:
    """Archived records with what each revisit takes from its original: size, digest, and its page.

    Only headers are joined; the many revisits of one original are split by adaptive execution. A revisit whose
    original is in none of the archives keeps nulls.
    """
    original = records.where("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    met = records.where("record_type = 'revisit'").join(original, F.col("refers_to_id") == F.col("_id"), "left")
    revisits = met.select("page_id", F.col("_bytes").alias("payload_bytes"), F.coalesce("_digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to")
    itself = records.where("record_type <> 'revisit'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return itself.unionByName(revisits)


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages as archives, reads them back, and gives one row per page: what its record holds.

    Null html is the empty payload, which is compared like any other. A null page_id counts as smaller than
    any other and stays null; a null url leaves its header out. Rows that repeat an id with other payloads are
    records of their own; of rows that agree in all, one is the response at most. Very long payloads are
    written and read whole. An empty table gives no rows; other columns are not looked at.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    path = f"{scratch.root}/archives"
    write_archives(pages, path, least_bytes)
    return follow_revisits(scratch.table(read_archives(pages.sparkSession, path).drop("payload"), "records"))
