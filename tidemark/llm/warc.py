"""Legacy web archives to WARC: ARC volumes are parsed by their version's header line and declared lengths, and equivalent
WARC records are synthesised: identifiers, timestamps, types and digests.

An archive volume is the output of one task, written by Spark's text writer: a record's trailer (one line feed in ARC, two empty
lines in WARC) is the writer's line separator, so volumes are plain ``.arc.gz`` and ``.warc.gz`` streams. They are read as
binary files and decompressed as a stream, record by record. Volumes are as large as input splits, so
``spark.sql.files.maxPartitionBytes`` bounds them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.session import run_folder

#: The field lines of the two ARC versions, and the profile of a revisit.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_END = "\r\n\r\n"
FAST = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

RECORD = ("record_id string, warc_type string, page_id long, uri string, ip string, warc_date string, content_type string, "
          "payload_bytes long, payload_digest string, block_digest string, head_bytes long, block binary")


# ---- ARC out ---------------------------------------------------------------------------------------------------------

def write_arc(pages: DataFrame, path: str, archive_date: str = "20240101000000") -> None:
    """``pages`` (page_id, url, html) as ARC volumes; even tasks write version 1, odd ones version 2.

    A null html is an empty payload, a null url is "-"; white space in a url is percent-encoded. The page_id travels as an HTTP header.
    """
    def run(batches):
        number = TaskContext.get().partitionId()
        version = 1 + number % 2
        body = f"{version} 0 tidemark\n{ARC_FIELDS[version]}\n"
        opening = f"filedesc://volume-{number:05d}.arc 0.0.0.0 {archive_date} text/plain"
        opening += f" 200 - - 0 volume-{number:05d}.arc" if version == 2 else ""
        yield pa.RecordBatch.from_pydict({"value": [f"{opening} {len(body)}\n{body}"]})
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            values = []
            for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                html = html or ""
                length = len(html.encode("utf-8"))
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += f"X-Page-Id: {page}\r\n" if page is not None else ""
                head += f"Content-Length: {length}\r\n\r\n"
                url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"
                middle = f" 200 - - 0 volume-{number:05d}.arc" if version == 2 else ""
                values.append(f"{url} 0.0.0.0 {archive_date} text/html{middle} {len(head) + length}\n{head}{html}")
            yield pa.RecordBatch.from_pydict({"value": values}, schema=pa.schema([("value", pa.string())]))

    pages.select("page_id", "url", "html").mapInArrow(run, "value string").write.options(**FAST).text(path)


# ---- ARC in ----------------------------------------------------------------------------------------------------------

def warc_date(digits: str, default: str = "1970-01-01T00:00:00Z") -> str:
    """An ARC date of 14 digits, or of 12 without seconds, as a WARC date."""
    if not re.fullmatch(r"\d{12}|\d{14}", digits):
        return default
    d = digits.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def split_http(block: bytes) -> int:
    """Length of the HTTP head with its empty line; 0 if the block does not start with one."""
    if not block.startswith(b"HTTP/"):
        return 0
    ends = [at + n for n, at in ((4, block.find(b"\r\n\r\n")), (2, block.find(b"\n\n"))) if at >= 0]
    return min(ends) if ends else 0


def arc_records(stream):
    """(fields, block) of each record of a volume; the first is the version block, which names the fields of all others.

    A header is read from its right end by the version's number of fields, so a url may hold spaces. Nothing is guessed from content:
    the declared length says where a record ends. A volume cut short ends at the last whole record.
    """
    names, first = ARC_FIELDS[1].split(" "), True
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        if first:
            length = int(line.rsplit(b" ", 1)[1])
            block = stream.read(length)
            version_line, field_line = (block.split(b"\n") + [b""])[:2]
            names = field_line.decode("latin-1").strip().split(" ") if field_line.strip() else ARC_FIELDS[int(version_line.split()[0])].split(" ")
            first = False
            yield {"URL": line.split(b" ", 1)[0].decode("latin-1"), "version": version_line.split()[0].decode()}, block
            continue
        parts = line.rsplit(b" ", len(names) - 1)
        fields = dict(zip(names, (p.decode("utf-8", "replace") for p in parts)))
        length = int(fields["Archive-length"])
        block = stream.read(length)
        if len(block) < length:
            return
        yield fields, block


def read_arc(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """The records of ARC volumes as WARC records (see ``RECORD``), version blocks left out.

    Identifiers derive from volume and position, so they are the same whenever a volume is read. A block that starts with an HTTP
    head is a response, whose payload is what follows; any other is a resource.
    """
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                stream, rows, held, volume, number = gzip.open(io.BytesIO(content.as_py())), [], 0, "", 0
                for fields, block in arc_records(io.BufferedReader(stream)):
                    number += 1
                    if "version" in fields:
                        volume = fields["URL"]
                        continue
                    head = split_http(block)
                    page = re.search(rb"^X-Page-Id: (-?\d+)\r?$", block[:head], re.M)
                    payload = memoryview(block)[head:]
                    block_sha = hashlib.sha1(block).digest()
                    rows.append((
                        f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{volume}#{number}')}>", "response" if head else "resource",
                        int(page[1]) if page else None, fields["URL"], fields["IP-address"], warc_date(fields["Archive-date"]),
                        "application/http; msgtype=response" if head else fields["Content-type"], len(payload),
                        hashlib.sha1(payload).hexdigest(), base64.b32encode(block_sha).decode(), head, block if with_block else b""))
                    held += len(block)
                    if len(rows) >= 1000 or held > 8_000_000:
                        yield to_batch(rows, RECORD)
                        rows, held = [], 0
                yield to_batch(rows, RECORD)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def to_batch(rows: list[tuple], ddl: str):
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


# ---- WARC ------------------------------------------------------------------------------------------------------------

def find_revisits(records: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """record_id, refers_to and the referred record's uri and date, for each record that repeats another's payload.

    Of records with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id (then record_id) is the one
    referred to. Only digests and identifiers are grouped, after partial aggregation.
    """
    large = records.where((F.col("payload_bytes") >= least_bytes) & (F.col("warc_type") == "response"))
    first = large.groupBy("payload_digest", "payload_bytes").agg(
        F.max_by(F.struct("record_id", "uri", "warc_date"), F.struct("page_id", "record_id")).alias("first"), F.count(F.lit(1)).alias("n"))
    return (large.join(first.where("n > 1"), ["payload_digest", "payload_bytes"]).where(F.col("record_id") != F.col("first.record_id"))
            .select("record_id", F.col("first.record_id").alias("refers_to"), F.col("first.uri").alias("refers_uri"),
                    F.col("first.warc_date").alias("refers_date")))


def hex_to_base32(digest: str) -> Column:
    """Hexadecimal SHA-1 to base 32, five hex digits to four characters."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    characters = []
    for group in range(8):
        number = F.conv(F.substring(digest, group * 5 + 1, 5), 16, 10).cast("int")
        for i in range(4):
            characters.append(F.substring(F.lit(alphabet), F.shiftright(number, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*characters)


def write_warc(records: DataFrame, revisits: DataFrame, path: str) -> None:
    """WARC 1.1 volumes; a revisit keeps its HTTP head and refers to the record with its payload."""
    joined = records.join(revisits, "record_id", "left")
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.substring("block", F.lit(1), F.col("head_bytes").cast("int"))).otherwise(F.col("block"))

    def line(name, value, when=None):
        text = F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        return F.when(when, text).otherwise("") if when is not None else text

    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise(F.col("warc_type"))),
        line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("warc_date")), line("WARC-Target-URI", F.col("uri")),
        line("WARC-IP-Address", F.col("ip")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), hex_to_base32("payload_digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.col("block_digest")), ~revisit),
        line("WARC-Profile", F.lit(REVISIT_PROFILE), revisit), line("WARC-Refers-To", F.col("refers_to"), revisit),
        line("WARC-Refers-To-Target-URI", F.col("refers_uri"), revisit), line("WARC-Refers-To-Date", F.col("refers_date"), revisit),
        line("Content-Type", F.col("content_type")), F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(WARC_END))
    joined.select(F.concat(head, block.cast("string")).alias("value")).write.options(**FAST).option("lineSep", WARC_END).text(path)


READ = "record_id string, record_type string, page_id long, payload_bytes long, payload_digest string, refers_id string"


def warc_records(stream):
    """(header fields, block) of each record, by declared lengths."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC volumes: identifiers, types, sizes and digests of payloads (see ``READ``).

    A response's payload is hashed again and must have the digest that its header states. A revisit has no payload of its own: its
    size is null here, its digest is the header's.
    """
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in warc_records(io.BufferedReader(gzip.open(io.BytesIO(content.as_py())))):
                    kind, head = fields["warc-type"], split_http(block)
                    page = re.search(rb"^X-Page-Id: (-?\d+)\r?$", block[:head], re.M)
                    stated = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                    if kind != "revisit" and hashlib.sha1(memoryview(block)[head:]).hexdigest() != stated:
                        raise ValueError(f"{fields['warc-record-id']}: the payload does not have the digest stated")
                    rows.append((fields["warc-record-id"], kind, int(page[1]) if page else None,
                                 None if kind == "revisit" else len(block) - head, stated, fields.get("warc-refers-to")))
                    if len(rows) >= 10_000:
                        yield to_batch(rows, READ)
                        rows = []
                yield to_batch(rows, READ)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, READ)


def convert(spark: SparkSession, arc: str, warc: str, least_bytes: int = 1000) -> None:
    """ARC volumes in folder ``arc`` to WARC volumes in the new folder ``warc``."""
    records = common.pin(read_arc(spark, arc, with_block=False).drop("block"), "arc-records")
    revisits = common.pin(find_revisits(records, least_bytes), "revisits")
    write_warc(read_arc(spark, arc), revisits, warc)


def archive(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``pages`` through ARC and WARC and back: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id.

    One row per row of ``pages``, also for rows that repeat a page_id (of those with one payload, one record is the response); null
    and empty html is an empty payload, null urls and page_ids stay possible; an empty table gives an empty result; other
    columns are not read. Payloads under ``least_bytes`` bytes never become revisits.
    """
    spark = pages.sparkSession
    arc, warc = run_folder(spark, "arc"), run_folder(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, least_bytes)
    back = common.pin(read_warc(spark, warc), "warc-records")
    targets = back.where(F.col("record_type") != "revisit").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("target_page"), F.col("payload_bytes").alias("target_bytes"))
    revisits = back.where(F.col("record_type") == "revisit").join(targets, "refers_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    own = back.where(F.col("record_type") != "revisit").withColumn("refers_to", F.lit(None).cast("long"))
    resolved = revisits.drop("payload_bytes").withColumnRenamed("target_bytes", "payload_bytes").withColumnRenamed("target_page", "refers_to")
    return own.select(columns).unionByName(resolved.select(columns))
