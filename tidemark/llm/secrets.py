"""Secret scans: Aho-Corasick keywords find where to look, anchored expressions decide there, checksums settle the rest.

Kinds ``assign``, ``access`` and ``hex`` are the base. Two more carry a checksum in their last six characters, the CRC-32
of what stands before it in base 62: ``github`` (``ghp_``, ``gho_``, ``ghu_``, ``ghs_``, ``ghr_``) and ``npm`` (``npm_``). These
are reported only when the checksum holds.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common

KINDS = ("assign", "access", "hex", "github", "npm")
#: The words that start an assignment, and the token prefixes with a checksum.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
CHECKED = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
TOKEN = re.compile(rb"(?:gh[opsur]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def crc_base62(body: bytes) -> bytes:
    value, digits = zlib.crc32(body), bytearray()
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(BASE62[digit])
    return bytes(reversed(digits))


def keyword_automaton():
    """One automaton over lower-case bytes, as Latin-1 text; the value of a hit is its rule and its length."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        automaton.add_word(word, ("assign", len(word)))
    automaton.add_word("akia", ("access", 4))
    for prefix in CHECKED:
        automaton.add_word(prefix, ("checked", len(prefix)))
    automaton.make_automaton()
    return automaton


def find(data: bytes, automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, by start and then kind.

    Hits come by their ends; a shorter keyword inside a longer one of the same rule does not occur, so starts rise within a rule.
    A rule's next match begins at or after the end of its last, kept or not, as a leftmost scan of that rule would have it.
    """
    spans, ends = [], {"assign": 0, "access": 0, "checked": 0}
    lowered = data.lower().decode("latin-1")
    for last, (rule, length) in automaton.iter(lowered):
        start = last + 1 - length
        if start < ends[rule]:
            continue
        match = {"assign": ASSIGN, "access": ACCESS, "checked": TOKEN}[rule].match(data, start)
        if match is None:
            continue
        ends[rule] = match.end()
        if rule == "assign":
            if match.end(1) - match.start(1) >= 6:
                spans.append((start, match.end(), "assign"))
        elif rule == "access":
            if match.end() - start >= 20:
                spans.append((start, match.end(), "access"))
        elif crc_base62(match.group(1)) == match.group(2):
            spans.append((start, match.end(), CHECKED[match.group()[:4].decode()]))
    # No keyword leads to bare hexadecimal runs; the expression itself is the scan.
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(data)]
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def to_code_points(data: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte offsets to code points; a span is ASCII, so its length stays."""
    out, at, points = [], 0, 0
    for start, end, kind in spans:
        points += len(data[at:start].decode("utf-8"))
        at = start
        out.append((points, points + end - start, kind))
    return out


def scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` of ``docs`` (all by default) and ``secret_spans``: (kind, start, end) in code points, never null.

    Spans are ordered by start, then kind. Null and empty texts give an empty array; whole texts are scanned, whatever their
    length, and rows are independent, so repeated rows, ties and empty tables need no rule. Other columns pass through; a
    column already called ``secret_spans`` is replaced.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() != "secret_spans"]
    (whole_text,) = common.fresh(docs, "bytes")
    rows = docs.select(*carry, common.text_bytes(text).alias(whole_text))

    def run(batches):
        automaton = keyword_automaton()
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            found = []
            for value in batch.column(whole_text):
                data = value.as_py()
                found.append([{"kind": k, "start": s, "end": e} for s, e, k in to_code_points(data, find(data, automaton))])
            kept = batch.drop_columns([whole_text])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found, span)], names=[*kept.schema.names, "secret_spans"])

    out = T.StructType([*rows.schema.fields[:-1], T.StructField("secret_spans", SPANS)])
    return rows.mapInArrow(run, out)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts per base kind, the base spans' hash, and all spans as one string."""
    spans = F.col("secret_spans")

    def joined(array):
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))
    return scan(docs, carry=["doc_id"]).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
