"""WARC archives: writing with payload deduplication, reading by boundary-chain verification.

Writing is one Spark text write whose line separator closes each record, so it reaches any
store that Spark does. Reading cuts files at the magic string, with Spark's text reader, whose tasks read ranges of
files of any size. It never trusts the magic string alone: each task emits every place where a record could start
together with where its successor would start, relative to its range; sums of the ranges' bytes give places in the file,
and pointer jumping from the file's start keeps only the places on that chain. A magic string inside a payload is
thereby no record, however well formed what follows it is; the few payloads that hold one are put together from
their segments. (Headers must not hold one; the writer escapes it in URLs.)

Defined cases: a null html is an empty payload; a null page_id is written as an empty id and
comes back as null (and is never referred to unless its whole group has none); repeated rows
are written and read back each, repeated ids with different payloads too; a record is held whole by one task, so that very long payloads need
memory for themselves only; a record that a file's end cuts off is none; an empty table gives an empty archive and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, shared_dir, table

MAGIC = "WARC/1.0\r\n"
#: Rows of (page_id, digest, referred page) that may be broadcast; 48 bytes each. Beyond it the join shuffles.
BROADCAST_REVISITS = 100_000
RECORDS_PER_FILE = 2000
_BASE32HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Segments of payloads that hold the magic string which may be broadcast to pick them from the files; beyond it the join shuffles.
BROADCAST_SEGMENTS = 100_000
_FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_SEGMENT = f"path string, block long, n long, at long, length long, start long, successor long, {_FIELDS}"
_CHAIN = f"{_SEGMENT}, kept boolean, owner long"


def sha1_base32(column):
    """Upper-case base32 of the SHA-1 of a binary column, in built-in functions only."""
    digest = F.sha1(column)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _BASE32HEX, _BASE32)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages(page_id, url, html) as page_id, url, html, digest, refers_to (null for a response).

    Groups of equal payloads are found on (digest, length) alone; only the rows that revisit
    another are joined back to the payloads.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        sha1_base32(body).alias("digest"),
    )
    keys = full.where(F.octet_length("html") >= min_bytes).select("page_id", "digest")
    first = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    again = keys.join(first, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()
    again = saved(again, "warc-revisits")
    few = again.limit(BROADCAST_REVISITS + 1).count() <= BROADCAST_REVISITS
    return full.join(F.broadcast(again) if few else again, ["page_id", "digest"], "left")


def _address(url):
    """A URL as one header line that holds no magic string."""
    return F.regexp_replace(F.regexp_replace(url, r"[\r\n]", ""), r"WARC/1\.0$", "WARC/1.%30")


def write_archives(records: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """records as with_revisits() returns them, one WARC record each, to files below path."""
    size = F.octet_length("html")
    is_revisit = F.col("refers_to").isNotNull()
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(">\r\nWARC-Target-URI: "), _address(F.coalesce("url", F.lit(""))),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(is_revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
            F.col("refers_to").cast("string"), F.lit(">\r\nX-Payload-Length: "), size.cast("string"),
        )).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(is_revisit, F.lit("0")).otherwise(size.cast("string")),
        F.lit("\r\n\r\n"),
    )
    text = F.concat(head, F.when(is_revisit, F.lit("")).otherwise(F.col("html")), F.lit("\r\n"))
    records.select(text.alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", per_file).text(path)


_FIELD = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)\r\n")
_ID = re.compile(rb"<urn:page:(-?\d*)>")
_CLOSE = b"\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse_segment(data: bytes) -> tuple | None:
    """What follows a magic string as a record: where its payload starts and its successor (from the magic string), and its fields.

    A response's digest is null if the payload goes on behind the segment. None if it can't be a record.
    """
    end = data.find(_CLOSE)
    if end < 0 or data[:2] == b"\r\n":
        return None
    fields = {k.lower(): v for k, v in _FIELD.findall(data, 0, end + 2)}
    length = fields.get(b"content-length", b"")
    if not length.isdigit():
        return None
    start, stop = end + 4, end + 4 + int(length)
    whole = stop + 4 <= len(data)
    if whole and data[stop : stop + 4] != _CLOSE:
        return None
    ids = [(_ID.fullmatch(fields.get(k, b"")) or [b"", b""])[1] for k in (b"warc-record-id", b"warc-refers-to")]
    page, other = (int(x) if x.strip(b"-") else None for x in ids)
    kind = fields.get(b"warc-type", b"").decode("latin-1")
    if kind == "revisit":
        size, digest = fields.get(b"x-payload-length", b"0"), fields.get(b"warc-payload-digest", b"").decode("latin-1")[5:]
        size = int(size) if size.isdigit() else 0
    else:
        size, digest = stop - start, digest_of(data[start:stop]) if whole else None
    return len(MAGIC) + start, len(MAGIC) + stop + 4, page, size, digest, kind, other


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _segments(batches):
    """path, block, number, place in the block and bytes of each segment; a block is a range that one task reads.

    Only what precedes a file's first magic string has none before it.
    """
    here, n, at = None, 0, 0
    for batch in batches:
        for path, block, data in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), batch.column("segment")):
            if here != (path, block):
                here, n, at = (path, block), 0, 0
            data = data.as_py()
            headless = block == 0 and n == 0
            length = len(data) + (0 if headless else len(MAGIC))
            yield path, block, n, at, length, headless, data
            n, at = n + 1, at + length


def _candidates(batches):
    """Every segment, those that may begin a record with its fields and its successor's place."""
    schema, rows = _arrow(_SEGMENT), []
    for path, block, n, at, length, headless, data in _segments(batches):
        found = None if headless else parse_segment(data)
        start, successor, *fields = found or (None,) * 7
        rows.append((path, block, n, at, length, start, None if successor is None else at + successor, *fields))
        if len(rows) == 10_000:
            yield _batch(rows, schema)
            rows = []
    yield _batch(rows, schema)


def reachable(at: np.ndarray, successor: np.ndarray, start: int = 0) -> np.ndarray:
    """Which records the chain from start visits, by pointer jumping in O(log n) vector steps.

    Step k marks whatever lies 2**k successors behind a marked record, then doubles the jumps.
    """
    n = len(at)
    order = np.argsort(at, kind="stable")
    at, successor = at[order], successor[order]
    place = np.searchsorted(at, successor)
    place = np.where((place < n) & (at[np.minimum(place, n - 1)] == successor), place, n)
    jump = np.append(place, n)
    marked = np.zeros(n + 1, bool)
    marked[:n] = at == start
    for _ in range(max(1, int(n).bit_length())):
        marked[jump[marked]] = True
        jump = jump[jump]
    out = np.empty(n, bool)
    out[order] = marked[:n]
    return out


def _chain(group: pa.Table) -> pa.Table:
    """A file's segments in order: kept if a record of the chain begins there; the record that owns it if its payload has several."""
    group = group.sort_by("at")
    at, length = group.column("at").to_numpy(), group.column("length").to_numpy()
    may = np.flatnonzero(group.column("successor").is_valid().to_numpy(zero_copy_only=False))
    successor = group.column("successor").fill_null(-1).to_numpy()
    kept = np.zeros(len(at), bool)
    first = at[length > 0].min(initial=0)
    kept[may[reachable(at[may], successor[may], first)]] = True
    records = np.flatnonzero(kept)
    broken = successor[records] > at[records] + length[records]
    last = np.searchsorted(records, np.arange(len(at)), "right") - 1
    own = records[np.maximum(last, 0)] if len(records) else np.zeros(len(at), int)
    owned = (last >= 0) & broken[np.maximum(last, 0)] & (at < successor[own]) if len(records) else np.zeros(len(at), bool)
    group = group.append_column("kept", pa.array(kept)).append_column("owner", pa.array(np.where(owned, at[own], 0), mask=~owned))
    return group.filter(pa.array(kept | owned))


def _numbered(batches):
    schema, rows, size = _arrow("path string, block long, n long, segment binary"), [], 0
    for path, block, n, _, length, _, data in _segments(batches):
        rows.append((path, block, n, data))
        size += length
        if size > 1 << 23:
            yield _batch(rows, schema)
            rows, size = [], 0
    yield _batch(rows, schema)


def _joined(group: pa.Table) -> pa.Table:
    """The payload of one record from its segments: its bytes and digest, no row if it is cut off."""
    group = group.sort_by("at")
    data = MAGIC.encode().join(group.column("segment").to_pylist())
    start, successor, at = (group.column(c)[0].as_py() for c in ("start", "successor", "at"))
    stop = successor - at - 4 - len(MAGIC)
    payload = data[start - len(MAGIC) : stop]
    rows = [(group.column("path")[0].as_py(), at, digest_of(payload))] if data[stop : stop + 4] == _CLOSE else []
    return pa.Table.from_batches([_batch(rows, _arrow("path string, owner long, whole string"))])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below path: path, at, successor, and their fields.

    What moves are segments' places and fields, and the payloads that hold the magic string. A group of the chain is one file's segments.
    """
    lines = spark.read.option("lineSep", MAGIC).option("pathGlobFilter", "*.txt").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("segment"))
    found = saved(lines.mapInArrow(_candidates, _SEGMENT), "warc-segments")
    blocks = found.groupBy("path", "block").agg(F.sum("length").alias("bytes"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    placed = found.join(blocks, ["path", "block"])
    placed = placed.withColumn("at", F.col("at") + F.col("base")).withColumn("successor", F.col("successor") + F.col("base")).select(found.columns)
    chain = saved(placed.groupBy("path").applyInArrow(_chain, _CHAIN), "warc-chain")
    records = chain.where("kept").drop("kept")
    parts = chain.where("owner is not null").select("path", "block", "n", "at", "owner", "start", "successor")
    number = parts.limit(BROADCAST_SEGMENTS + 1).count()
    fields = ["path", "at", "successor", "page_id", "payload_bytes"]
    if not number:
        return records.select(*fields, "payload_digest", "record_type", "refers_to")
    picked = F.broadcast(parts) if number <= BROADCAST_SEGMENTS else parts
    whole = lines.mapInArrow(_numbered, "path string, block long, n long, segment binary").join(picked, ["path", "block", "n"])
    whole = whole.groupBy("path", "owner").applyInArrow(_joined, "path string, owner long, whole string")
    out = records.join(whole, ["path", "owner"], "left").where("owner is null or whole is not null")
    return out.select(*fields, F.coalesce("payload_digest", "whole").alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages as archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(with_revisits(pages, min_bytes), path)
    return read_archives(spark, path)


def op10_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
