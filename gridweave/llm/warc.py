"""WARC archives: a writer with revisit records and a sequential reader.

Every record is one gzip member. The reader goes through a file once from its start: it inflates member by member in
small pieces, frames the block by `Content-Length`, and hashes block and payload as they pass.

Writing goes through Spark's own file committer, so a lost executor leaves neither half a file nor a second copy. Its
text format puts the bytes of a string column into the file as they are, with one separator after each row. A gzip member
ends with the high byte of its uncompressed size, which is zero below 16 MiB: that byte is the separator. A larger
record is followed by a small `metadata` record, so that its row ends with that byte as well.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import table
from gridweave.session import staging_path

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 16
#: Bytes of an archive, of which a reading task holds one; runs of members in a file.
FILE_BYTES, RUNS = 1 << 29, 32
READ_SCHEMA = (
    "file string, offset long, record_type string, key long, uri string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary, error string"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def mark_revisits(records: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Add `first`: the smallest key with the same payload where another record has that payload too.

    Equal payloads are counted with a map-side combine, so one payload may hold any share of the records.
    """
    marked = records.withColumn("sha", F.unhex(F.sha1("payload")))
    repeated = (
        marked.where(F.length("payload") >= min_revisit_bytes).groupBy("sha")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    )
    return marked.join(repeated, "sha", "left")


def _member(kind: str, key: str, fields: list[str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{key}>", f"WARC-Date: {DATE}", *fields,
             f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 5, mtime=0)


def encode_record(key: int | None, uri: str | None, payload: bytes, first: int | None) -> bytes:
    """One record as gzip bytes that end with a zero byte."""
    revisit = first is not None and (key is None or key > first)
    fields = [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response"]
    if uri is not None:
        fields.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:record:{first}>"]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = "null" if key is None else str(key)
    out = _member("revisit" if revisit else "response", name, fields, head if revisit else head + payload)
    return out if out[-1] == 0 else out + _member("metadata", f"{name}:end", ["Content-Type: application/warc-fields"], b"")


def write_warc(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html",
               min_revisit_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write a record per row of `pages` into archives below `path`.

    Of records with equal payloads of at least `min_revisit_bytes` bytes the one with the smallest key is a response and
    the others revisit it; rows that repeat that key are responses too. A null payload is empty, a null key is larger
    than any other, a null address leaves its header out. Line ends in an address are percent-coded. Other columns
    are not looked at. An empty table gives no records.

    A file has at most about `file_bytes`, whatever the records: rows of the text files are runs of members of a
    64th of that, 32 to a file, and a payload that is larger than such a run has a file to itself.
    """
    import pyarrow as pa

    run_bytes = max(1, file_bytes // (2 * RUNS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[bytes] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4)), strict=True):
                out.append(encode_record(*(x.as_py() for x in row)))
                size += len(out[-1])
                if size >= run_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["value"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["value"])

    records = pages.select(
        F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    marked = mark_revisits(records, min_revisit_bytes).select("key", "uri", "payload", "first")
    large = F.octet_length("payload") > run_bytes

    def write(some: DataFrame, runs: int) -> None:
        rows = some.mapInArrow(encode, "value binary")
        (rows.select(F.expr("substring(value, 1, length(value) - 1)").cast("string").alias("value"))
         .write.mode("append").option("lineSep", "\0").option("maxRecordsPerFile", runs).text(path))

    write(marked.where(~large), RUNS)
    if not records.where(large).isEmpty():
        write(marked.where(large), 1)


def members(data: bytes) -> Iterator[tuple[int, Iterator[bytes]]]:
    """Offset and inflated pieces of every gzip member; the pieces must be used up before the next member."""
    view, at = memoryview(data), 0

    def pieces() -> Iterator[bytes]:
        nonlocal at
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            if at >= len(view):
                raise ValueError("truncated member")
            fed = view[at:at + PIECE]
            at += len(fed)
            out = inflate.decompress(fed, PIECE)
            while out or (inflate.unconsumed_tail and not inflate.eof):
                yield out
                out = b"" if inflate.eof else inflate.decompress(inflate.unconsumed_tail, PIECE)
            at -= len(inflate.unused_data)

    while at < len(view):
        yield at, pieces()


def parse_record(pieces: Iterator[bytes], keep_payload: bool = False) -> dict:
    """Read one record, holding its header and one piece at a time (and the payload where it is asked for)."""
    head = b""
    while (end := head.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None:
            raise ValueError("no end of header")
        head += piece
    version, *lines = head[:end].decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC version line")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    left = length = int(fields["content-length"])
    block, payload, kept, tail = hashlib.sha1(), hashlib.sha1(), bytearray(), b""
    http, body = (b"" if "application/http" in fields.get("content-type", "") else None), 0
    piece = head[end + 4:]
    while piece is not None:
        inside, tail = piece[:left], tail + piece[left:]
        left -= len(inside)
        block.update(inside)
        if http is not None:  # still inside the HTTP header
            http += inside
            if (cut := http.find(b"\r\n\r\n")) >= 0:
                inside, said, http = http[cut + 4:], http[:cut], None
                fields["http"] = said.decode("latin-1")
            else:
                inside = b""
        payload.update(inside)
        body += len(inside)
        if keep_payload:
            kept += inside
        piece = next(pieces, None)
    if left or tail != b"\r\n\r\n":
        raise ValueError(f"content-length {length} does not frame the record")
    named = lambda field: fields.get(field, "").removeprefix("sha1:")
    found = base64.b32encode(block.digest()).decode()
    if named("warc-block-digest") not in ("", found):
        raise ValueError("block digest differs")
    kind = fields["warc-type"]
    if kind == "response" and named("warc-payload-digest") not in ("", base64.b32encode(payload.digest()).decode()):
        raise ValueError("payload digest differs")
    if kind == "revisit":  # the block is the header alone; it tells the size of the payload it stands for
        body = next((int(x.split(":")[1]) for x in fields.get("http", "").split("\r\n") if x.lower().startswith("content-length:")), None)
    number = lambda field: int(x) if (x := fields.get(field, "")[12:-1]).lstrip("-").isdigit() else None
    return {
        "record_type": kind, "key": number("warc-record-id"), "uri": fields.get("warc-target-uri"), "payload_bytes": body,
        "payload_digest": named("warc-payload-digest") or base64.b32encode(payload.digest()).decode(),
        "refers_to": number("warc-refers-to"), "payload": bytes(kept) if keep_payload and kind == "response" else None, "error": None,
    }


def read_warc(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """A row per record of all archives below `path`.

    A record that is truncated, ill framed or does not match its digests gives a row with `error` set; after damage
    inside a gzip member the rest of that file is given up, since the next member cannot be found. An empty folder gives
    no rows. A task holds one archive's compressed bytes and, beyond them, one piece of one record.
    """
    import pyarrow as pa

    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("key", pa.int64()),
                        ("uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())])

    def rows(file: str, data: bytes) -> Iterator[dict]:
        at = 0
        try:
            for at, pieces in members(data):
                row = {"file": file, "offset": at}
                try:
                    row |= parse_record(pieces, keep_payload)
                except (ValueError, KeyError) as problem:
                    row["error"] = str(problem)
                    for _ in pieces:
                        pass
                yield row
        except (zlib.error, ValueError) as problem:
            yield {"file": file, "offset": at, "error": str(problem)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1), strict=True):
                out, held = [], 0
                for row in rows(file.as_py(), data.as_buffer()):
                    out.append(row)
                    held += 500 + len(row.get("payload") or b"")
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("path", "content").mapInArrow(read, READ_SCHEMA)


def broken_revisits(records: DataFrame) -> DataFrame:
    """Revisit targets whose response is missing or differs in digest or size; revisits are combined before they move."""
    asked = records.where("record_type = 'revisit'").groupBy("refers_to", "payload_digest", "payload_bytes").agg(F.count(F.lit(1)).alias("revisits"))
    there = records.where("record_type = 'response'").select(
        F.col("key").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    return asked.join(there, ["refers_to", "payload_digest", "payload_bytes"], "left_anti")


def checked(error: Column) -> Column:
    """Fails the job on a record that could not be read."""
    return F.when(error.isNotNull(), F.raise_error(error)).otherwise(F.lit(True))


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All `pages` written as archives and read back, one row per page."""
    path = staging_path(spark, "warc")
    write_warc(table(spark, folder, "pages"), path)
    records = read_warc(spark, path)
    return (
        records.where(checked(F.col("error")) & F.col("record_type").isin("response", "revisit"))
        .select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
    )


QUERIES = {"op1_warc": op1_warc}
#: Base-32 of a digest is no SQL function; tests compare with a brute-force version.
ORACLES: dict[str, str] = {}
