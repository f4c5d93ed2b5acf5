"""Binary token files: one array of ids and Elias-Fano coded document boundaries.

A file is one segment:

    "EFTK", version u32, partition u32, number u32, documents u64, without an id u64, ids u64, bytes of an id u32, low bits u32
    ids            little-endian unsigned, one document after another
    document ids   i64 each, ascending; those without an id come last
    low parts      of the boundaries, `low bits` each, packed
    high parts     unary: for boundary i the bit (boundary >> low bits) + i is set
    samples        u64: the position of every 256th set bit
    "\n"

Boundary i is where document i ends, so a document's ids are found by two selects. A boundary takes about
2 + log2(ids / documents) bits. Segments in order of (partition, number) hold all documents in ascending id order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave.llm.common import table, whole_text
from gridweave.llm.vocabulary import encoder, id_bytes, tokenizer_path
from gridweave.session import staging_path

HEAD = "<4sIIIQQQII"
MAGIC, VERSION, SAMPLE = b"EFTK", 1, 256
#: Ids of a segment, beyond which a new one begins; a longer document has a segment of its own.
SEGMENT_IDS = 4_000_000
END = 1


def elias_fano(ends: np.ndarray, universe: int) -> tuple[int, bytes, bytes, bytes]:
    """Low bits per value, packed low parts, unary high parts, and samples of ascending `ends` up to `universe`."""
    n = len(ends)
    low = max(0, (universe // max(n, 1)).bit_length() - 1)
    ends = ends.astype(np.uint64)
    lows = ((ends[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    at = (ends >> np.uint64(low)).astype(np.int64) + np.arange(n)
    unary = np.zeros((universe >> low) + n + 1, np.uint8)
    unary[at] = 1
    return (low, np.packbits(lows.ravel(), bitorder="little").tobytes(), np.packbits(unary, bitorder="little").tobytes(),
            at[::SAMPLE].astype("<u8").tobytes())


def encode_segment(partition: int, number: int, doc_ids: list[int | None], counts: list[int], ids: bytes, width: int) -> bytes:
    ends = np.cumsum(np.array(counts, np.int64))
    total = int(ends[-1]) if counts else 0
    low, lows, highs, samples = elias_fano(ends, total)
    missing = sum(d is None for d in doc_ids)
    head = struct.pack(HEAD, MAGIC, VERSION, partition, number, len(counts), missing, total, width, low)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    return b"".join((head, ids, known, lows, highs, samples, b"\n"))


class Segment:
    """A segment's bytes, with documents by position. Bytes are looked at, not copied."""

    def __init__(self, data: bytes | memoryview) -> None:
        magic, version, self.partition, self.number, self.documents, self.missing, self.total, self.width, self.low = struct.unpack_from(HEAD, data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file")
        n, at = self.documents, struct.calcsize(HEAD)
        part = lambda size, kind: np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at)
        self.ids = part(self.total * self.width, f"<u{self.width}")
        at += self.total * self.width
        self.doc_ids = part(8 * n, "<i8")
        at += 8 * n
        self.lows = part((n * self.low + 7) // 8, np.uint8)
        at += len(self.lows)
        self.highs = part(((self.total >> self.low) + n + 1 + 7) // 8, np.uint8)
        at += len(self.highs)
        self.samples = part(8 * -(-n // SAMPLE), "<u8")
        at += 8 * len(self.samples)
        if bytes(data[at:at + 1]) != b"\n" or len(data) != at + 1:
            raise ValueError("token file of the wrong length")

    def select(self, i: int) -> int:
        """Boundary i: where document i ends, found from the sample before it."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, seen = at >> 3, 0
        mask = 0xFF << (at & 7) & 0xFF
        while (seen := (int(self.highs[byte]) & mask).bit_count()) <= left:
            left, byte, mask = left - seen, byte + 1, 0xFF
        bits = int(self.highs[byte]) & mask
        for _ in range(left):
            bits &= bits - 1
        high = byte * 8 + (bits & -bits).bit_length() - 1 - i
        low = 0
        for k in range(self.low):
            bit = i * self.low + k
            low |= (int(self.lows[bit >> 3]) >> (bit & 7) & 1) << k
        return high << self.low | low

    def ends(self) -> np.ndarray:
        """All boundaries."""
        n = self.documents
        high = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[:n] - np.arange(n)
        bits = np.unpackbits(self.lows, bitorder="little")[: n * self.low].reshape(n, self.low).astype(np.int64)
        return (high.astype(np.int64) << self.low) + (bits << np.arange(self.low)).sum(axis=1)

    def document(self, i: int) -> np.ndarray:
        """The ids of document i."""
        return self.ids[self.select(i - 1) if i else 0: self.select(i)]


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end: int = END, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of every text in ascending `doc_id` order, `end` after each document.

    A null text is empty and has the end id alone. Null ids come last; documents with equal ids are ordered by a hash of
    the text. An empty table writes no segment. Other columns are not looked at. Documents are dealt out by ranges
    of (id, hash of the text), so no id, however often it comes, has to fit one task; a task holds one segment.
    """
    import pyarrow as pa

    width = id_bytes(tokenizer)
    last = np.array([end], f"<u{width}").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, partition, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, counts, parts, size = [], [], [], 0

        def segment() -> pa.RecordBatch:
            data = encode_segment(partition, number, doc_ids, counts, b"".join(parts), width)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py()) + last
                if counts and size + len(ids) // width > segment_ids:
                    yield segment()
                    doc_ids, counts, parts, size, number = [], [], [], 0, number + 1
                doc_ids.append(doc_id.as_py())
                counts.append(len(ids) // width)
                parts.append(ids)
                size += counts[-1]
        if counts:
            yield segment()

    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(segments, "value binary")
    (rows.select(F.expr("substring(value, 1, length(value) - 1)").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path))


def read_segments(spark: SparkSession, path: str, schema: str, rows: Callable[[Segment], dict]) -> DataFrame:
    """Columns that `rows` makes of each segment; a task holds one file."""
    import pyarrow as pa

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield pa.RecordBatch.from_pydict(rows(Segment(memoryview(data.as_buffer()))))

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("content").mapInArrow(read, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of each document; `start` counts the ids of all documents before it."""

    def rows(segment: Segment) -> dict:
        import pyarrow as pa

        ends = segment.ends()
        starts = np.concatenate(([0], ends[:-1]))
        wide = segment.ids.astype("<u4")
        known = segment.documents - segment.missing
        return {
            "partition": pa.array(np.full(len(ends), segment.partition, np.int32)), "number": pa.array(np.full(len(ends), segment.number, np.int32)),
            "doc_id": pa.array([int(d) if i < known else None for i, d in enumerate(segment.doc_ids)], pa.int64()),
            "local": pa.array(starts), "n_tokens": pa.array(ends - starts),
            "ids_crc32": pa.array([zlib.crc32(wide[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
        }

    docs = read_segments(spark, path, "partition int, number int, doc_id long, local long, n_tokens long, ids_crc32 long", rows)

    def totals(segment: Segment) -> dict:
        import pyarrow as pa

        return {"partition": pa.array([segment.partition], pa.int32()), "number": pa.array([segment.number], pa.int32()), "ids": pa.array([segment.total], pa.int64())}

    # A row for each segment of millions of ids.
    before = Window.orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)
    bases = read_segments(spark, path, "partition int, number int, ids long", totals).select(
        "partition", "number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return docs.join(bases, ["partition", "number"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_file(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    """All `documents` written as token files and read back, one row per document."""
    path = staging_path(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), path, tokenizer or tokenizer_path("word_bpe_49k.json"))
    return read_documents(spark, path)


QUERIES = {"op3_token_file": op3_token_file}
#: SQL has no tokenizer; tests compare with the library's own encoding.
ORACLES: dict[str, str] = {}
