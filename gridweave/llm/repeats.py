"""Repeated passages from an enhanced suffix array and its tree of common-prefix intervals.

Two places with the same `length` bytes agree in every gram of those bytes, so also in the gram with the smallest hash.
That gram (the anchor) splits the work:

1. Equal texts become one. Of each text, every start of a `length`-byte string is dealt to the anchor of that string;
   starts in a row with the same anchor are a segment: the bytes from its first start to the end of its last string.
   Equal strings have equal anchors, so a string only has to be compared with strings of the same anchor.
2. Segments whose anchor is nowhere else are done: nothing in them repeats. Equal segments are a repeat as a whole,
   however many there are; they are counted with a map-side combine, and one of them stands for all.
3. The different segments of an anchor meet in one task. A suffix array over many segments at once, ordered by prefix
   doubling, gives the intervals of suffixes with a common prefix of `length` bytes or more. A stack goes through their
   longest common prefixes and yields the interval tree; a node is a maximal repeat if its occurrences differ in the byte before
   them. Its occurrences in these segments are put out if groups are asked for, else what they cover of a segment.
4. An anchor with very many different segments is not gathered: its strings are counted by a 128-bit hash each, which
   gives the same bytes to remove, with a map-side combine.

What is removed is complete: every byte of a `length`-byte string that starts twice. So are the groups of an anchor's segments: a
group names segments and places in them, and the table of members names every text and place that a segment has, so each
occurrence can be reached without writing the copies out. A repeat ends where its segment does, so a long passage is
several groups, side by side; the strings of anchors of step 4 only cover bytes.

`length`-byte strings are compared byte by byte inside a suffix array; equal segments and equal texts go by 128 bits or more.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import table, whole_text
from gridweave.llm.shingles import mix, numbers
from gridweave.session import stage

LENGTH, GRAM = 400, 64
#: Different segments of an anchor that one task compares; bytes of segments in one suffix array.
GATHERED, ARRAY_BYTES = 1500, 1 << 21
CHUNK = 1 << 19


class Anchors:
    """Rolling gram hashes and their sliding minima."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.table = numbers(256, 21)
        self.base = int(numbers(1, 22)[0]) | 1
        n = CHUNK + 2 * length
        self.powers, self.inverse = self._powers(self.base, n), self._powers(pow(self.base, -1, 1 << 64), n)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
        return out[:n]

    def windows(self, data: np.ndarray, size: int) -> np.ndarray:
        """A hash of each run of `size` bytes."""
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.table[data] * self.powers[: len(data)], dtype=np.uint64)))
        return mix((sums[size:] - sums[:-size]) * self.inverse[: len(sums) - size])

    def segments(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor hashes, first starts, numbers of starts) of a text, in pieces of it."""
        width = self.length - self.gram + 1
        for begin in range(0, len(data) - self.length + 1, CHUNK):
            part = data[begin: begin + CHUNK + self.length - 1]
            hashes = self.windows(part, self.gram)
            starts = len(hashes) - width + 1
            # The smallest hash of each window, the leftmost of equal ones: from minima of blocks, forwards and backwards.
            keys = (hashes & ~np.uint64((1 << 20) - 1)) | np.arange(len(hashes), dtype=np.uint64)
            padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
            padded[: len(keys)] = keys
            blocks = padded.reshape(-1, width)
            ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
            behind = np.minimum.accumulate(blocks, axis=1).ravel()
            at = (np.minimum(ahead[:starts], behind[width - 1: width - 1 + starts]) & np.uint64((1 << 20) - 1)).astype(np.int64)
            edges = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
            yield hashes[at[edges]].view(np.int64), begin + edges, np.diff(np.concatenate((edges, [starts])))


def ranks(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values)
    out = np.empty(len(values), np.int64)
    out[order] = np.concatenate(([0], np.cumsum(np.diff(values[order]) != 0)))
    return out


def intervals(suffixes: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, end) of every node of the interval tree of sorted suffixes, by a stack over their common prefixes."""
    def common(a: bytes, b: bytes) -> int:
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            return n
        return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())

    stack: list[tuple[int, int]] = []
    for i in range(1, len(suffixes) + 1):
        now = common(suffixes[i - 1], suffixes[i]) if i < len(suffixes) else 0
        first = i - 1
        while stack and stack[-1][0] > now:
            prefix, first = stack.pop()
            yield prefix, first, i
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def maximal_repeats(parts: list[bytes], starts: list[int], length: int, owner: list[int]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(bytes, [(segment, place in it)]) of each maximal repeat of `length` bytes or more between segments of the same owner.

    Segment k has `starts[k]` starts. A repeat is maximal inside its segments: it ends where a segment does.
    """
    sizes = np.array([len(p) for p in parts])
    begins = np.concatenate(([0], np.cumsum(sizes)))
    text = np.frombuffer(b"".join(parts), np.uint8)
    # Ranks by the first 8 bytes, then by twice as many each time. Bytes past a segment's end only reach suffixes that are too short.
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    first = np.zeros(len(text), np.uint64)
    for k in range(8):
        first = (first << np.uint64(8)) | padded[k: k + len(text)]
    rank, depth = ranks(first), 8
    while depth * 2 <= length:
        later = np.concatenate((rank[depth:], np.zeros(depth, np.int64)))
        rank, depth = ranks(rank * (len(text) + 1) + later), depth * 2
    counts = np.array(starts)
    segment = np.repeat(np.arange(len(parts)), counts)
    place = np.arange(len(segment)) - np.repeat(np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    at = begins[segment] + place
    group = np.array(owner)[segment]
    order = np.lexsort((at, rank[at + length - depth], rank[at], group))
    at, segment, place, group = at[order], segment[order], place[order], group[order]
    same = (group[1:] == group[:-1]) & (rank[at[1:]] == rank[at[:-1]]) & (rank[at[1:] + length - depth] == rank[at[:-1] + length - depth])
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    # The byte before a suffix; at a segment's first start one that is like no other.
    before = np.where(place > 0, text[at - 1].astype(np.int64), -1 - segment)
    for lo, hi in zip(edges[::2], edges[1::2] + 1, strict=True):
        if (before[lo:hi] == before[lo]).all():
            continue  # one byte earlier the same occurrences agree in more
        suffixes = sorted((parts[segment[i]][place[i]:], int(i)) for i in range(lo, hi))
        for prefix, a, b in intervals([s for s, _ in suffixes]):
            members = [i for _, i in suffixes[a:b]]
            if prefix >= length and (before[members] != before[members[0]]).any():
                yield prefix, [(int(segment[i]), int(place[i])) for i in members]


@dataclass(frozen=True)
class Repeats:
    """Tables of texts, of what repeats cover in them, and of groups of repeats.

    `texts`: a bucketed table of `h, text, copies`, called `name`. `covers`: `h, starts, ends`, bytes of texts, the arrays side by side.
    `members`: `a, body, h, at, n`, the places `at` of segment (a, body) in a text, and its number of starts. `groups`: `repeat, size, a,
    body, place`: `size` bytes of segments, the same in all rows of a `repeat`; None unless asked for.
    """

    texts: DataFrame
    covers: DataFrame
    members: DataFrame
    groups: DataFrame | None
    name: str

    def occurrences(self) -> DataFrame:
        """`repeat, h, start, end` of every occurrence of every group, for who wants them written out."""
        placed = self.groups.join(self.members, ["a", "body"]).select("repeat", "h", F.explode("at").alias("at"), "place", "size")
        return placed.select("repeat", "h", (F.col("at") + F.col("place")).alias("start"), (F.col("at") + F.col("place") + F.col("size")).alias("end"))


def text_key(text: str = "text"):
    """128 bits of a digest of the whole text."""
    return F.unhex(F.substring(F.sha2(whole_text(text), 256), 1, 32))


def find_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, gathered: int = GATHERED, groups: bool = False) -> Repeats:
    """The bytes that repeats of at least `length` bytes cover in the texts of `documents`, and on request their groups.

    Reads the column `text` only. Texts are UTF-8 bytes, a null text is empty, and repeats do not cross texts. Equal texts are looked at
    once; that they repeat each other is told by `copies`. With `groups` every maximal repeat of an anchor's segments comes out
    with its places, which are many where many variants of a passage nest. An empty table has no repeats. The caller drops
    the table `name`.
    """
    import pyarrow as pa

    spark = documents.sparkSession
    name, buckets = f"repeats_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = documents.select(text_key().alias("h"), whole_text().alias("text")).groupBy("h").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    distinct.repartition(buckets, "h").write.bucketBy(buckets, "h").sortBy("h").option("compression", "zstd").saveAsTable(name)
    texts = spark.table(name)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        anchors = Anchors(length, gram)
        for batch in batches:
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_buffer()
                if data is None or len(data) < length:
                    continue
                view = memoryview(data)
                found: dict[tuple[int, int], tuple[list[int], int]] = {}
                for hashes, starts, counts in anchors.segments(np.frombuffer(data, np.uint8)):
                    for a, lo, n in zip(hashes.tolist(), starts.tolist(), counts.tolist(), strict=True):
                        body = xxhash.xxh3_64_intdigest(view[lo: lo + n - 1 + length])
                        found.setdefault((a, body), ([], n))[0].append(lo)
                yield pa.RecordBatch.from_arrays([
                    pa.array([a for a, _ in found], pa.int64()), pa.array([b - (1 << 64) if b >> 63 else b for _, b in found], pa.int64()),
                    pa.array([h] * len(found), pa.binary()), pa.array([los for los, _ in found.values()], pa.list_(pa.int32())),
                    pa.array([n for _, n in found.values()], pa.int32())], ["a", "body", "h", "at", "n"])

    dealt = stage(texts.where(F.octet_length("text") >= length).select("h", "text").mapInArrow(deal, "a long, body long, h binary, at array<int>, n int"), "segments")
    twice = dealt.groupBy("a").agg(F.sum(F.size("at")).alias("times")).where("times > 1").select("a")
    shared = stage(dealt.join(twice, "a"), "shared-segments")
    bodies = stage(shared.groupBy("a", "body").agg(F.sum(F.size("at")).alias("times"), F.min(F.struct("h", F.col("at")[0].alias("at"), "n")).alias("one")), "bodies")
    # Equal segments, whole.
    equal = bodies.where("times > 1").select("a", "body")
    whole = shared.join(equal, ["a", "body"]).select("h", F.col("at").alias("starts"), F.transform("at", lambda x: x + (F.col("n") - 1 + length)).alias("ends"))
    # Segments to compare: of anchors with several different ones; if only bytes are asked for, where one at least is there once only.
    mixed = bodies.groupBy("a").agg(F.count(F.lit(1)).alias("bodies"), F.min("times").alias("least")).where("bodies > 1" if groups else "bodies > 1 AND least = 1").select("a", "bodies")
    asked = bodies.join(mixed, "a").select("a", "bodies", F.col("one.h").alias("h"), F.struct("a", "body", F.col("one.at").alias("at"), F.col("one.n").alias("n"), (F.col("bodies") > gathered).alias("hot")).alias("s"))
    by_text = asked.groupBy("h").agg(F.collect_list("s").alias("s"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for h, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                view = memoryview(text.as_buffer())
                for s in wanted:
                    rows.append((s["a"], s["body"], s["hot"], h, s["at"], s["n"], bytes(view[s["at"]: s["at"] + s["n"] - 1 + length])))
                    size += len(rows[-1][-1])
                if size > 1 << 23:
                    yield pack(rows)
                    rows, size = [], 0
            if rows:
                yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["a", "body", "hot", "h", "at", "n", "bytes"])

    compared = stage(texts.join(by_text, "h").select("h", "text", "s").mapInArrow(cut, "a long, body long, hot boolean, h binary, at int, n int, bytes binary"), "compared")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        held: list[tuple[int, int, bytes, int, int, bytes]] = []
        size = 0

        def solve() -> pa.RecordBatch:
            """A row for each segment: what repeats cover of it, and the groups it is in."""
            covers: dict[int, list[tuple[int, int]]] = {}
            within: dict[int, list[dict]] = {}
            for prefix, members in maximal_repeats([r[5] for r in held], [r[4] for r in held], length, [r[0] for r in held]):
                if groups:
                    k, place = members[0]
                    repeat = xxhash.xxh3_64_intdigest(held[k][5][place: place + prefix], held[k][0] & 0xFFFFFFFFFFFFFFFF) >> 1
                for k, place in members:
                    covers.setdefault(k, []).append((place, place + prefix))
                    if groups:
                        within.setdefault(k, []).append({"repeat": repeat, "size": prefix, "place": place})
            rows = []
            for k, spans in covers.items():
                a, body, h, at, _, _ = held[k]
                starts, ends = merged(np.array(spans) + at)
                rows.append((a, body, h, starts, ends, within.get(k)))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.struct([("repeat", pa.int64()), ("size", pa.int32()), ("place", pa.int32())]))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], ["a", "body", "h", "starts", "ends", "within"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                if held and row[0] != held[-1][0] and size > ARRAY_BYTES:
                    yield solve()
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield solve()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = Anchors(length, gram), Anchors(length, gram)
        second.table = numbers(256, 23)
        for batch in batches:
            for h, at, n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                text = np.frombuffer(data.as_buffer(), np.uint8)
                yield pa.RecordBatch.from_arrays([
                    pa.array(first.windows(text, length).view(np.int64)), pa.array(second.windows(text, length).view(np.int64)),
                    pa.array([h] * n, pa.binary()), pa.array(np.arange(at, at + n, dtype=np.int32))], ["x", "y", "h", "start"])

    near = compared.where("NOT hot").select("a", "body", "h", "at", "n", "bytes").repartition("a").sortWithinPartitions("a").mapInArrow(
        compare, "a long, body long, h binary, starts array<int>, ends array<int>, within array<struct<repeat: long, size: int, place: int>>")
    if groups:
        near = stage(near, "repeats")
    strings = stage(compared.where("hot").select("h", "at", "n", "bytes").mapInArrow(hashed, "x long, y long, h binary, start int"), "strings")
    several = strings.groupBy("x", "y").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("x", "y")
    often = strings.join(several, ["x", "y"]).select("h", F.array("start").alias("starts"), F.array(F.col("start") + length).alias("ends"))
    found = None
    if groups:
        placed = near.select("a", "body", F.inline("within")).select("repeat", "size", "a", "body", "place")
        # A segment that is there several times is a repeat as a whole, unless the tree has that string, perhaps in longer segments, too.
        alone = bodies.where("times > 1").select(F.xxhash64("a", "body").alias("repeat"), (F.col("one.n") - 1 + length).alias("size"), "a", "body", F.lit(0).alias("place"))
        found = placed.unionByName(alone.join(placed.where("place = 0").select("a", "body", "size"), ["a", "body", "size"], "left_anti"))
    return Repeats(texts, stage(whole.unionByName(near.select("h", "starts", "ends")).unionByName(often), "covers"), shared, found, name)


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that spans (rows of a start and an end) cover, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    return spans[first, 0], reach[np.concatenate((first[1:], [True]))]


def removed_spans(repeats: Repeats) -> DataFrame:
    """`h, starts, ends`: for each text with repeats the merged runs of bytes that they cover, in order."""
    import pyarrow as pa

    by_text = repeats.covers.groupBy("h").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [merged(np.stack([c.values.flatten().to_numpy() for c in row], axis=1)) for row in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in runs], pa.list_(pa.int32())) for k in (0, 1)]], ["h", "starts", "ends"])

    return by_text.mapInArrow(run, "h binary, starts array<int>, ends array<int>")


def cleaned(repeats: Repeats, length: int = LENGTH) -> DataFrame:
    """A row for each distinct text: `h, n_bytes, n_removed, n_spans, kept_sha256, kept`.

    A text of `length` bytes or more that is there several times is removed whole. A character whose bytes are
    kept in part only is left out of the text `kept`, though its bytes count as kept in the digest.
    """
    import pyarrow as pa

    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, text, copies, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1), *[batch.column(i).to_pylist() for i in (2, 3, 4)], strict=True):
                data = memoryview(text.as_buffer())
                n = len(data)
                runs = [(0, n)] if copies > 1 and n >= length else list(zip(starts or (), ends or (), strict=True))
                at, digest, kept = 0, hashlib.sha256(), []
                for start, end in [*runs, (n, n)]:
                    digest.update(data[at:start])
                    kept.append(bytes(data[at:start]))
                    at = end
                rows.append((h, n, sum(e - s for s, e in runs), len(runs), digest.hexdigest(), b"".join(kept).decode("utf-8", "ignore")))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], ["h", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = repeats.texts.join(removed_spans(repeats), "h", "left").select("h", "text", "copies", "starts", "ends")
    return joined.mapInArrow(run, "h binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")


def without_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """`documents` with texts cut to what no repeat covers; `n_chars`, where there is one, is set again. Every row and column stays."""
    repeats = find_repeats(documents, length, gram)
    try:
        kept = stage(cleaned(repeats, length).where("n_removed > 0").select("h", "kept"), "kept")
    finally:
        documents.sparkSession.sql(f"DROP TABLE IF EXISTS {repeats.name}")
    joined = documents.select(F.struct("*").alias("row"), text_key().alias("h")).join(kept, "h", "left")
    values = {"text": F.coalesce("kept", "row.text")}
    if "n_chars" in documents.columns:
        values["n_chars"] = F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.length("kept").cast(documents.schema["n_chars"].dataType))
    return joined.select(*[values.get(c, F.col("row").getField(c)).alias(c) for c in documents.columns])


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of all `documents` without 400-byte strings that start twice, as digest and as `text`."""
    documents = table(spark, folder, "documents")
    repeats = find_repeats(documents)
    try:
        kept = stage(cleaned(repeats), "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {repeats.name}")
    return documents.select("doc_id", text_key().alias("h")).join(kept, "h").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept").alias("text"))


QUERIES = {"op6_repeats": op6_repeats}
#: Strings at every byte are out of SQL's reach on whole tables; tests compare with brute force.
ORACLES: dict[str, str] = {}
