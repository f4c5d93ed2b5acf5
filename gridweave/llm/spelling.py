"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

A word is a vector of letter counts. One replaced letter changes two counts by one (squared distance 2), one inserted or
deleted letter changes one (squared distance 1, in adjacent lengths). NumPy products of blocks of such vectors give all
squared distances of a block; pairs at most two apart in equal or adjacent lengths are kept, and the edit itself is verified.

Blocks are made so that no pair is lost and few words meet in vain: letters are dealt to three groups. An edit touches at
most two letters, so at least one group's counts are equal. A block holds the words of one length, with guests of the next
length, whose counts in one group are equal; a pair that meets in several blocks counts in the first. A block with more words than a
task takes is cut into tiles, and each two tiles meet in a task of their own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import table
from gridweave.llm.shingles import mix, numbers
from gridweave.session import stage

LEAST_CHARS, LEAST_TIMES, DROPS = 5, 3, 97
LARGER = 2
GROUPS = 3
#: Words of a block that one tile holds, on average; different words a task counts before it hands them on; characters taken at a time.
TILE, HELD, PART = 4096, 400_000, 1 << 22
#: Every letter of a run is one Latin-1 byte; capitals A-Z never come up in lower-cased runs.
_LETTERS = np.full(256, -1, np.int64)
_LETTERS[[*range(97, 123), *range(0xC0, 0x100)]] = np.arange(26 + 64)
ALPHABET = 26 + 64
_WEIGHTS = numbers(ALPHABET, 31)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """Rows of counts by letter."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = _LETTERS[np.frombuffer(b"".join(words), np.uint8)]
    cells = np.repeat(np.arange(len(words)) * ALPHABET, sizes) + letters
    return np.bincount(cells, minlength=len(words) * ALPHABET).reshape(len(words), ALPHABET)


def signatures(counts: np.ndarray) -> np.ndarray:
    """For each word and group of letters a 64-bit sum that equal counts share."""
    with np.errstate(over="ignore"):
        weighted = counts.astype(np.uint64) * _WEIGHTS
        return np.stack([mix(weighted[:, g::GROUPS].sum(axis=1, dtype=np.uint64)) for g in range(GROUPS)], axis=1).view(np.int64)


def one_edit(short: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether rows of bytes differ by one replaced byte (equal widths) or one that `other` has more."""
    if short.shape[1] == other.shape[1]:
        return (short != other).sum(axis=1) == 1
    n, width = short.shape
    ahead = short == other[:, :-1]
    agree = np.where(ahead.all(axis=1), width, ahead.argmin(axis=1))
    behind = np.ones((n, width + 1), bool)
    behind[:, :-1] = np.logical_and.accumulate((short == other[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return behind[np.arange(n), agree]


class Members:
    """Words of one length in a tile of a block, as rows of bytes and of counts."""

    def __init__(self, words: list[bytes], times: list[int]) -> None:
        self.words, self.times = words, np.array(times, np.int64)
        self.bytes = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        counts = letter_counts(words)
        self.signatures = signatures(counts)
        self.counts = counts.astype(np.float64)
        self.squares = (self.counts * self.counts).sum(axis=1)


def near_pairs(a: Members, b: Members, group: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in `a` and `b` of the words one edit apart that no earlier group finds; of equal sides each pair once."""
    wanted = 2 if a.bytes.shape[1] == b.bytes.shape[1] else 1
    shorter, longer = (a, b) if a.bytes.shape[1] <= b.bytes.shape[1] else (b, a)
    strip = max(1, (1 << 21) // max(1, len(longer.words)))
    for lo in range(0, len(shorter.words), strip):
        gram = shorter.counts[lo: lo + strip] @ longer.counts.T
        distance = shorter.squares[lo: lo + strip, None] + longer.squares - 2 * gram
        i, j = np.nonzero(distance == wanted)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        step = max(1, (1 << 23) // longer.bytes.shape[1])
        for at in range(0, len(i), step):
            x, y = i[at: at + step], j[at: at + step]
            seen = np.zeros(len(x), bool)
            for g in range(group):
                seen |= shorter.signatures[x, g] == longer.signatures[y, g]
            x, y = x[~seen], y[~seen]
            good = one_edit(shorter.bytes[x], longer.bytes[y])
            yield (x[good], y[good]) if shorter is a else (y[good], x[good])


def counted_words(documents: DataFrame, least: int = LEAST_TIMES, part: int = PART) -> DataFrame:
    """`word, n`: what is left of the letter runs of all texts, of at least `LEAST_CHARS` characters and `least` occurrences.

    Letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z become small. Of one run in `DROPS`, drawn by the crc32 of
    `<doc_id>:<run>`, one character is gone. A null id reads as nothing before the colon; a null text has no runs.
    """
    import pyarrow as pa

    runs = re.compile("[a-zÀ-ÿ]+").findall

    def pieces(text: str) -> Iterator[str]:
        """The text in parts that end where no letter run goes on."""
        at = 0
        while at < len(text):
            end = at + part
            while end < len(text) and _LETTERS[min(ord(text[end - 1]) | 32 if text[end - 1] < "\x80" else ord(text[end - 1]), 255)] >= 0:
                end += 1
            yield text[at:end]
            at = end

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_buffer()
                if data is None:
                    continue
                text = data.to_pybytes().lower().decode()  # bytes know A-Z only
                found = Counter(runs(text)) if len(text) <= part else sum((Counter(runs(p)) for p in pieces(text)), Counter())
                head = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for run, times in found.items():
                    if len(run) >= LEAST_CHARS:
                        drawn = zlib.crc32(run.encode(), head)
                        if drawn % DROPS == 0:
                            at = drawn % len(run)
                            run = run[:at] + run[at + 1:]
                            if len(run) < LEAST_CHARS:
                                continue
                        known[run] = known.get(run, 0) + times
                if len(known) >= HELD:
                    yield out()
                    known.clear()
        yield out()

    counts = documents.select("doc_id", "text").where("text IS NOT NULL").mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """`word, near, near_n`: both directions of every pair of `words` (`word, n`, each word once) one edit apart."""
    import pyarrow as pa

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each word with its own length and, as a guest, the one below, for each group of letters."""
        for batch in batches:
            if not batch.num_rows:
                continue
            latin = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            sizes = np.fromiter(map(len, latin), np.int32, len(latin))
            signs = signatures(letter_counts(latin))
            for guest in (0, 1):
                for g in range(GROUPS):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(latin), g, np.int32)), pa.array(signs[:, g].copy()), pa.array(sizes - guest),
                        pa.array(latin, pa.binary()), batch.column(1)], ["g", "sign", "size", "word", "n"])

    block = ["g", "sign", "size"]
    dealt = stage(words.select("word", "n").mapInArrow(deal, "g int, sign long, size int, word binary, n long"), "letter-blocks")
    large = dealt.groupBy(*block).agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > tile)
    tiled = dealt.join(large.select(*block, F.ceil(F.col("words") / tile).cast("int").alias("tiles")), block, "left")
    tiled = tiled.withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    # A tile meets itself and every other tile of its block: `low` and `high` name the meeting.
    meeting = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        *block, F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "word", "n")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list[bytes], list[int]]] = {}
        key = None

        def solve() -> Iterator[pa.RecordBatch]:
            g, size, low, high = key[0], key[2], key[3], key[4]
            members = {k: Members(*v) for k, v in held.items()}
            for own, guest in ((0, 0), (0, 1), (1, 0)):
                a, b = members.get((low, own)), members.get((high, guest))
                if a is None or b is None or (low == high and own > guest):
                    continue
                for i, j in near_pairs(a, b, g, same=low == high and own == guest):
                    if len(i):
                        x, y = [a.words[k].decode("latin-1") for k in i], [b.words[k].decode("latin-1") for k in j]
                        yield pa.RecordBatch.from_arrays([pa.array(x + y), pa.array(y + x), pa.array(np.concatenate((b.times[j], a.times[i])))], ["word", "near", "near_n"])

        for batch in batches:
            for *now, tile_, word, n in zip(*[batch.column(i).to_pylist() for i in range(8)], strict=True):
                if now != key:
                    if held:
                        yield from solve()
                    key, held = now, {}
                words_, times = held.setdefault((tile_, len(word) - now[2]), ([], []))
                words_.append(word)
                times.append(n)
        if held:
            yield from solve()

    order = [*block, "low", "high"]
    return meeting.repartition(*order).sortWithinPartitions(*order).select(*order, "tile", "word", "n").mapInArrow(compare, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """`word, form` (each word once, without a circle) -> `word, root`, the end of the chain; each round doubles the steps taken."""
    links = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stage(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        links = jumped.select("word", "root")
        if not jumped.where("moved").limit(1).count():
            return links


def variants(documents: DataFrame, tile: int = TILE, part: int = PART) -> DataFrame:
    """Words of `documents` (`doc_id`, `text`; other columns are not looked at) with the form they are a variant of.

    A row per word: `word, form, root, n, n_near, form_n`. `form` is the near word with the largest n, of equal ones the
    first in code-point order, if that n is at least twice the word's; `root` follows forms to the last. Repeated
    rows count each time; null or empty texts have no words, and an empty table gives no rows.
    """
    words = stage(counted_words(documents, part=part), "words")
    near = near_words(words, tile).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= LARGER * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.less") >= LARGER * F.col("n"), -F.col("best.less")).alias("form_n")), "formed")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all `documents`, their near words, forms and roots."""
    return variants(table(spark, folder, "documents"))


QUERIES = {"op12_spelling": op12_spelling}
#: DuckDB has no crc32; tests compare with a brute-force version.
ORACLES: dict[str, str] = {}
