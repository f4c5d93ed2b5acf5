"""Packing token sequences into windows by non-negative least squares.

A task packs its documents block by block, so nothing is shuffled and a lost task is packed again the same way:

1. Whole windows of a long document are sequences of their own; the remainder's length, in units of `UNIT` tokens (rounded up),
   is its bin. A block's histogram counts remainders by bin.
2. Shallow combinations, of one to three bins, that fill a window exactly are the columns of a matrix; non-negative
   least squares finds how often to repeat each so that the histogram is used up.
3. Repeats are rounded down, then lowered where a bin would be overdrawn, and remainders are dealt to combinations.
4. What is left over is packed greedily in order of length, longest first, cut where a window is full; it also fills gaps of
   `UNIT` tokens or more that rounding has left. The last window is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import table, whole_text
from gridweave.llm.vocabulary import encoder, id_bytes, tokenizer_path

WINDOW, UNIT, END = 2048, 16, 1
#: Ids that a task holds before it packs them; a longer document is a block with what came before it.
BLOCK_IDS = 16_000_000
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def combinations(units: int) -> np.ndarray:
    """All multisets of one to three bins (1 to `units`) that add up to `units`; rows are padded with 0."""
    rows = [(units, 0, 0)] + [(a, units - a, 0) for a in range(1, units // 2 + 1)]
    rows += [(a, b, units - a - b) for a in range(1, units // 3 + 1) for b in range(a, (units - a) // 2 + 1)]
    return np.array(rows)


def nonnegative_least_squares(matrix: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |matrix x - goal|, by the active-set method of Lawson and Hanson."""
    n = matrix.shape[1]
    x, passive, tolerance = np.zeros(n), np.zeros(n, bool), 1e-9 * max(1.0, np.abs(goal).max(initial=0.0)) * len(goal)
    for _ in range(3 * len(goal)):
        gradient = matrix.T @ (goal - matrix @ x)
        gradient[passive] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= tolerance:
            break
        passive[best] = True
        while True:
            used = np.flatnonzero(passive)
            part = matrix[:, used]
            solved = np.linalg.solve(part.T @ part + 1e-10 * np.eye(len(used)), part.T @ goal)
            if solved.min() > 0:
                x[:] = 0
                x[used] = solved
                break
            old = x[used]
            falling = solved <= 0
            step = (old[falling] / np.maximum(old[falling] - solved[falling], 1e-300)).min()
            x[used] = old + step * (solved - old)
            passive[used[x[used] <= 1e-12]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x


def repeats(histogram: np.ndarray, rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Whole repeats of each combination that no bin of the histogram (by units, from 0) is too small for."""
    if not histogram.any():
        return np.zeros(len(rows), int)
    times = np.floor(nonnegative_least_squares(matrix, histogram[1:].astype(float)) + 1e-6).astype(int)
    for j in np.argsort(times, kind="stable"):  # the least repeated give way first
        while times[j] and (matrix @ times > histogram[1:])[rows[j][rows[j] > 0] - 1].any():
            times[j] -= 1
    return times


class Packer:
    """Packs blocks of documents; sequence ids count on from `first`."""

    def __init__(self, window: int, unit: int, first: int) -> None:
        self.window, self.unit, self.next = window, unit, first
        self.rows = combinations(window // unit)
        self.matrix = np.zeros((window // unit, len(self.rows)))
        for k in range(3):
            there = self.rows[:, k] > 0
            np.add.at(self.matrix, (self.rows[there, k] - 1, np.flatnonzero(there)), 1.0)

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def pack(self, lengths: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
        """(document's place in the block, start, length, sequence id, offset) of each piece."""
        window, bins = self.window, [[] for _ in range(self.window // self.unit + 1)]
        for i, n in enumerate(lengths):
            for start in range(0, n - n % window, window):
                yield i, start, window, self.sequence(), 0
            bins[-(-(n % window) // self.unit)].append(i)
        histogram = np.array([0, *map(len, bins[1:])])
        plan = repeats(histogram, self.rows, self.matrix)
        used = [0] * len(bins)
        groups = []
        for j in np.flatnonzero(plan):
            for _ in range(plan[j]):
                group = []
                for b in self.rows[j][self.rows[j] > 0]:
                    group.append(bins[b][used[b]])
                    used[b] += 1
                groups.append(group)
        left = [i for b in range(len(bins) - 1, 0, -1) for i in bins[b][used[b]:]]
        total = sum(lengths[i] % window for i in left)
        at, done = 0, 0  # the leftover document that comes next, and how much of it is placed

        def take(size: int, sequence: int, offset: int) -> Iterator[tuple[int, int, int, int, int]]:
            nonlocal at, done, total
            while size:
                i = left[at]
                rest = lengths[i] % window
                part = min(size, rest - done)
                yield i, lengths[i] - rest + done, part, sequence, offset
                size, offset, done, total = size - part, offset + part, done + part, total - part
                if done == rest:
                    at, done = at + 1, 0

        for group in groups:
            sequence, offset = self.sequence(), 0
            for i in group:
                rest = lengths[i] % window
                yield i, lengths[i] - rest, rest, sequence, offset
                offset += rest
            gap = window - offset
            if self.unit <= gap <= total:
                yield from take(gap, sequence, offset)
        while total >= window:
            yield from take(window, self.sequence(), 0)
        while total:
            yield from take(1 << (total.bit_length() - 1), self.sequence(), 0)


def pack(documents: DataFrame, tokenizer: str, window: int = WINDOW, unit: int = UNIT, end: int = END, block_ids: int = BLOCK_IDS) -> DataFrame:
    """`doc_id, start, length, doc_tokens, sequence_id, offset, ids` (little-endian 32-bit) of each piece of all documents.

    A null text is empty: its only id is `end`, which each document has last. Every row is a document, repeated rows and
    null ids too. A sequence has at most `window` ids, fills up from offset 0, and where it is shorter is either to be
    padded or a power of two long. An empty table gives no pieces. `window` is a multiple of `unit` and a power of two.
    """
    import pyarrow as pa

    width = id_bytes(tokenizer)
    last = np.array([end], f"<u{width}").tobytes()
    names = [part.split()[0] for part in PIECES.split(", ")]
    kinds = [*[pa.int64()] * 6, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        packer = Packer(window, unit, TaskContext.get().partitionId() << 40)
        doc_ids, texts, held = [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            out, size = [], 0
            lengths = [len(t) // width for t in texts]
            for i, start, length, sequence, offset in packer.pack(lengths):
                ids = np.frombuffer(texts[i], f"<u{width}", length, start * width).astype("<u4").tobytes()
                out.append((doc_ids[i], start, length, lengths[i], sequence, offset, ids))
                size += len(ids)
                if size > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids.append(doc_id)
                texts.append(encode(text.as_py()) + last)
                held += len(texts[-1]) // width
                if held >= block_ids:
                    yield from block()
                    doc_ids, texts, held = [], [], 0
        if texts:
            yield from block()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, PIECES)


def op5_packing(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all `documents` in sequences of at most 2048 tokens."""
    pieces = pack(table(spark, folder, "documents"), tokenizer or tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op5_packing": op5_packing}
#: SQL has no tokenizer; tests compare with the library's own encoding.
ORACLES: dict[str, str] = {}
