"""Cross-tokenizer alignment: which ids of two tokenizers stand for the same bytes, over all documents.

1. Texts are shuffled whole, so each distinct text is tokenised and aligned once; `copies` says how many documents hold it.
2. A text is aligned in parts that begin at a blank after a character that is not white space. Neither tokenizer makes a token across such a
   place, so both end a token there, and groups never cross it: a part's ids, groups and links are worked out once in a
   Python worker and then looked up. A text with a part whose bytes differ from its tokens' is done whole.
3. Texts come in chunks of some `CHUNK` bytes. A chunk hands on each id pair that it links once, with the number of
   documents that hold it (copies counted); Spark sums these counts over the corpus and finds the highest of each id.
4. The counts of a chunk's pairs go back to the chunk, meet its texts in one task in a stream, and give each text its
   measures, which a join by the text's digest brings to the documents.

What crosses the network is texts once, aligned pairs once, and each pair once per chunk instead of once per text.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import table
from gridweave.llm.vocabulary import tokenizer_path
from gridweave.session import stage

#: Bytes of texts in a chunk; parts a worker knows before it starts anew; links of a group that are written one by one.
CHUNK, KNOWN, FLAT = 4 << 20, 600_000, 4096
#: Characters of texts that are looked up together.
TOGETHER = 1 << 19
#: Starts with white space if any, and ends where a blank follows another character.
PARTS = re.compile(r"\s*\S*(?:[^\S ]\s*\S*)*")
#: A blank after white space does not begin a part; a blank at the end does, with nothing behind it.
DOUBTFUL = re.compile(r"\s ").search
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

#: A token's id -> its bytes, for the byte-level alphabet, in which printable bytes stand for themselves and the others for U+0100 and up.
def byte_level() -> dict[str, int]:
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Ids, groups and links of texts under tokenizer A (byte-level BPE) and B (pieces with byte fallback).

    A part is known by what follows its first blank. Known parts have a number; their pair codes and links lie end to end.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level()
        added = self.a.get_added_tokens_decoder()
        entries = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes_a = [entries[i].encode() if i in added else bytes(alphabet[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        self.base = self.b.get_piece_size()
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.base)))]
        if len(self.bytes_a) * self.base >= 1 << 31:
            raise ValueError("Pairs of ids of these vocabularies do not fit 31 bits.")
        self.sizes_a, self.sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        numbers = range(max(len(self.bytes_a), self.base))
        self.said = [np.array([f"{i}{mark}" for i in numbers], object) for mark in ",|;"]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[str | None] = []
        self.counts, self.ends = array("q"), array("q", [0])
        self.codes, self.links = array("i"), array("q")

    def groups(self, a: list[int], b: list[int], data: bytes) -> tuple[np.ndarray, ...] | None:
        """Ids of A and B, ends of groups in either, ends of groups in bytes; None if the tokens' bytes are not `data`."""
        if b"".join([self.bytes_a[i] for i in a]) != data or b"".join([self.bytes_b[i] for i in b]) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        return a, b, np.searchsorted(ends_a, ends, "right"), np.searchsorted(ends_b, ends, "right"), ends

    def told(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
        """The ids of both by group, each with the mark that follows it."""
        n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.repeat(ends_b - n_b, n_a)] = self.said[0][a]
        out[np.arange(len(b)) + np.repeat(ends_a, n_b)] = self.said[0][b]
        out[ends_a + ends_b - n_b - 1] = self.said[1][a[ends_a - 1]]
        out[ends_a + ends_b - 1] = self.said[2][b[ends_b - 1]]
        return out

    def pairs(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair codes, links of each, ends of groups in them); of a group with very many links each pair once."""
        n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        if (n_a * n_b).max(initial=0) > FLAT:
            codes, links, sizes = [], [], []
            for i, j, p, q in zip((ends_a - n_a).tolist(), (ends_b - n_b).tolist(), ends_a.tolist(), ends_b.tolist(), strict=True):
                (x, m), (y, n) = np.unique(a[i:p], return_counts=True), np.unique(b[j:q], return_counts=True)
                codes.append((x[:, None] * self.base + y).ravel())
                links.append((m[:, None] * n).ravel())
                sizes.append(len(codes[-1]))
            return np.concatenate(codes).astype(np.int32), np.concatenate(links).astype(np.int64), np.cumsum(sizes)
        # Each id of A as often as its group has ids of B, and beside it those ids in turn.
        each = np.repeat(n_b, n_a)
        turn = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        codes = np.repeat(a, each) * self.base + b[np.repeat(np.repeat(ends_b - n_b, n_a), each) + turn]
        return codes.astype(np.int32), np.ones(len(codes), np.int64), np.cumsum(n_a * n_b)

    def learn(self, words: list[str]) -> None:
        """Work out parts (a blank and a word each) that are not known yet, all at once."""
        if len(self.known) + len(words) > KNOWN:
            self.forget()
        joined = [w for w in words if w and not w[-1].isspace()]
        together = None
        if joined:
            spaced = " " + " ".join(joined)
            a = self.a.encode_batch_fast([spaced], add_special_tokens=False)[0].ids
            b = [i for ids in self.b.encode(joined, num_threads=1) for i in ids]
            together = self.groups(a, b, spaced.encode())
        if together is None:
            for word in words:
                data = " " + word
                self.add([word], self.groups(self.a.encode(data, add_special_tokens=False).ids, self.b.encode(word), data.encode()), [len(data.encode())])
            return
        self.add(joined, together, np.cumsum([1 + len(w.encode()) for w in joined]))
        if len(joined) < len(words):
            kept = set(joined)
            for word in words:
                if word not in kept:
                    data = " " + word
                    self.add([word], self.groups(self.a.encode(data, add_special_tokens=False).ids, self.b.encode(word), data.encode()), [len(data.encode())])

    def add(self, words: list[str], found: tuple[np.ndarray, ...] | None, last_bytes) -> None:
        """Keep the parts that end after so many bytes; without `found` they are known not to be equal to their tokens."""
        self.known.update(zip(words, range(len(self.texts), len(self.texts) + len(words)), strict=True))
        if found is None:
            self.texts.extend([None] * len(words))
            self.counts.extend([0] * 3 * len(words))
            self.ends.extend([self.ends[-1]] * len(words))
            return
        a, b, ends_a, ends_b, ends = found
        codes, links, ends_pairs = self.pairs(a, b, ends_a, ends_b)
        at = np.searchsorted(ends, last_bytes, "right")  # groups up to the end of each part
        said, last_a, last_b = self.told(a, b, ends_a, ends_b), ends_a[at - 1], ends_b[at - 1]
        cuts = (last_a + last_b).tolist()
        self.texts.extend(["".join(said[i:j])[:-1] for i, j in zip([0, *cuts], cuts, strict=False)])
        self.counts.frombytes(np.diff(np.stack((last_a, last_b, at), axis=1), axis=0, prepend=0).astype(np.int64).tobytes())
        self.ends.frombytes((ends_pairs[at - 1] + self.ends[-1]).astype(np.int64).tobytes())
        self.codes.frombytes(codes.tobytes())
        self.links.frombytes(links.tobytes())

    def many(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """(A tokens, B tokens, groups, links, digest of the groups, pair codes ascending, links of each) of each text."""
        words = [text.split(" ") if not text.startswith(" ") and not DOUBTFUL(text) else [p[1:] for p in PARTS.findall(" " + text)[:-1]] for text in texts]
        new = list({w: None for some in words for w in some if w not in self.known})
        if len(self.known) + len(new) > KNOWN:
            self.forget()
            new = list({w: None for some in words for w in some})
        if new:
            self.learn(new)
        for text, some in zip(texts, words, strict=True):
            at = np.array([self.known[w] for w in some], np.int64)
            said = [self.texts[k] for k in at.tolist()]
            if None not in said:
                n_a, n_b, n_groups = np.frombuffer(self.counts, np.int64).reshape(-1, 3)[at].sum(axis=0).tolist()
                ends = np.frombuffer(self.ends, np.int64)
                sizes = ends[at + 1] - ends[at]
                places = np.repeat(ends[at + 1] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
                codes, links, digest = np.frombuffer(self.codes, np.int32)[places], np.frombuffer(self.links, np.int64)[places], ";".join(said)
            else:
                data = " " + text
                found = self.groups(self.a.encode(data, add_special_tokens=False).ids, self.b.encode(text), data.encode()) if text else None
                if found is None:
                    yield 0, 0, 0, 0, "", np.zeros(0, np.int32), np.zeros(0, np.int64)
                    continue
                n_a, n_b, n_groups = len(found[0]), len(found[1]), len(found[4])
                codes, links, _ = self.pairs(*found[:4])
                digest = "".join(self.told(*found[:4]))[:-1]
            pairs, where = np.unique(codes, return_inverse=True)
            # Sums of whole numbers stay exact in doubles up to 2^53.
            sums = np.bincount(where, links, minlength=len(pairs)).astype(np.int64)
            yield n_a, n_b, n_groups, int(links.sum()), hashlib.sha256(digest.encode()).hexdigest(), pairs, sums


def align(documents: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(`text, measures` by distinct text as its digest `h`, and the corpus' `a_id, b_id, documents, best`) of `documents`.

    Reads the column `text` only. A text that is null, empty, or not equal in bytes to its tokens of both kinds has no tokens and
    links nothing; measures are then 0 and the digest is ''. Copies are counted by how many rows hold the text.
    """
    import pyarrow as pa

    distinct = documents.where("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    distinct = distinct.select(F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("h"), "copies", "text")
    fields = [("chunk", pa.int64()), ("h", pa.binary()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
              ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int32())), ("links", pa.list_(pa.int64()))]
    schema = "chunk long, h binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, links array<long>"
    aligner: Callable[[], Aligner] = lambda: worker(path_a, path_b)

    def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
        ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0), kind))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
        made = [lists(list(c), t.value_type) if pa.types.is_list(t) else pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)]
        return pa.RecordBatch.from_arrays(made, [name for name, _ in fields])

    def slices(batch: pa.RecordBatch) -> Iterator[list[tuple[bytes, int, str]]]:
        some, size = [], 0
        for h, copies, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            some.append((h, copies, text.as_py()))
            size += len(some[-1][2])
            if size >= TOGETHER:
                yield some
                some, size = [], 0
        if some:
            yield some

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner()
        chunk, size, held = None, 0, []

        def summed() -> tuple:
            """The chunk's own row, without a digest: each pair with the documents that hold it."""
            codes = np.concatenate([p for p, _ in held])
            pairs, where = np.unique(codes, return_inverse=True)
            holding = np.bincount(where, np.repeat([c for _, c in held], [len(p) for p, _ in held]), minlength=len(pairs)).astype(np.int64)
            return chunk, None, 0, 0, 0, 0, "", pairs, holding

        for batch in batches:
            for some in slices(batch):
                rows = []
                for (h, copies, text), (*numbers, pairs, links) in zip(some, both.many([text for _, _, text in some]), strict=True):
                    if chunk is None:
                        chunk = int.from_bytes(h[:8], "little", signed=True)
                    rows.append((chunk, h, *numbers, pairs, links))
                    held.append((pairs, copies))
                    size += len(text)
                    if size >= chunk_bytes:
                        rows.append(summed())
                        chunk, size, held = None, 0, []
                yield batch_of(rows)
        if held:
            yield batch_of([summed()])

    aligned = stage(distinct.mapInArrow(run, schema), "aligned")
    base = worker_base(path_b)
    parts = aligned.where("h IS NULL").select("chunk", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("documents"))))
    counts = stage(parts.groupBy("pair").agg(F.sum("documents").alias("documents")).withColumn("a_id", F.expr(f"pair div {base}")), "pair-counts")
    highest = counts.groupBy("a_id").agg(F.max("documents").alias("most"))
    rated = counts.join(highest, "a_id").select("pair", "a_id", F.pmod("pair", F.lit(base)).alias("b_id"), "documents", (F.col("documents") == F.col("most")).alias("best"))
    # A chunk's counts come before its texts.
    empty = lambda name, kind: F.lit(None).cast(kind).alias(name)
    told = parts.select("chunk", "pair").join(rated.select("pair", "documents", "best"), "pair").select(
        "chunk", "pair", "documents", "best", empty("h", "binary"), *[empty(c, "long") for c in MEASURES[:4]], empty("groups_sha256", "string"), empty("pairs", "array<int>"), empty("links", "array<long>"))
    texts = aligned.where("h IS NOT NULL").select(
        "chunk", empty("pair", "int"), empty("documents", "long"), empty("best", "boolean"), "h", *MEASURES[:4], "groups_sha256", "pairs", "links")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, told_, pairs, counts_, best = None, [], None, None, None
        for batch in batches:
            rows = []
            # Runs of one chunk in the batch, counts first; a row of counts has no digest.
            chunks, is_text = batch.column(0).to_numpy(), batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(chunks) | np.diff(is_text.astype(np.int8)) != 0) + 1
            for lo, hi in zip([0, *edges], [*edges, len(chunks)], strict=True):
                if lo == hi:
                    continue
                if chunks[lo] != chunk:
                    chunk, told_, pairs = chunks[lo], [], None
                some = batch.slice(lo, hi - lo)
                if not is_text[lo]:
                    told_.append([some.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)])
                    continue
                if pairs is None:
                    pairs, counts_, best = (np.concatenate(x) for x in zip(*told_, strict=True)) if told_ else (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool))
                    order = np.argsort(pairs, kind="stable")
                    pairs, counts_, best, told_ = pairs[order], counts_[order].astype(np.int64), best[order].astype(bool), []
                for k in range(hi - lo):
                    own, links = some.column(10)[k].values.to_numpy(), some.column(11)[k].values.to_numpy()
                    at = np.searchsorted(pairs, own)
                    rows.append((int(links[best[at]].sum()), int((counts_[at] * links).sum())) if len(own) else (0, 0))
            texts_ = batch.filter(batch.column(4).is_valid())
            n_best, count_sum = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([*[texts_.column(i) for i in range(4, 9)], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), texts_.column(9)],
                                             ["h", *MEASURES, "groups_sha256"])

    met = told.unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", F.col("h").isNotNull())
    measures = met.mapInArrow(measure, "h binary, " + ", ".join(f"{c} long" for c in MEASURES) + ", groups_sha256 string")
    return stage(measures, "measures"), rated.select("a_id", "b_id", "documents", "best")


def worker(path_a: str, path_b: str) -> Aligner:
    """This Python worker's aligner, kept from task to task."""
    import sys
    from types import ModuleType

    kept = sys.modules.setdefault("_gridweave_aligners", ModuleType("_gridweave_aligners")).__dict__
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Aligner(path_a, path_b)
    return kept[path_a, path_b]


def worker_base(path_b: str) -> int:
    """Ids of tokenizer B."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def measured(documents: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """A row per row of `documents`: `doc_id` and its measures, 0 and '' where a text has no tokens (see `align`)."""
    by_text, _ = align(documents, path_a, path_b, chunk_bytes)
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("h"))
    return keyed.join(by_text, "h", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Alignment of two public tokenizers over all `documents`."""
    return measured(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {"op13_alignment": op13_alignment}
#: Tokenizers are no SQL; tests compare with a brute-force version.
ORACLES: dict[str, str] = {}
