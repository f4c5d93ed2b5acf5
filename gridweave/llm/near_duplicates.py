"""Near-duplicates by b-bit MinHash: bands give candidates, packed low bits an estimate, full sets the decision.

1. Every text becomes a set of hashed shingles, `PERMUTATIONS` minima of it, `BANDS` keys of `ROWS` minima each, and the low `BITS`
   bits of the minima, packed. Texts with the same set are one class from here on, however many copies there are.
2. Classes that share a band key are a bucket. In each bucket everyone is paired with one pivot: the member that
   sits in the largest buckets, which is close to what a group of copies has in common.
3. A pair is dropped where the estimate from bit counts, corrected for chance, is more than six standard deviations below the
   threshold. The rest is decided on the full sets of both texts.
4. Where a bucket falls into several components, those outside its largest component ask: all askers and members of the
   buckets of one pivot meet in tasks of `ASKERS` askers each, through which the members stream. Estimate and full sets decide
   there, and only links are put out, one of an asker with a component. So a bucket of n classes that are alike costs
   n pairs, not n squared, and no pair in a bucket that could join two components is left out.

A pair at the threshold shares no bucket with a probability of (1 - 0.8^4)^32, 5 in 10^8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import table, whole_text
from gridweave.llm.graph import components
from gridweave.llm.shingles import WordHasher, mix, numbers, shingles, texts
from gridweave.session import stage

PERMUTATIONS, BANDS, BITS = 128, 32, 8
ROWS = PERMUTATIONS // BANDS
SIGMAS = 6
ASKERS = 256


def signatures(documents: DataFrame, words: int = 5) -> DataFrame:
    """`doc_id, tie` (a hash of the text), `n_shingles`, `key` (a digest of the set), `bits` and `bands` of every row."""
    import pyarrow as pa

    flip, factor = numbers(PERMUTATIONS, 5), numbers(PERMUTATIONS, 6) | np.uint64(1)
    join, salt = numbers(ROWS, 7) | np.uint64(1), numbers(BANDS, 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            counts, keys, bits, bands = [], [], [], []
            for data in texts(batch.column(2)):
                found = shingles(hasher.words(data), words)
                counts.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(found), 512):
                    np.minimum(least, ((found[at:at + 512, None] ^ flip) * factor).min(axis=0), out=least)
                least = mix(least)
                bits.append(least.astype(np.uint8).view(np.int64))
                bands.append(mix((least.reshape(BANDS, ROWS) * join).sum(axis=1, dtype=np.uint64) + salt).view(np.int64))
            lists = lambda rows: pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (len(rows[0]) if rows else 0)), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), lists(bits), lists(bands)],
                ["doc_id", "tie", "n_shingles", "key", "bits", "bands"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, tie long, n_shingles long, key binary, bits array<long>, bands array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Likeness from packed low bits: equal entries by bit counts, corrected for those equal by chance."""
    def different(x: Column) -> Column:
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(mask)))
        return F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))

    unequal = F.aggregate(F.zip_with(a, b, lambda x, y: different(x.bitwiseXOR(y))), F.lit(0), lambda n, d: n + d)
    chance = 1 / (1 << BITS)
    return ((1 - unequal / PERMUTATIONS) - chance) / (1 - chance)


def confirmed(pairs: DataFrame, nodes: DataFrame, bodies: DataFrame, percent: int, words: int) -> DataFrame:
    """Pairs `a, b` that pass the estimate and then 100 * common >= percent * union on the full sets."""
    import pyarrow as pa

    level = percent / 100
    cut = level - SIGMAS * (level * (1 - level) / PERMUTATIONS) ** 0.5
    left = nodes.select(F.col("node").alias("a"), F.col("bits").alias("bits_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("bits").alias("bits_b"))
    likely = pairs.join(left, "a").join(right, "b").where(estimate(F.col("bits_a"), F.col("bits_b")) >= cut).select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last, theirs = WordHasher(), None, None
        for batch in batches:
            kept_a, kept_b = [], []
            for a, b, mine, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), texts(batch.column(3)), strict=True):
                if last != b:
                    last, theirs = b, shingles(hasher.words(other), words)
                own = shingles(hasher.words(mine), words)
                common = len(np.intersect1d(own, theirs, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(theirs) - common):
                    kept_a.append(a)
                    kept_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(kept_a, pa.int64()), pa.array(kept_b, pa.int64())], ["a", "b"])

    with_a = likely.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    with_both = with_a.join(bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def joining_links(open_: DataFrame, nodes: DataFrame, bodies: DataFrame, percent: int, words: int, askers: int = ASKERS) -> DataFrame:
    """Links `a, b` between components, among the classes of one pivot: each asker against all members.

    `open_` has `pivot, node, component, asks`. A task holds about `askers` askers' sets; members pass one by one. An asker that
    has found a link to a component asks no other member of it.
    """
    import pyarrow as pa

    level = percent / 100
    cut = level - SIGMAS * (level * (1 - level) / PERMUTATIONS) ** 0.5
    least = (cut * (1 - 1 / (1 << BITS)) + 1 / (1 << BITS)) * PERMUTATIONS
    parts = open_.groupBy("pivot").agg(F.ceil(F.sum(F.col("asks").cast("long")) / askers).cast("int").alias("parts")).where("parts > 0")
    known = open_.join(nodes.select("node", "bits"), "node").join(bodies, "node").join(parts, "pivot")
    columns = ["pivot", "part", "streams", "node", "component", "bits", "text"]
    asking = known.where("asks").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).withColumn("streams", F.lit(False)).select(*columns)
    streaming = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("streams", F.lit(True)).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, current = WordHasher(), None
        ids, parts_of, sets, rows, packed, joined = [], [], [], [], None, set()
        for batch in batches:
            found = []
            heads = [batch.column(i).to_pylist() for i in range(5)]
            low = np.asarray(batch.column(5).flatten()).view(np.uint8).reshape(-1, PERMUTATIONS)
            for pivot, part, streams, node, component, mine, data in zip(*heads, low, texts(batch.column(6)), strict=True):
                if (pivot, part) != current:
                    current, ids, parts_of, sets, rows, packed, joined = (pivot, part), [], [], [], [], None, set()
                if not streams:
                    ids.append(node)
                    parts_of.append(component)
                    sets.append(shingles(hasher.words(data), words))
                    rows.append(mine.copy())
                    continue
                if packed is None:  # all askers come before the first member
                    packed = np.array(rows, np.uint8).reshape(-1, PERMUTATIONS)
                own = None
                for k in np.flatnonzero((packed == mine).sum(axis=1) >= least):
                    if parts_of[k] == component or (k, component) in joined:
                        continue
                    own = shingles(hasher.words(data), words) if own is None else own
                    at = np.searchsorted(sets[k], own)
                    common = int((sets[k][np.minimum(at, len(sets[k]) - 1)] == own).sum())
                    if 100 * common >= percent * (len(own) + len(sets[k]) - common):
                        joined.add((k, component))
                        found.append((ids[k], node))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ([], []))], ["a", "b"])

    ordered = asking.unionByName(streaming).repartition("pivot", "part").sortWithinPartitions("pivot", "part", "streams")
    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(documents: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """`doc_id, tie, n_shingles, component_id, component_tie` of every row of `documents`; `tie` is a hash of the text.

    Rows are linked where 100 * common >= percent * union of their sets of distinct shingles of `words` words; A-Z count as
    a-z. Fewer words are one shingle; a text without words, or null, is linked with nothing, and is its own
    component. `component_id` is the smallest `doc_id` that can be reached; null ids are passed over, so it is null only
    where all ids of a group are. Repeated rows are linked like other copies. An empty table gives no rows.
    """
    rows = stage(signatures(documents, words), "signatures")
    # A row for each distinct set, with a number; copies are combined before the shuffle.
    nodes = stage(
        rows.where("n_shingles > 0").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("first"), F.first("bits").alias("bits"), F.first("bands").alias("bands"))
        .select(F.monotonically_increasing_id().alias("node"), "key", F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie"), "bits", "bands"), "classes")
    places = nodes.select("node", F.explode("bands").alias("band"))
    shared = places.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(places.join(shared, "band"), "members")
    score = members.groupBy("node").agg(F.sum("n").alias("score"))
    pivots = members.join(score, "node").groupBy("band").agg(F.max(F.struct("score", "node"))["node"].alias("b"))
    first = stage(members.join(pivots, "band").where("node <> b").select(F.col("node").alias("a"), "b").distinct(), "pairs")
    # Texts of the classes that share a bucket with another.
    wanted = nodes.join(score.select("node"), "node", "left_semi").select("node", F.col("doc_id").alias("d"), F.col("tie").alias("t"))
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    bodies = stage(
        source.join(wanted, source["doc_id"].eqNullSafe(wanted["d"]) & (source["tie"] == wanted["t"]))
        .select("node", "text").dropDuplicates(["node"]), "bodies")
    links = stage(confirmed(first, nodes, bodies, percent, words), "links")
    found = stage(components(links), "components")

    placed = members.join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    parts = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"))
    split = stage(parts.groupBy("band").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("size", "component"))["component"].alias("largest")).where("parts > 1"), "split")
    # Who asks, and whom, by pivot: buckets of one pivot have nearly the same members, so they are taken together.
    open_ = stage(
        placed.join(split, "band").join(pivots.withColumnRenamed("b", "pivot"), "band").where("node <> pivot")
        .groupBy("pivot", "node", "component").agg(F.max(F.col("component") != F.col("largest")).alias("asks")), "open")
    more = stage(joining_links(open_, nodes, bodies, percent, words), "links")
    whole = components(links.unionByName(more))

    reached = nodes.join(whole, "node", "left").select("key", "doc_id", "tie", F.coalesce("component", "node").alias("component"))
    chosen = reached.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("chosen"))
    of_key = stage(reached.join(chosen, "component").select("key", F.col("chosen.doc_id").alias("component_id"), F.col("chosen.tie").alias("component_tie")), "class-components")
    named = rows.join(of_key, "key", "left")
    alone = F.col("n_shingles") == 0
    return named.select(
        "doc_id", "tie", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("tie")).otherwise(F.col("component_tie")).alias("component_tie"))


def one_of_each(documents: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """`documents` with one row of each component, that with the smallest `doc_id`; all rows without words stay.

    Of rows that repeat an id and a text one stays. All columns come back as they are, whatever their names.
    """
    found = near_duplicates(documents, percent, words).where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tie") == F.col("component_tie")))
    kept = stage(found.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("times"), F.max("n_shingles").alias("n")), "kept").select(
        F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie"), ((F.col("times") == 1) | (F.col("n") == 0)).alias("every"))
    tied = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("tie"))
    met = tied.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("tie") == F.col("kept_tie")))
    # Repeated rows of one document are rare; of those one stays.
    single, repeated = met.where("every"), met.where("NOT every").dropDuplicates(["kept_id", "kept_tie"])
    return single.unionByName(repeated).select(*[F.col("row").getField(c).alias(c) for c in documents.columns])


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all `documents` on four-word shingles; one document of each is kept."""
    found = near_duplicates(table(spark, folder, "documents"), words=4)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


QUERIES = {"op10_near_duplicates": op10_near_duplicates}
#: Exact likeness of all pairs is out of SQL's reach on whole tables; tests compare with brute force.
ORACLES: dict[str, str] = {}
