"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of documents by a hash of the document. A source with target e times its size takes all its
blocks floor(e) times and, in one more round, blocks in a permuted order until the words that are left; the document at that
border is cut, so a source takes exactly its rounded target. Each (round, block) is a draw. The tree halves the output
shards again and again; at each node the draws of each source that go left are a multivariate-hypergeometric sample, so
every shard gets an exact quota of draws of each source. A shard's quota is a run of the source's permuted draws: draws
are disjoint between shards. Inside a shard, documents are ordered by a hash; `mixed_documents` puts rows out in that order.

Only numbers by source and shard reach the driver: three per source, and the tree's quotas.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave.llm.common import WORD, table, whole_text
from gridweave.session import stage

#: Words of a block on average, slices of a source's permuted blocks, output shards, most repeats of a document.
BLOCK_WORDS, SLICES, SHARDS, MOST = 65_536, 1024, 64, 3
#: Draws of a shard on average, at least: with fewer, shards of single sources would follow each other. Words of an output task.
SHARD_DRAWS, TASK_WORDS = 8, 4_000_000
DIGITS = 60 // 4
CYCLE = (1, 2, 3)


def keyed(*parts: Column | str) -> Column:
    """A 60-bit number from a hash of the parts (text, so that SQL elsewhere can say the same)."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, most: int = MOST) -> DataFrame:
    """`source, source_size` -> also `place, weight, target`; a row per source.

    Sources in code point order (null last) weigh `cycle`, repeating, and share the whole size by weight. A target above
    `most` times its source is cut to that and the excess is shared again among the others by weight: sources sorted by
    their limit per weight, a source is cut where its share of what the earlier ones left would exceed its limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_per_weight", "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    placed = sizes.withColumn("place", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, cycle)), (F.col("place") - 1) % len(cycle) + 1).cast("long"))
    limited = (
        placed.withColumn("limit", F.col("source_size") * most)
        .withColumn("limit_per_weight", F.col("limit").cast("double") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
        .withColumn("words_before", F.coalesce(F.sum("limit").over(by_limit), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_limit), F.lit(0)))
        .withColumn("cut", F.col("limit_per_weight") < (F.col("total") - F.col("words_before")).cast("double") / (F.col("weights") - F.col("weight_before")))
    )
    taken = limited.withColumn("cut_words", F.sum(F.when(F.col("cut"), F.col("limit")).otherwise(0)).over(everything)).withColumn(
        "cut_weight", F.sum(F.when(F.col("cut"), F.col("weight")).otherwise(0)).over(everything))
    share = (F.col("total") - F.col("cut_words")).cast("double") * F.col("weight") / (F.col("weights") - F.col("cut_weight"))
    return taken.select("source", "source_size", "place", "weight", F.when(F.col("cut"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def hypergeometric(draw: random.Random, good: int, bad: int, sample: int) -> int:
    """How many of `sample` draws without replacement are good: the inverse distribution from the mode outwards."""
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    log = math.lgamma
    choose = lambda n, k: log(n + 1) - log(k + 1) - log(n - k + 1)
    mode = min(high, max(low, (sample + 1) * (good + 1) // (good + bad + 2)))
    p = q = math.exp(choose(good, mode) + choose(bad, sample - mode) - choose(good + bad, sample))
    left, up, down, at = draw.random() - p, mode, mode, mode
    while left > 0 and (up < high or down > low):
        if up < high:
            p *= (good - up) * (sample - up) / ((up + 1) * (bad - sample + up + 1))
            up += 1
            left, at = left - p, up
        if left > 0 and down > low:
            q *= down * (bad - sample + down) / ((good - down + 1) * (sample - down + 1))
            down -= 1
            left, at = left - q, down
    return at


def splitting_tree(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """Draws of each source for each shard; rows add up to equal parts and columns to `quotas`."""
    if shards == 1:
        return [list(quotas)]
    half, total, rest = shards // 2, sum(quotas), sum(quotas)
    wanted, left = total * half // shards, []
    for k, quota in enumerate(quotas):
        rest -= quota
        left.append(hypergeometric(random.Random(f"{seed}|{shards}|{k}"), quota, rest, wanted - sum(left)))
    right = [a - b for a, b in zip(quotas, left, strict=True)]
    return splitting_tree(left, half, seed * 2 + 1) + splitting_tree(right, shards - half, seed * 2 + 2)


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 0, block_words: int = BLOCK_WORDS, slices: int = SLICES,
        cycle: tuple[int, ...] = CYCLE, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Documents (`row` unique, `doc_id`, `source`, `size` in words) -> the mix, and a table of sources.

    The mix has a row for each time a document is taken: `row, shard, shuffle_key, round, words`; `words` is less than the
    document's size in one document of a source at most. Documents without words are never taken. A null source is a
    source. Rows that repeat a document are documents of their own. `docs` is read several times: pass a written table.
    There are fewer than `shards` shards where each would have fewer than `SHARD_DRAWS` draws.
    """
    spark = docs.sparkSession
    sources = source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, most)
    sources = stage(
        sources.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("quota") - F.col("rounds") * F.col("source_size"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")), "mix-sources")
    worded = docs.where("size > 0").join(sources.select("source", "place", "blocks"), docs["source"].eqNullSafe(sources["source"])).select(
        "row", "size", "place", F.pmod(keyed(str(seed), F.col("doc_id")), F.col("blocks")).alias("block"),
        keyed(str(seed), "in", F.col("doc_id")).alias("inner"))
    rank = keyed(str(seed), "block", F.col("place"), F.col("block"))
    blocks = stage(
        worded.groupBy("place", "block").agg(F.sum("size").alias("words"))
        .withColumn("rank", rank).withColumn("slice", F.shiftright("rank", 60 - int(math.log2(slices))).cast("int")), "mix-blocks")
    # Words and blocks before each block in the permuted order: first by slice, then inside one slice of one source.
    by_slice = Window.partitionBy("place").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.groupBy("place", "slice").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("n")).select(
        "place", "slice", F.coalesce(F.sum("w").over(by_slice), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("n").over(by_slice), F.lit(0)).alias("blocks_before"))
    inside = Window.partitionBy("place", "slice").orderBy("rank", "block").rowsBetween(Window.unboundedPreceding, -1)
    ordered = (
        blocks.join(before, ["place", "slice"]).join(sources.select("place", "rounds", "rest"), "place")
        .withColumn("before", F.col("words_before") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .withColumn("draw", F.col("blocks_before") + F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0)))
    )
    # `last` is how many words the round beyond the whole ones takes of the block.
    ordered = stage(ordered.select(
        "place", "block", "draw", "rounds", "words",
        F.greatest(F.lit(0), F.least("words", F.col("rest") - F.col("before"))).alias("last")), "mix-draws")
    draws = {r["place"]: r["draws"] for r in ordered.groupBy("place").agg(
        F.sum(F.col("rounds") + (F.col("last") > 0).cast("long")).alias("draws")).collect()}
    in_round = {r["place"]: r["n"] for r in ordered.groupBy("place").count().withColumnRenamed("count", "n").collect()}
    places = sorted(draws)
    shards = max(1, min(shards, sum(draws.values()) // SHARD_DRAWS))
    tree = splitting_tree([draws[p] for p in places], shards, seed)
    ends, so_far = {p: [] for p in places}, dict.fromkeys(places, 0)
    for quotas in tree:
        for p, quota in zip(places, quotas, strict=True):
            so_far[p] += quota
            ends[p].append(so_far[p])
    plan = spark.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps([{"place": p, "in_round": in_round[p], "ends": ends[p]} for p in places])),
        "array<struct<place int, in_round bigint, ends array<bigint>>>")))
    spread = ordered.join(plan, "place")
    # The documents of a block that a cut round ends in, each with the words before it in the block.
    within = Window.partitionBy("place", "block").orderBy("inner", "row").rowsBetween(Window.unboundedPreceding, -1)
    located = worded.join(spread, ["place", "block"])
    cut = located.where("last > 0 AND last < words").withColumn("inner_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    whole = located.where("NOT (last > 0 AND last < words)").withColumn("inner_before", F.lit(0).cast("long"))
    partial = F.greatest(F.lit(0), F.least("size", F.col("last") - F.col("inner_before")))
    taken = whole.unionByName(cut).select(
        "row", "size", "draw", "in_round", "ends", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rounds"))).alias("round"),
        F.when(F.col("last") == F.col("words"), F.col("size")).otherwise(partial).alias("extra"), "rounds")
    taken = taken.withColumn("words", F.when(F.col("round") < F.col("rounds"), F.col("size")).otherwise(F.col("extra"))).where("words > 0")
    number = F.col("round") * F.col("in_round") + F.col("draw")
    rows = taken.select(
        "row", F.aggregate("ends", F.lit(0), lambda n, end: n + (end <= number).cast("int")).alias("shard"), "round", "words")
    return rows.withColumn("shuffle_key", keyed(str(seed), "order", F.col("shard"), F.col("row"), F.col("round"))), sources


def sized(documents: DataFrame, *keep: str) -> DataFrame:
    """A written table of `row`, the kept columns and the whole text's number of words."""
    return stage(documents.select(
        F.monotonically_increasing_id().alias("row"), *keep,
        F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size")), "mix-documents")


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix of `documents` as documents: a row for each time one is taken, by shard and in a shard by the shuffle key.

    A partition is a run of one shard's order, so files written from the result hold that order, and readers of files meet it.
    A document cut at its source's border keeps its first words. Rows carry every column of `documents`; `n_chars` is set
    again where the text was cut. With no words at all the mix is empty.
    """
    names = documents.columns
    keyed_rows = stage(documents.select(
        F.monotonically_increasing_id().alias("__row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("__doc")), "mix-rows")
    narrow = keyed_rows.select(
        F.col("__row").alias("row"), F.col("__doc.doc_id").alias("doc_id"), F.col("__doc.source").alias("source"),
        F.regexp_count(F.coalesce("__doc.text", F.lit("")), F.lit(WORD)).cast("long").alias("size"))
    narrow = stage(narrow, "mix-narrow")
    rows, _ = mix(narrow, **options)
    taken = stage(rows.join(narrow.select("row", "size"), "row").select(
        F.col("row").alias("__row"), F.when(F.col("words") < F.col("size"), F.col("words")).alias("__words"),
        F.col("shard").alias("__shard"), F.col("shuffle_key").alias("__key"), F.col("round").alias("__round"), F.col("words").alias("__taken")), "mix-taken")
    last, words = taken.agg(F.max("__shard"), F.sum("__taken")).first()
    shards = (last or 0) + 1
    # Runs of a shard: equal parts of the range of its keys, which are 60 even bits.
    parts = max(1, -(-(words or 0) // (shards * TASK_WORDS)))
    run = F.shiftright(F.shiftright("__key", 4 * DIGITS - 30) * F.lit(parts).cast("long"), 30)
    joined = keyed_rows.join(taken, "__row")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("__doc.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("__words").cast("int")), "")
    text = F.when(F.col("__words").isNull(), F.col("__doc.text")).otherwise(head)
    out = joined.select("__doc", text.alias("__text"), "__words", "__shard", "__key", "__row", "__round")
    out = out.repartitionById(shards * parts, (F.col("__shard") * parts + run).cast("int")).sortWithinPartitions("__shard", "__key", "__row", "__round")
    values = {"text": F.col("__text")}
    if "n_chars" in names:
        kind = documents.schema["n_chars"].dataType
        values["n_chars"] = F.when(F.col("__words").isNull(), F.col("__doc.n_chars")).otherwise(F.length("__text").cast(kind))
    return out.select(*[values.get(c, F.col(f"__doc.`{c}`")).alias(c) for c in names])


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The words that the mix takes of each of all `documents`, and its source's size and target."""
    docs = sized(table(spark, folder, "documents"), "doc_id", "source")
    rows, sources = mix(docs)
    taken = rows.groupBy("row").agg(F.sum("words").alias("taken"))
    named = docs.join(sources.select(F.col("source").alias("name"), "source_size", "target"), F.col("source").eqNullSafe(F.col("name")))
    return named.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


QUERIES = {"op9_mixing": op9_mixing}

_KEY = "('0x' || substr(md5({}), 1, 15))::BIGINT"
ORACLES = {"op9_mixing": rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sums
), weighed AS (
  SELECT *, (1 + (place - 1) % 3)::BIGINT AS weight, (source_size * 3)::BIGINT AS most FROM placed
), steps AS (
  SELECT *, most::DOUBLE / weight AS per, sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights,
    coalesce(sum(most) OVER before, 0)::BIGINT AS words_before, coalesce(sum(weight) OVER before, 0)::BIGINT AS weight_before
  FROM weighed WINDOW before AS (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cuts AS (
  SELECT *, per < (total - words_before)::DOUBLE / (weights - weight_before) AS cut FROM steps
), targets AS (
  SELECT source, source_size, place, CASE WHEN cut THEN most::DOUBLE ELSE
    (total - sum(CASE WHEN cut THEN most ELSE 0 END) OVER ()::BIGINT)::DOUBLE * weight
      / (weights - sum(CASE WHEN cut THEN weight ELSE 0 END) OVER ()::BIGINT) END AS target
  FROM cuts
), quotas AS (
  SELECT *, floor(target + 0.5)::BIGINT AS quota, greatest(1, ceil(source_size / {BLOCK_WORDS}.0))::BIGINT AS blocks FROM targets
), rounds AS (
  SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS rounds FROM quotas
), docs AS (
  SELECT d.doc_id, d.size, r.*, {_KEY.format("'0|' || d.doc_id")} % blocks AS block, {_KEY.format("'0|in|' || d.doc_id")} AS inner_key
  FROM sized d JOIN rounds r ON d.source IS NOT DISTINCT FROM r.source
), ordered AS (
  SELECT *, {_KEY.format("'0|block|' || place || '|' || block")} AS block_key FROM docs
), summed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY place ORDER BY block_key, block, inner_key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM ordered
)
SELECT doc_id, size, source_size, target,
  (rounds * size + greatest(0, least(size, quota - rounds * source_size - before)))::BIGINT AS taken
FROM summed"""}
