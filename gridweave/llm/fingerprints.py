"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits.

A text's five-word shingles are hashed once. The top bits of a hash name its bin, the smallest hash of a bin is kept. An empty
bin borrows from a bin drawn by its own random sequence, the first that is not empty ("optimal densification"): each empty
bin draws by itself, so borrowed values are as good as if drawn anew. Of each bin the low `BITS` bits are stored. Two
different minima agree in them by chance once in 2^BITS; likeness takes that out.

Everything is an expression of built-in functions on one row; finding the next document takes one shuffle of the texts.
"""

from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave.llm.common import table, whole_text, words_of
from gridweave.session import stage

SHINGLE, BINS, BITS = 5, 128, 8
PER_LONG = 64 // BITS
#: Rows that are put in order together, on average, and ranges of ids that are cut into such parts.
ROWS_PER_PART, RANGES = 1000, 250


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def probe_steps(bins: int = BINS) -> tuple[list[int], list[int]]:
    """For each bin an odd step and a start: a full cycle through all bins (their number is a power of two), in an order of its own."""
    draw = random.Random(bins)
    return [2 * draw.randrange(bins // 2) + 1 for _ in range(bins)], [draw.randrange(bins) for _ in range(bins)]


def shingle_hashes(text: Column) -> Column:
    """Hashes of the five-word shingles; of fewer words, one of the whole sequence; none without words."""
    hashed = F.transform(words_of(text), lambda w: F.xxhash64(w))

    def shingles(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(w, i, SHINGLE)))
        return F.when(F.size(w) >= SHINGLE, many).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return let(hashed, shingles)


def bin_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - (BINS.bit_length() - 1)).cast("int")


def fingerprint(text: Column) -> Column:
    """Packed fingerprint as an array of longs; empty for a text without words."""
    # The bin takes part in the stored bits: a minimum that several bins hold agrees with another by chance in each by itself.
    low = lambda h, b: F.xxhash64(h, b).bitwiseAND(F.lit((1 << BITS) - 1))
    steps, starts = (F.array(*map(F.lit, x)) for x in probe_steps())

    def minima(h: Column) -> Column:
        """The smallest hash of each bin that has one; sorted hashes have the bins' hashes side by side."""
        return F.filter(h, lambda x, i: F.when(i == 0, True).otherwise(bin_of(x) != bin_of(F.get(h, i - 1))))

    def placed(m: Column) -> Column:
        """By bin, its minimum or null."""
        by_bin = F.map_from_arrays(F.transform(m, bin_of), m)
        # Hashes are sorted as signed numbers: the upper half of the bins comes first.
        full = F.concat(F.slice(m, BINS // 2 + 1, BINS // 2), F.slice(m, 1, BINS // 2))
        return F.when(F.size(m) == BINS, full).otherwise(
            let(by_bin, lambda known: F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.try_element_at(known, b))))

    def dense(values: Column) -> Column:
        def borrowed(b: Column, probes: int) -> Column:
            drawn = F.transform(F.sequence(F.lit(0), F.lit(probes - 1)), lambda t: (F.get(steps, b) * t + F.get(starts, b)).bitwiseAND(F.lit(BINS - 1)))
            return F.get(F.filter(F.transform(drawn, lambda c: F.get(values, c)), lambda v: v.isNotNull()), F.lit(0))

        return F.transform(values, lambda v, b: low(F.coalesce(v, borrowed(b, 8), borrowed(b, BINS)), b))

    def packed(values: Column) -> Column:
        def one(k: Column) -> Column:
            out = F.get(values, k * PER_LONG)
            for j in range(1, PER_LONG):
                out = out.bitwiseOR(F.shiftleft(F.get(values, k * PER_LONG + j), j * BITS))
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), one)

    def of(m: Column) -> Column:
        return F.when(F.size(m) == 0, F.array().cast("array<bigint>")).otherwise(let(placed(m), lambda v: let(dense(v), packed)))

    return let(F.sort_array(shingle_hashes(text)), lambda h: let(minima(h), of))


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints: equal entries, corrected for chance, not below 0.

    Two texts without words are alike (1), one without words is not like any other (0).
    """
    def different(x: Column) -> Column:
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(mask)))
        return F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))

    unequal = F.aggregate(F.zip_with(a, b, lambda x, y: different(x.bitwiseXOR(y))), F.lit(0), lambda n, d: n + d)
    chance = 1 / (1 << BITS)
    estimate = ((1 - unequal / BINS) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(F.greatest(F.lit(0.0), estimate))


def in_parts(rows: DataFrame, order: str, tie: str = "tie", rows_per_part: int = ROWS_PER_PART, ranges: int = RANGES) -> DataFrame:
    """Add `part`, which ascends with (`order`, `tie`), nulls of `order` last, and has about `rows_per_part` rows.

    Approximate quantiles cut the values into ranges of like size; each range is cut evenly by value. A value that is
    several quantiles by itself, and null, are cut evenly by `tie`, a 64-bit hash. Only the quantiles reach the driver.
    """
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(order).isNull()).alias("nulls"),
                     F.percentile_approx(order, [i / ranges for i in range(ranges + 1)], ranges * 10).alias("q")).first()
    quantiles = [int(q) for q in found["q"] or [0]]
    share = found["n"] / rows_per_part
    heavy = {q: math.ceil(n / ranges * share) for q, n in Counter(quantiles).items() if n > 2}
    bounds = sorted({*quantiles, *(q + 1 for q in heavy)})  # a heavy value is alone in its range
    inner, deep = max(1, round(share / max(1, len(bounds) - 1))), max([1, math.ceil(found["nulls"] / rows_per_part), *heavy.values()])
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    at = F.size(F.filter(edges, lambda edge: edge <= F.col(order)))
    low, high = F.get(edges, (F.col("__range") - 1).cast("int")), F.coalesce(F.get(edges, F.col("__range").cast("int")), F.lit(bounds[-1] + 1))
    place = F.floor((F.col(order) - low).cast("double") / (high - low) * inner)
    part = F.col("__range") * inner + F.greatest(F.lit(0), F.least(place, F.lit(inner - 1)))
    pieces = F.lit(1)
    if heavy:
        pieces = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x).cast("long") for pair in heavy.items() for x in pair]), F.col(order).cast("long")), pieces)
    pieces = F.when(F.col(order).isNull(), math.ceil(found["nulls"] / rows_per_part)).otherwise(pieces)
    below = F.least(F.floor((F.col(tie).cast("double") / 2.0**64 + 0.5) * pieces), pieces - 1)
    return rows.withColumn("__range", at.cast("long")).withColumn(
        "part", (F.when(F.col(order).isNull(), F.lit((len(bounds) + 1) * inner)).otherwise(part) * deep + below).cast("long")).drop("__range")


def next_parts(parts: DataFrame, together: int = 100_000) -> DataFrame:
    """`part, after`: the next part there is, after the last the first; numbers of parts only, put in order by stretches of them."""
    stretch = F.floor(F.col("part") / together)
    inside = stage(parts.select("part", F.lead("part").over(Window.partitionBy(stretch).orderBy("part")).alias("after"), stretch.alias("stretch")), "next-parts")
    firsts = inside.groupBy("stretch").agg(F.min("part").alias("first"))
    everywhere = Window.orderBy("stretch")  # one number for each `together` numbers of parts
    following = firsts.select("stretch", F.coalesce(F.lead("first").over(everywhere), F.first("first").over(everywhere)).alias("later"))
    return inside.join(following, "stretch").select("part", F.coalesce("after", "later").alias("after"))


def edited_columns() -> list[Column]:
    """What the edited text of `text` before `next_text` gives, from n_chars."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    return [F.sha2(edited, 256).alias("edited_sha256"), fingerprint(edited).alias("edited_print")]


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of the texts of `documents` and of their edited texts, which end with the beginning of the next document.

    Takes the columns `doc_id` and `text`; others are not looked at. A null text is empty, and an empty text has an empty
    fingerprint. Documents are in order of doc_id, null ids last; of rows with equal ids by a hash of the text; the last is
    followed by the first, a single one by itself. Every row gives a row; an empty table gives none.

    Texts move once, to meet their next one. Each fingerprint is made once; of the rows at a part's ends the texts are written, too.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = in_parts(docs.withColumn("tie", F.xxhash64("text")), "doc_id")
    by_part = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_last(), "tie")
    inside = rows.withColumn("print", fingerprint(F.col("text"))).select(
        "part", "doc_id", F.length("text").cast("long").alias("n_chars"), "text", "print",
        F.lead(F.struct("text", "print")).over(by_part).alias("next"), (F.row_number().over(by_part) == 1).alias("first"))
    met = inside.withColumn("next_text", F.col("next.text")).select(
        "part", "doc_id", "n_chars", "print", F.col("next.print").alias("next_print"), *edited_columns(), "first", F.col("next").isNull().alias("last"),
        F.when(F.col("first") | F.col("next").isNull(), F.col("text")).alias("text"))
    met = stage(met, "fingerprints")
    firsts = met.where("first").select(F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("print").alias("next_print"))
    ends = met.where("last").select("part", "doc_id", "n_chars", "text", "print").join(next_parts(firsts.select(F.col("after").alias("part"))), "part").join(firsts, "after")
    made = ["doc_id", "n_chars", "print", "next_print", "edited_sha256", "edited_print"]
    both = met.where("NOT last").select(*made).unionByName(ends.select(*made[:4], *edited_columns()))
    return both.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all `documents` and of their edited texts."""
    return fingerprints(table(spark, folder, "documents"))


QUERIES = {"op2_fingerprints": op2_fingerprints}
#: The hash is no SQL function elsewhere; tests compare with a brute-force version.
ORACLES: dict[str, str] = {}
