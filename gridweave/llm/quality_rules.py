"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Measures of each text are columns of built-in functions. Every rule turns measures into a vote: 1 (good), -1 (bad) or 0
(abstains). The corpus is then counted by vote pattern, at most 3^rules rows whatever its size, and
expectation-maximisation over those counts estimates the share of good documents and how often each rule is right on good
and on bad ones. A document's posterior probability follows from its votes as one sum of logarithms.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import BLANKS, table, whole_text, words_of
from gridweave.session import stage

SYMBOLS = "#*$%&|<>"
#: Frequent words of English, German, French and Spanish.
COMMON = (
    "the of and to in is that for it as was with be by on from this at or an are a "
    "der die und das von zu den mit sich des auf ist im dem nicht ein eine als auch es an "
    "de la le et les des en un du une que est pour qui dans par sur au il "
    "el los se las por con no su para al lo como del y").split()
WINDOW = 8
#: Bounds of a rule's accuracies. Bad documents are bad in different ways, so a rule may miss most of them; but its vote must
#: be `MARGIN` likelier on the side it names than on the other, or good and bad could change places.
LEAST, MOST, MARGIN, ROUNDS = 0.5, 0.999, 0.01, 200
#: The start says what the rules are made for: hardly ever to blame a good document, and each to know one kind of bad ones.
START = (0.97, 0.3)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_calls", "n_distinct", "n_echoes", "n_plain", "n_common")


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(hashes: Column) -> Column:
    """Words that lie in windows of 8 words found twice or more in the text."""
    windows = F.when(F.size(hashes) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))

    def covered(at: Column) -> Column:
        """Words under windows that start at the sorted positions."""
        steps = F.transform(at, lambda p, i: F.when(i + 1 < F.size(at), F.least(F.lit(WINDOW), F.get(at, i + 1) - p)).otherwise(WINDOW))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def twice(found: Column) -> Column:
        same = lambda s, other: other.isNotNull() & (other["h"] == s["h"])
        kept = F.filter(found, lambda s, i: F.when(i > 0, same(s, F.get(found, i - 1))).otherwise(False) | same(s, F.get(found, i + 1)))
        return let(F.sort_array(F.transform(kept, lambda s: s["at"])), covered)

    def of(w: Column) -> Column:
        located = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(let(located, twice))

    return let(windows, of)


def measure(documents: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the measures of the whole text, a row per row; a null text has no words. Ids may be null or repeat."""
    text = whole_text()
    dropped = lambda characters: F.length("__t") - F.length(F.translate("__t", characters, ""))
    lines = F.filter(F.split("__t", "\n"), lambda line: F.translate(line, BLANKS, "") != "")
    read = documents.select(*keep, text.alias("__t")).select(
        *keep, "__t", F.transform(words_of(F.col("__t")), lambda w: F.xxhash64(w)).alias("__w"), lines.alias("__l"))
    common = [row[0] for row in documents.sparkSession.range(1).select(
        F.explode(F.transform(F.array(*map(F.lit, sorted(set(COMMON)))), lambda w: F.xxhash64(w)))).collect()]
    out = {
        "n_words": F.size("__w"),
        "word_chars": F.length(F.translate("__t", BLANKS, "")),
        "n_symbols": dropped(SYMBOLS),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": repeated_words(F.col("__w")),
        "n_lines": F.size("__l"),
        "n_upper": dropped("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_calls": dropped("!"),
        "n_distinct": F.size(F.array_distinct("__w")),
        "n_plain": F.size(F.filter(words_of(F.col("__t")), lambda w: w.rlike(r"^\p{L}+[.,;:!?]?$"))),
        "n_common": F.size(F.filter("__w", lambda h: h.isin(common))),
        "n_echoes": F.size(F.filter("__w", lambda w, i: F.when(i > 0, F.get("__w", i - 1) == w).otherwise(False))),
    }
    return read.select(*keep, *[out[name].cast("long").alias(name) for name in MEASURES])


@dataclass(frozen=True)
class Rule:
    """Votes good or bad where its condition holds, and abstains where neither does. Conditions are SQL over measures."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)


#: Ratios are written as products, so that a text without words abstains or is bad by a plain rule.
RULES = (
    Rule("length", "n_words < 20", "n_words >= 50"),
    Rule("word_length", "word_chars > 14 * n_words OR 2 * word_chars < 5 * n_words", "word_chars >= 3 * n_words AND word_chars <= 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "n_words > 0 AND 50 * n_symbols <= n_words"),
    Rule("lines", "10 * n_dup_lines > 3 * n_lines", "n_lines > 1 AND 20 * n_dup_lines <= n_lines"),
    Rule("repeats", "100 * n_repeat_words > 20 * n_words", "n_words >= 50 AND 100 * n_repeat_words <= 5 * n_words"),
    Rule("capitals", "10 * n_upper > 3 * word_chars", "word_chars > 0 AND 10 * n_upper <= word_chars"),
    Rule("calls", "10 * n_calls > n_words", "n_words > 0 AND 100 * n_calls <= n_words"),
    Rule("variety", "10 * n_distinct < n_words", "n_words > 0 AND 10 * n_distinct >= 2 * n_words"),
    Rule("plain_words", "10 * n_plain < 7 * n_words", "n_words > 0 AND 10 * n_plain >= 9 * n_words"),
    Rule("common_words", "100 * n_common < 3 * n_words", "n_words > 0 AND 100 * n_common >= 8 * n_words"),
    Rule("echoes", "10 * n_echoes > n_words", "n_words > 0 AND 50 * n_echoes <= n_words"),
)


@dataclass(frozen=True)
class Weights:
    """Share of good documents; for each rule how often a vote is right on good and on bad documents."""

    good: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def log_odds(self, votes: Sequence[Column] | Sequence[int]):
        """Logarithm of the odds of good; of columns or of numbers."""
        total = math.log(self.good / (1 - self.good))
        for vote, g, b in zip(votes, self.right_on_good, self.right_on_bad, strict=True):
            up, down = math.log(g / (1 - b)), math.log((1 - g) / b)
            total = total + (F.when(vote == 1, up).when(vote == -1, down).otherwise(0.0) if isinstance(vote, Column) else (up, 0.0, down)[1 - vote])
        return total


def estimate(counts: Sequence[tuple[tuple[int, ...], int]]) -> Weights:
    """Expectation-maximisation over (votes, documents) from a fixed start until it stands still."""
    rules = len(counts[0][0]) if counts else 0
    at = Weights(0.8, (START[0],) * rules, (START[1],) * rules)
    for _ in range(ROUNDS if any(n for _, n in counts) else 0):
        mass = [[1.0, 1.0], *[[2.0, 2.0, 2.0, 2.0] for _ in range(rules)]]  # a few imagined votes keep shares off 0 and 1
        right = [[1.6, 1.6] for _ in range(rules)]
        for votes, n in counts:
            p = 1 / (1 + math.exp(-max(-500, min(500, at.log_odds(votes)))))
            mass[0][0] += n * p
            mass[0][1] += n * (1 - p)
            for k, v in enumerate(votes):
                if v:
                    mass[k + 1][0] += n * p
                    mass[k + 1][1] += n * (1 - p)
                    right[k][0 if v > 0 else 1] += n * (p if v > 0 else 1 - p)
        on_good = tuple(min(MOST, max(LEAST, r[0] / m[0])) for r, m in zip(right, mass[1:], strict=True))
        on_bad = tuple(min(MOST, max(1 - g + MARGIN, r[1] / m[1])) for r, m, g in zip(right, mass[1:], on_good, strict=True))
        new = Weights(min(0.99, max(0.01, mass[0][0] / sum(mass[0][:2]))), on_good, on_bad)
        moved = max(abs(a - b) for a, b in zip((new.good, *new.right_on_good, *new.right_on_bad), (at.good, *at.right_on_good, *at.right_on_bad), strict=True))
        at = new
        if moved < 1e-9:
            break
    return at


def fit(measured: DataFrame, rules: Sequence[Rule] = RULES) -> Weights:
    """Weights from the votes on all rows of `measured`; an empty table gives the start values."""
    votes = [rule.vote().alias(f"v{k}") for k, rule in enumerate(rules)]
    names = [f"v{k}" for k in range(len(rules))]
    counts = measured.select(*votes).groupBy(*names).count().collect()
    pairs = sorted((tuple(row[n] for n in names), row["count"]) for row in counts)
    return estimate(pairs or [((0,) * len(rules), 0)])


def posterior(weights: Weights, rules: Sequence[Rule] = RULES) -> Column:
    """Probability that the document is good."""
    return 1 / (1 + F.exp(-weights.log_odds([rule.vote() for rule in rules])))


def judge(measured: DataFrame, rules: Sequence[Rule] = RULES, least: float = 0.5) -> DataFrame:
    """Add `quality` (posterior probability), `base_failed` and `kept`. `measured` is read twice: pass a written table."""
    weights = fit(measured, rules)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumn("quality", posterior(weights, rules)).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= least))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of all `documents`, a row per row.

    Null ids are kept as they are, and repeated rows are measured and counted by the fit each time. A null or empty text has no words and
    fails the base rules; a very long one is one row. An empty table gives no rows; of other columns none is looked at.
    """
    measured = stage(measure(table(spark, folder, "documents"), "doc_id"), "quality-measures")
    return judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


QUERIES = {"op4_quality_rules": op4_quality_rules}
#: The estimate runs until it stands still, which SQL does not express; tests compare with brute force.
ORACLES: dict[str, str] = {}
