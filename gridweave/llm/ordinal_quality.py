"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

One weight per hashed feature is shared by all grades, and ordered thresholds cut the score s into grades:
P(grade >= k) = sigmoid(s - threshold k). So a document gets an expected grade and a tail probability for selection.

Features are hashed words (A-Z as a-z), hashed beginnings of words (compounds of a stem share them), bytes, and a few
shares of repetition; each is the square root of its share in the text, so texts of all lengths have the same scale. A
feature that few sampled texts have keeps weight 0: it could only be learned by heart. The model is fitted on a
bounded sample of labelled rows, drawn by a hash of the id, in one task of an executor: features stay off the driver, which
gets weights and thresholds. Scoring reads every whole text.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave.llm.common import table, whole_text
from gridweave.llm.shingles import WordHasher, numbers, shingles, texts

HASH_BITS = 18
#: Bytes of the beginnings of words that are features beside the whole word.
HEADS = (5, 6, 7)
SHARES = 4
#: Sampled texts that must have a feature, and the probability of the highest grade from which a document is kept: labels of
#: the highest grade prevail, so an even chance of it is already a sign of something wrong.
LEAST_TEXTS, LEAST = 20, 0.8
FEATURES = (1 << HASH_BITS) + 256 + SHARES
#: Labelled rows that the model is fitted on, at most, and how many of them may share a doc_id.
SAMPLE, PER_ID = 5_000, 16
#: Features of rows that are in memory at once while the model is fitted.
PART = 1 << 22


def features(hasher: WordHasher, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers, ascending, and values of one text; none for a text without words."""
    words = hasher.words(data)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    kinds = [words, *(hasher.words(data, head) + salt for head, salt in zip(HEADS, numbers(len(HEADS), 12), strict=True))]
    found, counts = np.unique((np.concatenate(kinds) >> np.uint64(64 - HASH_BITS)).astype(np.int64), return_counts=True)
    letters = np.bincount(data, minlength=256)
    seen = np.flatnonzero(letters)
    lines = data.tobytes().split(b"\n")
    shares = np.array([
        np.count_nonzero(words[1:] == words[:-1]) / n,
        1 - len(shingles(words, 3)) / max(1, n - 2),
        1 - len(np.unique(words)) / n,
        1 - len(set(lines)) / len(lines)])
    at = np.flatnonzero(shares > 0)
    return (np.concatenate((found, (1 << HASH_BITS) + seen, (1 << HASH_BITS) + 256 + at)),
            np.sqrt(np.concatenate((counts / n, letters[seen] / len(data), shares[at]))).astype(np.float32))


@dataclass(frozen=True)
class Model:
    """Weights by feature and ascending thresholds, one less than grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by row."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -60, 60)))


def fit(starts: np.ndarray, index: np.ndarray, values: np.ndarray, grades: np.ndarray, levels: int,
        penalty: float = 1e-5, rounds: int = 300, rate: float = 0.3, least_texts: int = LEAST_TEXTS) -> Model:
    """Maximum penalised likelihood of rows `index[starts[i]:starts[i+1]]`, by full gradients with moments.

    Thresholds stay in order: they are a first one plus positive steps. Without rows all grades are equally likely.
    """
    rows = len(grades)
    weights = np.zeros(FEATURES)
    shape = np.zeros(levels - 1)  # first threshold, then logarithms of steps
    if rows:
        tail = np.array([(np.count_nonzero(grades >= k) + 1) / (rows + 2) for k in range(1, levels)])
        bounds = np.log((1 - tail) / tail)
        shape[0] = bounds[0]
        shape[1:] = np.log(np.maximum(np.diff(bounds), 0.05))
    cuts = [0]
    while cuts[-1] < rows:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(starts, starts[cuts[-1]] + PART, "right")) - 1))
    parts = [(lo, hi, slice(starts[lo], starts[hi])) for lo, hi in zip(cuts, cuts[1:])]
    of_row = lambda lo, hi: np.repeat(np.arange(hi - lo), np.diff(starts[lo:hi + 1]))
    common = np.zeros(FEATURES, np.int64)
    for _, _, of in parts:
        common += np.bincount(index[of], minlength=FEATURES)
    common = common >= least_texts
    moments = [np.zeros(FEATURES + levels - 1), np.zeros(FEATURES + levels - 1)]
    thresholds = lambda: shape[0] + np.concatenate(([0.0], np.cumsum(np.exp(shape[1:]))))
    for step in range(1, rounds + 1 if rows else 1):
        scores = np.concatenate([np.bincount(of_row(lo, hi), values[of] * weights[index[of]], hi - lo) for lo, hi, of in parts])
        tails = Model(weights, thresholds()).tails(scores)
        tails = np.concatenate((np.ones((rows, 1)), tails, np.zeros((rows, 1))), axis=1)
        upper, lower = tails[np.arange(rows), grades], tails[np.arange(rows), grades + 1]
        share = np.maximum(upper - lower, 1e-12)
        slopes = tails * (1 - tails)
        to_score = -(slopes[np.arange(rows), grades] - slopes[np.arange(rows), grades + 1]) / share / rows
        to_bound = np.zeros(levels - 1)
        for k in range(1, levels):
            to_bound[k - 1] = (slopes[grades == k, k] / share[grades == k]).sum() / rows - (slopes[grades == k - 1, k] / share[grades == k - 1]).sum() / rows
        to_shape = np.concatenate(([to_bound.sum()], np.exp(shape[1:]) * np.cumsum(to_bound[::-1])[::-1][1:]))
        to_weight = sum(np.bincount(index[of], values[of] * to_score[lo:hi][of_row(lo, hi)], FEATURES) for lo, hi, of in parts)
        gradient = np.concatenate((to_weight * common + penalty * weights, to_shape))
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights -= move[:FEATURES]
        shape -= 0.2 * move[FEATURES:]
    return Model(weights.astype(np.float32), thresholds())


def drawn(doc_id: str) -> Column:
    """A hash of the id, 40 bits."""
    return F.pmod(F.xxhash64(doc_id, F.lit(11)), F.lit(1 << 40))


def train(rated: DataFrame, levels: int, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` rows of `doc_id, text, grade` (0 to `levels` - 1), those with the smallest hash of the id.

    Rows with a null grade are passed over; a null text counts as empty. Of rows with the same id, `PER_ID` take part, those
    with the smallest hash of text and grade. Features are made where the rows are. One task fits: it holds `sample` rows at
    most, in files of its own, so `rated` is to be a sample already (`sampled_labels`), hardly larger than `sample`.
    """
    import pyarrow as pa

    of_id = Window.partitionBy("order", "doc_id").orderBy("tie", "grade")
    chosen = rated.where("grade IS NOT NULL").select(
        "doc_id", whole_text().alias("text"), F.col("grade").cast("int").alias("grade"), drawn("doc_id").alias("order"),
        F.xxhash64(whole_text(), F.lit(12)).alias("tie"))
    chosen = chosen.withColumn("place", F.row_number().over(of_id)).where(F.col("place") <= PER_ID).select("text", "grade", "order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            index, values = zip(*(features(hasher, data) for data in texts(batch.column(0))), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(1), batch.column(2), pa.array([x.astype("<i4").tobytes() for x in index], pa.binary()),
                pa.array([x.astype("<f4").tobytes() for x in values], pa.binary())], ["grade", "order", "index", "values"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, grades = [0], []
        with tempfile.TemporaryFile() as indexes, tempfile.TemporaryFile() as values:
            for batch in batches:
                for grade, i, v in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                    if len(grades) == sample:
                        break
                    grades.append(grade)
                    starts.append(starts[-1] + len(i) // 4)
                    indexes.write(i)
                    values.write(v)
            indexes.flush()
            values.flush()
            held = [np.memmap(f, kind, "r") if starts[-1] else np.zeros(0, kind) for f, kind in ((indexes, "<i4"), (values, "<f4"))]
            model = fit(np.array(starts, np.int64), *held, np.array(grades, np.int64), levels)
        yield pa.RecordBatch.from_arrays([
            pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.thresholds.astype("<f8").tobytes()], pa.binary())], ["weights", "thresholds"])

    made = chosen.mapInArrow(run, "grade int, order long, index binary, values binary")
    found = made.repartition(1).sortWithinPartitions("order", "index", "values").select("grade", "index", "values").mapInArrow(
        solve, "weights binary, thresholds binary").first()
    if found is None:
        return fit(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), levels)
    return Model(np.frombuffer(found["weights"], "<f4"), np.frombuffer(found["thresholds"], "<f8"))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`row` (all columns of `documents` as a struct, whatever their names), `expected_grade` and `tail_probability` (of the highest grade).

    A null text is empty.
    """
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, StructField, StructType

    weights, bounds = model.weights, model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, data in enumerate(texts(batch.column(1))):
                index, values = features(hasher, data)
                scores[i] = weights[index] @ values
            tails = 1 / (1 + np.exp(-np.clip(scores[:, None] - bounds, -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])], ["row", "expected_grade", "tail_probability"])

    given = documents.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return given.mapInArrow(run, StructType([given.schema["row"], StructField("expected_grade", DoubleType()), StructField("tail_probability", DoubleType())]))


def grades_of(labels: DataFrame) -> DataFrame:
    """`doc_id, grade` of labels that tell it, equal ones once: 0 is of low quality, 1 good but toxic, 2 good."""
    rating = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.where("quality IS NOT NULL").select("doc_id", rating.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL").distinct()


def sampled_labels(grades: DataFrame, sample: int) -> DataFrame:
    """A little over `sample` graded ids at most, those with the smallest hash of the id, so that few rows meet the texts."""
    share = min(1.0, (1.05 * sample + 100) / max(grades.count(), 1))
    return grades.where(drawn("doc_id") <= F.lit(int(share * (1 << 40))))


def judged(documents: DataFrame, labels: DataFrame, least: float = LEAST, sample: int = SAMPLE) -> DataFrame:
    """`row` (see `score`), `expected_grade`, `tail_probability` and `kept`: the highest grade is at least `least` likely.

    With no labels all grades are equally likely and the middle threshold decides; an empty table gives no rows.
    """
    # At most a little more than `sample` ids and grades: an id has three grades at most.
    chosen = F.broadcast(sampled_labels(grades_of(labels), sample).withColumnRenamed("doc_id", "id"))
    rated = documents.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("id")).select("doc_id", "text", "grade")
    model = train(rated, 3, sample)
    return score(documents, model).withColumn("kept", F.col("tail_probability") >= least)


def op7_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, probability of the best grade and verdict of all `documents`."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = judged(documents, table(spark, folder, "labels"))
    return found.select("row.doc_id", "expected_grade", "tail_probability", "kept")


QUERIES = {"op7_ordinal_quality": op7_ordinal_quality}
#: A fitted model is no SQL; tests measure it on labels it has not seen.
ORACLES: dict[str, str] = {}
