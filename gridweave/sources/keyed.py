"""Keyed tables kept up by numbered batches: idempotent writes, merges on read, compaction by bucket with an atomic switch.

Layout below a path:

* `batch=<number>/` – rows of one batch, replaced whole when the batch is written again;
* `base/version=<number>/bucket=<b>/` – rows of all batches up to that number whose keys fall in a bucket, one version of each key;
* `log/` – one row per finished batch or bucket: what is not in the log is not in the table.

A log row is appended after its data are complete, in a job of its own whose commit is one new file, so readers see a
batch or a compaction whole or not at all. A compaction rewrites only the buckets that later batches touch; the others keep their version.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "kind string, number long, bucket int"
BATCH, BUCKET = "__batch", "bucket"


class KeyedTable:
    """Rows with a key, of which one version counts.

    The newest by `order` counts (or with `first` the oldest), of equal ones that of the latest (earliest) batch. Rows with a null in
    one of `needs`, by default all of the key, are no versions of each other and all stay. Batch numbers ascend; a number may be written
    again, as a retried run does.
    """

    def __init__(
        self, path: str, keys: Sequence[str], order: Sequence[str] = (), *, needs: Sequence[str] | None = None, first: bool = False, buckets: int = 64
    ) -> None:
        self.path, self.keys, self.order, self.first, self.buckets = path.rstrip("/"), list(keys), list(order), first, buckets
        self.needs = self.keys if needs is None else list(needs)

    def _log(self, spark: SparkSession) -> list[tuple[str, int, int | None]]:
        """Finished batches and buckets, a row each: as many as there were batches, and `buckets` for each compaction."""
        try:
            return [tuple(r) for r in spark.read.schema(LOG).parquet(f"{self.path}/log").distinct().collect()]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _append(self, spark: SparkSession, rows: list[tuple[str, int, int | None]]) -> None:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    @staticmethod
    def _merged_up_to(log: list[tuple[str, int, int | None]]) -> int:
        return max((number for kind, number, _ in log if kind == "compaction"), default=-1)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def write(self, batch: DataFrame, number: int) -> None:
        """Add a batch, or put it in the place of the same number; one that a compaction already holds is left alone."""
        spark = batch.sparkSession
        if number <= self._merged_up_to(self._log(spark)):
            return
        batch.withColumn(BUCKET, self._bucket()).write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        self._append(spark, [("batch", number, None)])

    def _parts(self, spark: SparkSession, log, only: list[int] | None = None) -> tuple[DataFrame | None, DataFrame | None]:
        """(base rows, batch rows) with their batch numbers; of some buckets only, if so asked."""
        merged = self._merged_up_to(log)
        later = sorted(n for kind, n, _ in log if kind == "batch" and n > merged)
        newest: dict[int, int] = {}
        for kind, number, bucket in log:
            if kind == "base" and number <= merged:
                newest[bucket] = max(newest.get(bucket, -1), number)
        chosen = {b: n for b, n in newest.items() if only is None or b in only}
        base = spark.read.parquet(*[f"{self.path}/base/version={n}/bucket={b}" for b, n in sorted(chosen.items())]) if chosen else None
        if not later:
            return base, None
        new = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
            spark.read.parquet(f"{self.path}/batch={n}").withColumn(BATCH, F.lit(n).cast("long")) for n in later])
        return base, new if only is None else new.where(F.col(BUCKET).isin(only))

    def _one_version(self, rows: DataFrame) -> DataFrame:
        keyless = reduce(or_, [F.col(f"`{k}`").isNull() for k in self.needs])
        ranked = [F.col(c) for c in [*self.order, BATCH]]
        by_key = Window.partitionBy(*self.keys).orderBy(*[c.asc_nulls_last() if self.first else c.desc_nulls_last() for c in ranked], F.xxhash64(*[c for c in rows.columns if c != BATCH]))
        # Copies of a key beyond the first are trimmed before the shuffle.
        kept = rows.where(~keyless).withColumn("__rank", F.row_number().over(by_key)).where("__rank = 1").drop("__rank")
        return kept.unionByName(rows.where(keyless))

    def read(self, spark: SparkSession) -> DataFrame:
        """One version of each key, from the log as it is now."""
        base, new = self._parts(spark, self._log(spark))
        if base is None and new is None:
            raise FileNotFoundError(f"no finished batch under {self.path}")
        if new is None:
            return base.drop(BATCH, BUCKET)
        return self._one_version(_both(base, new.drop(BUCKET))).drop(BATCH)

    def compact(self, spark: SparkSession) -> None:
        """Merge all finished batches into the base and switch to it; a run that fails before the switch leaves the table as it was."""
        log = self._log(spark)
        _, new = self._parts(spark, log)
        if new is None:
            return
        number = max(n for kind, n, _ in log if kind == "batch")
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # `buckets` numbers at most
        base, some = self._parts(spark, log, touched)
        merged = self._one_version(_both(base, some.drop(BUCKET))).withColumn(BUCKET, self._bucket())
        target = f"{self.path}/base/version={number}"
        merged.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        self._append(spark, [*[("base", number, b) for b in touched], ("compaction", number, None)])


def _both(base: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if base is None else base.drop(BUCKET).unionByName(new, allowMissingColumns=True)
