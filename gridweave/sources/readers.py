"""Table scans."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave import schemas


def read_bronze(spark: SparkSession, path: str, schema: str, *, dates: tuple[str, str] | None = None) -> DataFrame:
    """Pretty-printed JSON payloads, one object per file, in all folders below `path`.

    With `dates` only the `dt=` folders of that range are read.
    """
    reader = spark.read.schema(schema).option("multiLine", "true")
    if dates is None:
        return reader.option("recursiveFileLookup", "true").json(path)
    frame = reader.option("basePath", path).json(path)
    return frame.where(F.col("dt").between(*dates)).drop("dt")


def read_bronze_energy(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_bronze(spark, path, schemas.BRONZE_ENERGY, **options)


def read_bronze_weather(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_bronze(spark, path, schemas.BRONZE_WEATHER, **options)


def read_manifests(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_bronze(spark, path, schemas.BRONZE_MANIFEST, **options)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Silver or Gold Parquet; the partition column comes back as a date."""
    return spark.read.parquet(path)


def read_gold(spark: SparkSession, path: str, *, target: str | None = None) -> DataFrame:
    """All Parquet fragments below `path` with their schemas merged; none at all is an error.

    With `target`, rows without it are left out at the scan.
    """
    try:
        frame = spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"no Parquet files under {path}") from problem
    return frame.where(F.col(target).isNotNull()) if target else frame


def read_latest_partition(spark: SparkSession, path: str, partition: str = "settlement_date") -> DataFrame:
    """Rows of the newest partition, found in the list of files; the files of other partitions are not opened."""
    folders = {file.rsplit("/", 1)[0] for file in spark.read.schema(f"{partition} date").parquet(path).inputFiles()}
    dated = {found[1]: folder for folder in folders if (found := re.search(rf"/{partition}=(\d[^/]*)$", folder))}
    if not dated:
        raise FileNotFoundError(f"no dated Parquet files under {path}")
    reader = spark.read.option("basePath", path).option("mergeSchema", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(dated[max(dated)])


def read_metrics(spark: SparkSession, path: str, *, names: str = "*evaluation*.json") -> DataFrame:
    """Metrics documents of training runs: `evaluation.json` in any folder below `path`, pretty-printed or not.

    Spark writes the document as a folder of part files; pass that folder with `names="*.json"`.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names)
    return reader.option("multiLine", str(names != "*.json").lower()).json(path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Request bodies, one file each, as `value` with their `path`."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        "value", F.col("_metadata.file_path").alias("path")
    )
