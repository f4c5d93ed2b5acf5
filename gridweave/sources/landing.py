"""Payloads landed as one object per request: `<prefix>/<source>/dt=<date>/<quoted request id>.json` below a root folder.

Spark's own file writers name their files themselves, so landing is a data source of its own: tasks write objects in parallel by key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from gridweave.functions.scalars import landing_key


@dataclass
class Landed(WriterCommitMessage):
    """What one task has landed: keys that were not there before, and those it replaced."""

    new: list[str]
    replaced: int


class LandingWriter(DataSourceWriter):
    """Writes rows `(key, payload)`.

    An object is written under a name of its own and then moved to its key, so a reader sees it whole or not at all, and a
    task that runs again puts the same bytes in the same place. When all tasks are done a marker `_landed/<job>` names the job; if one
    fails for good, the objects that the job added are taken away again (what it replaced stays, being the same request).
    """

    def __init__(self, root: str) -> None:
        self.root, self.job = root.rstrip("/"), uuid.uuid4().hex

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), self.root)

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        from pyarrow import fs

        files, root = self._files()
        made: set[str] = set()
        new, replaced = [], 0
        for row in iterator:
            path = f"{root}/{row['key']}"
            folder = path.rsplit("/", 1)[0]
            if folder not in made:
                files.create_dir(folder, recursive=True)
                made.add(folder)
            if files.get_file_info(path).type == fs.FileType.NotFound:
                new.append(row["key"])
            else:
                replaced += 1
            part = f"{folder}/.{uuid.uuid4().hex}"
            with files.open_output_stream(part, compression=None) as out:
                out.write((row["payload"] or "").encode())
            files.move(part, path)
        return Landed(new, replaced)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = self._files()
        files.create_dir(f"{root}/_landed", recursive=True)
        with files.open_output_stream(f"{root}/_landed/{self.job}", compression=None) as out:
            out.write(f"{sum(len(m.new) for m in messages if m)} new, {sum(m.replaced for m in messages if m)} replaced\n".encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = self._files()
        for message in messages:
            for key in message.new if message else ():
                files.delete_file(f"{root}/{key}")


class LandingSource(DataSource):
    """`df.write.format("landing").mode("append").save(root)` of rows `(key, payload)`."""

    @classmethod
    def name(cls) -> str:
        return "landing"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("Landing adds objects; write with mode append.")
        if not {"key", "payload"} <= set(schema.names):
            raise ValueError("Landing needs the columns key and payload.")
        return LandingWriter(self.options["path"])


def land(payloads: DataFrame, root: str, prefix: str) -> None:
    """Land `(source, request_id, event_time_utc, payload)`, one object per request.

    Of several rows with one key the one with the greatest payload is landed, in one place and in no order; they are copies of a request.
    """
    payloads.sparkSession.dataSource.register(LandingSource)
    key = landing_key(prefix, F.col("source"), F.col("request_id"), F.col("event_time_utc"))
    objects = payloads.select(key.alias("key"), "payload").where("key IS NOT NULL").groupBy("key").agg(F.max("payload").alias("payload"))
    objects.write.format("landing").mode("append").save(root)


def read_landed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Landed payloads with their lineage: `source_object_path`, the key below the root, `request_id` and `source`."""
    frame = spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(root)
    return frame.select("*", object_key(F.col("_metadata.file_path"), root).alias("source_object_path")).select(
        "*", request_of(F.col("source_object_path")).alias("request_id"), F.regexp_extract("source_object_path", r"([^/]+)/dt=[^/]*/[^/]*$", 1).alias("source"))


def object_key(path: Column, root: str) -> Column:
    """The key of a file below the root; Spark gives paths as quoted URIs."""
    name = root.rstrip("/").split("://")[-1].removeprefix("file:").strip("/").rsplit("/", 1)[-1]
    return F.url_decode(F.regexp_replace(F.regexp_extract(path, f"/{name}/(.*)$", 1), r"\+", "%2B"))


def request_of(key: Column) -> Column:
    """The request id of a key."""
    return F.url_decode(F.regexp_extract(key, r"/([^/]*)\.json$", 1))
