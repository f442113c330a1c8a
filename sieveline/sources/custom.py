"""Data sources of Spark's Python interface: listings with pushed filters, and an append-only run log with a commit."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith, WriterCommitMessage

from sieveline.sources.ranges import on_workers


def _store(path: str):
    """(store, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Folder(InputPartition):
    path: str
    deep: bool


def _meets(value: object, test: Filter) -> bool:
    """Whether a value meets a pushed filter."""
    tests = {
        EqualTo: lambda: value == test.value, In: lambda: value in test.value, GreaterThan: lambda: value > test.value, GreaterThanOrEqual: lambda: value >= test.value,
        LessThan: lambda: value < test.value, LessThanOrEqual: lambda: value <= test.value, StringStartsWith: lambda: value.startswith(test.value), StringEndsWith: lambda: value.endswith(test.value),
    }
    return tests[type(test)]()


class ListingReader(DataSourceReader):
    """Lists each first-level folder in a task; filters on the folder's name decide which are opened at all."""

    def __init__(self, path: str) -> None:
        self.path, self.tests = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  Spark's name
        for f in filters:
            known = isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith))
            if known and f.attribute in (("folder",), ("name",), ("n_bytes",)):
                self.tests.append((f.attribute[0], f))
            else:
                yield f

    def partitions(self) -> list[Folder]:
        from pyarrow import fs

        store, at = _store(self.path)
        found = [x for x in store.get_file_info(fs.FileSelector(at)) if x.type == fs.FileType.Directory and not x.base_name.startswith(("_", "."))]
        wanted = [x for x in found if all(_meets(x.base_name, t) for name, t in self.tests if name == "folder")]
        top = all(_meets("", t) for name, t in self.tests if name == "folder")
        return [Folder(x.path, True) for x in wanted] + [Folder(at, False)] * top or [Folder("", False)]

    def read(self, partition: Folder) -> Iterator[tuple]:
        from pyarrow import fs

        if not partition.path:
            return
        store, at = _store(self.path)
        inside = len(partition.path.rstrip("/")) + 1
        for x in store.get_file_info(fs.FileSelector(partition.path, recursive=partition.deep)):
            hidden = any(part.startswith(("_", ".")) for part in x.path[inside:].split("/"))
            if x.type != fs.FileType.File or hidden:
                continue
            row = {"folder": partition.path.rsplit("/", 1)[1] if partition.deep else "", "name": x.base_name, "n_bytes": x.size}
            if all(_meets(row[name], t) for name, t in self.tests):
                yield x.path, row["folder"], row["name"], x.size, x.mtime


class Listing(DataSource):
    """``files_below``: (path, folder, name, n_bytes, modified) of the files below option ``path``; ``folder`` is the first level's name."""

    @classmethod
    def name(cls) -> str:
        return "files_below"

    def schema(self) -> str:
        return "path string, folder string, name string, n_bytes long, modified timestamp"

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options["path"])


def files_below(spark: SparkSession, path: str) -> DataFrame:
    """A lazy listing; filters on folder, name and n_bytes reach it, and one on the folder opens no other folder."""
    on_workers(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Listing)
    return spark.read.format("files_below").option("path", path).load()


@dataclass
class Part(WriterCommitMessage):
    file: str
    entries: int


class LogWriter(DataSourceWriter):
    """Each task writes a file of its own; a manifest that names the files of successful tasks makes them part of the log.

    What a killed or a repeated task has written is named nowhere, so that it is never read; when the batch ends it is removed,
    but for what a task is still writing then.
    """

    def __init__(self, path: str, names: list[str]) -> None:
        self.path, self.names, self.batch = path.rstrip("/"), names, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def write(self, rows: Iterator) -> Part:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, at = _store(self.path)
        folder = f"{at}/entries/{self.batch}"
        store.create_dir(folder)
        file = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}.jsonl"
        n = 0
        with store.open_output_stream(file) as out:
            for n, row in enumerate(rows, 1):
                out.write((json.dumps({"batch": self.batch, "part": task.partitionId(), "line": n, **dict(zip(self.names, row, strict=True))}, ensure_ascii=False, default=str) + "\n").encode())
        return Part(file, n)

    def _sweep(self, keep: set[str]) -> None:
        from pyarrow import fs

        store, at = _store(self.path)
        for x in store.get_file_info(fs.FileSelector(f"{at}/entries/{self.batch}", allow_not_found=True)):
            if x.path not in keep:
                store.delete_file(x.path)

    def commit(self, messages: list[Part | None]) -> None:
        store, at = _store(self.path)
        done = [m for m in messages if m is not None]
        self._sweep({m.file for m in done})
        store.create_dir(f"{at}/batches")
        with store.open_output_stream(f"{at}/batches/_{self.batch}") as out:
            out.write(json.dumps({"batch": self.batch, "files": [m.file for m in done if m.entries], "entries": sum(m.entries for m in done)}).encode())
        store.move(f"{at}/batches/_{self.batch}", f"{at}/batches/{self.batch}.json")

    def abort(self, messages: list[Part | None]) -> None:
        self._sweep(set())


class RunLog(DataSource):
    """``run_log``: appends rows as JSON lines below option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "run_log"

    def writer(self, schema, overwrite: bool) -> LogWriter:
        if overwrite:
            raise ValueError("a run log is only appended to")
        return LogWriter(self.options["path"], schema.names)


def append_to_log(df: DataFrame, path: str) -> None:
    """Appends the rows in one batch: all of them or none, each once, whatever tasks are lost or repeated."""
    on_workers(df.sparkSession)
    df.sparkSession.dataSource.register(RunLog)
    df.write.format("run_log").mode("append").option("path", path).save()


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log's entries with batch, part and line, which order them; files that no manifest names aren't read."""
    at = path.rstrip("/")
    batches = spark.read.schema("batch string, files array<string>, entries long").json(f"{at}/batches")
    files = [r["file"] for r in batches.select(F.explode("files").alias("file")).toLocalIterator()]
    whole = f"batch string, part int, line long, {schema}"
    return spark.read.schema(whole).json(files) if files else spark.createDataFrame([], whole)
