"""The snapshot tree as a Spark data source: <root>/dt=YYYY-MM-DD/hour=HH/*.pb, one feed message per file.

    spark.read.format("snapshot_tree").option("first", "2024-01-10").option("last", "2024-01-10").option("stride", 5).load(root)
    files.write.format("snapshot_tree").mode("append").save(root)

Planning looks at day and hour folders only, and only at those of the wanted days. Each partition is
a group of hour folders; its task lists them, takes every n-th file in path order and opens just these. No
path of a file ever reaches the driver.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    LessThan, LessThanOrEqual, WriterCommitMessage,
)

NAME = "snapshot_tree"
SCHEMA = "service_date date, hour int, path string, content binary"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
BATCH = 16 << 20  # bytes of file contents that are handed on together
#: Stores that tasks can open from Python; ``sources.snapshots`` reads others through Spark's binary files.
SCHEMES = ("file", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def scheme_of(root: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", root)
    return found[1].lower() if found else "file"


def open_store(root: str) -> tuple[fs.FileSystem, str]:
    """The store of a root and the root's path in it; Spark's spellings of local and S3 paths are understood."""
    root = re.sub(r"^file:/+", "/", root.rstrip("/"))
    if root.startswith("/"):
        return fs.LocalFileSystem(), root
    return fs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", root))


@dataclass
class HourFolders(InputPartition):
    """Hour folders of one task, each with its day and hour, and the share of their files that is read here."""

    folders: list[tuple[date, int | None, str]]
    slice: int = 0


class SnapshotTree(DataSource):
    """Options: ``path``; ``first`` and ``last`` day (both or none); ``stride``: every n-th file of an hour (1);
    ``partitions``: about as many groups of hour folders at most (200); ``slices``: tasks that share a group's files (1); ``pushdown``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        pushed = str(self.options.get("pushdown", "false")).lower() == "true"
        return (PushedTreeReader if pushed else TreeReader)(dict(self.options.items()))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("snapshots are appended; delete a day's folder to replace it")
        return TreeWriter(self.options["path"])


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        self.stride, self.slices = (int(options.get(k, 1)) for k in ("stride", "slices"))
        self.most = int(options.get("partitions", 200))
        if min(self.stride, self.slices, self.most) < 1:
            raise ValueError("stride, slices and partitions start at 1")
        self.first, self.last = (date.fromisoformat(options[k]) if k in options else None for k in ("first", "last"))

    def wanted(self, day: date) -> bool:
        return True

    def _days(self, store: fs.FileSystem, root: str) -> list[date]:
        if self.first and self.last:
            days = [self.first + timedelta(days=i) for i in range((self.last - self.first).days + 1)]
        else:
            names = (info.base_name for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)))
            days = sorted(date.fromisoformat(n[3:]) for n in names if re.fullmatch(r"dt=\d{4}-\d\d-\d\d", n))
        return [d for d in days if self.wanted(d)]

    def partitions(self) -> Sequence[InputPartition]:
        store, root = open_store(self.root)
        folders: list[tuple[date, int | None, str]] = []
        for day in self._days(store, root):
            inside = store.get_file_info(fs.FileSelector(f"{root}/dt={day}", allow_not_found=True))
            hours = sorted(i.base_name for i in inside if i.type == fs.FileType.Directory and re.fullmatch(r"hour=\d+", i.base_name))
            folders += [(day, int(h[5:]), f"dt={day}/{h}") for h in hours]
            if any(i.type == fs.FileType.File for i in inside):
                folders.append((day, None, f"dt={day}"))
        hours = -(-len(folders) // self.most) or 1
        groups = [folders[k:k + hours] for k in range(0, len(folders), hours)]
        return [HourFolders(g, s) for g in groups for s in range(self.slices)] or [HourFolders([])]

    def read(self, partition: HourFolders) -> Iterator[pa.RecordBatch]:
        store, root = open_store(self.root)
        names = ["service_date", "hour", "path", "content"]
        kinds = [pa.date32(), pa.int32(), pa.string(), pa.binary()]
        rows, size = [], 0
        for day, hour, folder in partition.folders:
            listed = store.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True))
            files = sorted(i.base_name for i in listed if i.type == fs.FileType.File and i.base_name.endswith(".pb") and i.base_name[0] not in "._")
            for name in files[::self.stride][partition.slice::self.slices]:
                with store.open_input_stream(f"{root}/{folder}/{name}") as opened:
                    content = opened.read()
                rows.append((day, hour, f"{self.root}/{folder}/{name}", content))
                size += len(content)
                if size > BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


class PushedTreeReader(TreeReader):
    """Takes conditions on ``service_date`` as well, so that folders of other days are not listed."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == ("service_date",):
                self.tests.append(f)
            else:
                yield f

    def wanted(self, day: date) -> bool:
        holds = {EqualTo: day.__eq__, In: lambda days: day in days, GreaterThan: day.__gt__, GreaterThanOrEqual: day.__ge__,
                 LessThan: day.__lt__, LessThanOrEqual: day.__le__}
        return all(holds[type(f)](f.value) is True for f in self.tests)


class TreeWriter(DataSourceWriter):
    """Writes each row's content under its day and hour, named by the end of its path.

    A file appears whole or not at all and a repeated task writes the same names again, so there is nothing to commit.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def write(self, iterator) -> WriterCommitMessage:
        store, root = open_store(self.root)
        local, made = isinstance(store, fs.LocalFileSystem), set()
        for row in iterator:
            folder = f"{root}/dt={row.service_date}" + ("" if row.hour is None else f"/hour={row.hour:02}")
            name = row.path.rsplit("/", 1)[-1]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            draft = f"{folder}/.{name}.{uuid.uuid4().hex}" if local else f"{folder}/{name}"
            with store.open_output_stream(draft) as opened:
                opened.write(bytes(row.content))
            if local:
                store.move(draft, f"{folder}/{name}")
        return WriterCommitMessage()


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SnapshotTree)


def read_tree(spark: SparkSession, root: str, first: date | None = None, last: date | None = None, stride: int = 1,
              slices: int = 1) -> DataFrame:
    """Files as (service_date, hour, path, content); conditions on ``service_date`` prune day folders where the session allows it."""
    register(spark)
    reader = spark.read.format(NAME).option("stride", stride).option("slices", slices)
    reader = reader.option("partitions", max(32, 4 * spark.sparkContext.defaultParallelism))
    reader = reader.option("pushdown", spark.conf.get(PUSHDOWN, "false"))
    if first and last:
        reader = reader.option("first", first.isoformat()).option("last", last.isoformat())
    return reader.load(root)


def write_tree(files: DataFrame, root: str) -> None:
    register(files.sparkSession)
    files.select("service_date", "hour", "path", "content").write.format(NAME).mode("append").save(root)
