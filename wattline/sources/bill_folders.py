"""Bill folders as a Spark data source, listed by the executors.

The driver lists only the malls; a task lists one mall's bill folder. As a
stream, a batch holds the files whose modification time lies between its two
offsets, so an arriving file is listed once. The file system is whatever the
path names (local, or a URI that Arrow's file systems open).

Functions of this module travel to the workers by value.
"""
from __future__ import annotations

import sys
import time
from collections.abc import Iterator
from typing import Optional

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from wattline.operators.paths import BILLS_FOLDER, read_listing

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_SCHEMA = "file_path string, size long, modified_ns long"
_ARROW = pa.schema([("file_path", pa.string()), ("size", pa.int64()), ("modified_ns", pa.int64())])
#: Files of one record batch.
BATCH = 10_000


class Folder(InputPartition):
    """One mall's folder, and which of its files count by modification time (after, until]."""

    def __init__(self, path: str, after: Optional[int] = None, until: Optional[int] = None):
        super().__init__(path)
        self.path, self.after, self.until = path, after, until


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.LocalFileSystem(), path.rstrip("/")) if path.startswith("/") else pafs.FileSystem.from_uri(path.rstrip("/"))


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def bill_folders(path: str, bills_folder: str) -> list[str]:
    """The folders below ``path`` that hold bills: one for each mall that has a bill folder."""
    fs, root = _opened(path)
    found = [e for e in fs.get_file_info(pafs.FileSelector(root)) if e.type == pafs.FileType.Directory and not _hidden(e.base_name)]
    if bills_folder in root.split("/"):
        return sorted(e.path for e in found) + [""]  # and the files of the root itself
    inner = fs.get_file_info([f"{e.path}/{bills_folder}" for e in found])
    own = [e.path for e in found if e.base_name == bills_folder]
    return sorted(own + [e.path for e in inner if e.type == pafs.FileType.Directory])


def list_files(root: str, part: Folder) -> Iterator[pa.RecordBatch]:
    """The bill files of one folder, as record batches."""
    fs, base = _opened(root)
    rows: list[tuple[str, int, int]] = []
    todo = [part.path or base]
    while todo:
        for e in fs.get_file_info(pafs.FileSelector(todo.pop())):
            if _hidden(e.base_name):
                continue
            if e.type == pafs.FileType.Directory:
                todo += [e.path] if part.path else []
            elif e.base_name.lower().endswith(".pdf") and (part.after is None or e.mtime_ns > part.after) \
                    and (part.until is None or e.mtime_ns <= part.until):
                rows.append((e.path, e.size, e.mtime_ns))
        if len(rows) >= BATCH or not todo:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows) if rows else [[]] * 3, _ARROW)], schema=_ARROW)
            rows = []


class _Reader(DataSourceReader):
    def __init__(self, root: str, bills: str):
        self.root, self.bills = root, bills

    def partitions(self) -> list[Folder]:
        return [Folder(p) for p in bill_folders(self.root, self.bills)] or [Folder(f"{self.root.rstrip('/')}", until=-1)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        return list_files(self.root, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, root: str, bills: str, settle: float):
        self.root, self.bills, self.settle = root, bills, settle

    def initialOffset(self) -> dict:
        return {"until": -1}

    def latestOffset(self) -> dict:
        return {"until": time.time_ns() - int(self.settle * 1e9)}

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return [Folder(p, start["until"], end["until"]) for p in bill_folders(self.root, self.bills)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        return list_files(self.root, partition)


class BillFolders(DataSource):
    """Format ``bill_folders``: options ``path``, ``bills_folder`` and, for streams, ``settle`` (seconds that a file rests before it counts)."""

    @classmethod
    def name(cls) -> str:
        return "bill_folders"

    def schema(self) -> str:
        return FILE_SCHEMA

    def _where(self) -> tuple[str, str]:
        return self.options["path"], self.options.get("bills_folder", BILLS_FOLDER)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(*self._where())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(*self._where(), float(self.options.get("settle", "1")))


def folder_listing(spark: SparkSession, root: str, stream: bool = False, settle: float = 1.0, bills_folder: str = BILLS_FOLDER) -> DataFrame:
    """The listed bill files below ``root``, each mall by a task of its own; as a stream, as they arrive."""
    spark.dataSource.register(BillFolders)
    reader = (spark.readStream if stream else spark.read).format("bill_folders").option("path", root) \
        .option("bills_folder", bills_folder).option("settle", str(settle))
    return read_listing(reader.load(), _opened(root)[1], bills_folder)
