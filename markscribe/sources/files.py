"""Data sources of the batch: a folder of sheets to rows, and rows to JSON files that appear together.

``markscribe_sheets`` reads the .txt files of one folder (any case of the suffix; hidden files are
skipped, files that begin with an underscore and empty ones are not), strictly as UTF-8. A file that
cannot be read is a row with an error and does not stop the others. ``markscribe_json`` writes rows of
(name, text) as indented JSON; tasks write beside the folder's files and the commit moves them, so a
job that fails leaves the folder as it was.

Folders are paths that driver and executors mount, or URIs that Arrow's file systems open.
"""

from __future__ import annotations

import contextlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

SHEETS = "student_id string, raw_text string, path string, error string"
#: Bytes and files of a partition, at most (one file at least).
PART_BYTES, PART_FILES = 32 << 20, 10_000
BATCH_BYTES = 8 << 20


def open_folder(path: str) -> tuple[FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return FileSystem.from_uri(path)
    return LocalFileSystem(), os.path.abspath(path)


def is_sheet(name: str) -> bool:
    return not name.startswith(".") and PurePosixPath(name).suffix.lower() == ".txt"


@dataclass
class Files(InputPartition):
    paths: list[str]


def parted(files: list[tuple[str, int]], most_bytes: int, most_files: int) -> list[Files]:
    """Runs of files in order of their paths."""
    out, room = [], 0
    for path, size in files:
        if not out or size > room or len(out[-1].paths) >= most_files:
            out.append(Files([]))
            room = most_bytes
        out[-1].paths.append(path)
        room -= size
    return out


class SheetReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.most = int(options.get("partitionBytes", PART_BYTES)), int(options.get("partitionFiles", PART_FILES))

    def partitions(self) -> list[Files]:
        files, top = open_folder(self.folder)
        found = [f for f in files.get_file_info(FileSelector(top)) if f.type == FileType.File and is_sheet(f.base_name)]
        return parted(sorted((f.path, f.size) for f in found), *self.most)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty folder
            return
        files, _ = open_folder(self.folder)
        rows, size = [], 0
        for path in partition.paths:
            text, error = None, None
            try:
                with files.open_input_stream(path) as f:
                    text = f.read().decode("utf-8").replace("\r\n", "\n").replace("\r", "\n")
            except (OSError, UnicodeDecodeError) as e:
                error = f"{type(e).__name__}: {e}"
            rows.append((PurePosixPath(path).stem, text, path, error))
            size += len(text or "")
            if size >= BATCH_BYTES:
                yield self.batch(rows)
                rows, size = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in SHEETS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names)


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "markscribe_sheets"

    def schema(self) -> str:
        return SHEETS

    def reader(self, schema: StructType) -> SheetReader:
        return SheetReader(self.options)


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int


class JsonWriter(DataSourceWriter):
    """Each attempt of a task writes to a folder of its own; only those of attempts that Spark commits are moved."""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.stage = f".markscribe-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Staged:
        files, top = open_folder(self.folder)
        own, n = f"{top}/{self.stage}/{uuid.uuid4().hex}", 0
        made = set()
        for name, text in rows:
            path = f"{own}/{name}"
            if (parent := path.rsplit("/", 1)[0]) not in made:
                files.create_dir(parent, recursive=True)
                made.add(parent)
            with files.open_output_stream(path) as out:
                out.write((json.dumps(json.loads(text), ensure_ascii=False, indent=4) + "\n").encode("utf-8"))
            n += 1
        return Staged(own, n)

    def commit(self, messages: list[Staged | None]) -> None:
        files, top = open_folder(self.folder)
        made = {top}
        for m in (m for m in messages if m and m.files):
            for f in files.get_file_info(FileSelector(m.folder, recursive=True)):
                if f.type == FileType.File:
                    to = f"{top}/{f.path[len(m.folder) + 1 :]}"
                    if (parent := to.rsplit("/", 1)[0]) not in made:
                        files.create_dir(parent, recursive=True)
                        made.add(parent)
                    files.move(f.path, to)
        self.clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self.clear()

    def clear(self) -> None:
        files, top = open_folder(self.folder)
        with contextlib.suppress(FileNotFoundError):
            files.delete_dir(f"{top}/{self.stage}")


class JsonSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "markscribe_json"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema: StructType, overwrite: bool) -> JsonWriter:
        return JsonWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make both sources known to a session."""
    spark.dataSource.register(SheetSource)
    spark.dataSource.register(JsonSink)
