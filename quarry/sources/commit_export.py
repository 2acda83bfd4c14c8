"""Commit exports as a Spark data source, batch and stream.

``spark.read.format("commit_export").option("repository", name).load(path)`` gives the rows of
``read_commits``; ``spark.readStream`` gives the same rows as files arrive. An export is a file or
a folder of JSON-lines files; a file is one partition.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from quarry.sources.commits import COMMIT, PERSON, STATS

FORMAT = "commit_export"
#: Files of one micro-batch.
FILES_PER_TRIGGER = 1000


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def export_files(path: str) -> list[tuple[int, str]]:
    """(time of change, path) of the files of an export, oldest first; names that begin with ``_`` or ``.`` are none."""
    from pyarrow import fs
    system, root = _file_system(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((f.mtime_ns or 0, f.path) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))


def _epoch(seconds):
    return None if seconds is None else dt.datetime.fromtimestamp(seconds, dt.timezone.utc)


def _members(value, kind: StructType):
    return None if value is None else tuple(value.get(f.name) for f in kind.fields)


def commit_row(raw: dict, repository: str) -> tuple:
    """One exported commit as a row of ``COMMIT``."""
    stats = raw.get("stats") or {}
    parents = raw.get("parents")
    files = stats.get("files")
    return (raw.get("hexsha"), repository, _epoch(raw.get("committed_date")), _members(raw.get("committer") or {}, PERSON),
            _epoch(raw.get("authored_date")), _members(raw.get("author") or {}, PERSON), raw.get("message"),
            None if parents is None else [p.get("hexsha") for p in parents],
            None if files is None else list(files), _members(stats.get("total"), STATS))


class _File(InputPartition):
    def __init__(self, root: str, path: str, repository: str):
        self.root, self.path, self.repository = root, path, repository


def _rows(part: _File):
    system, _ = _file_system(part.root)
    with system.open_input_stream(part.path) as f:
        rest = b""
        while chunk := f.read(1 << 20):
            *lines, rest = (rest + chunk).split(b"\n")
            yield from (commit_row(json.loads(x), part.repository) for x in lines if x.strip())
        if rest.strip():
            yield commit_row(json.loads(rest), part.repository)


class _Reader(DataSourceReader):
    def __init__(self, path: str, repository: str):
        self.path, self.repository = path, repository

    def partitions(self):
        return [_File(self.path, p, self.repository) for _, p in export_files(self.path)] or [_File(self.path, "", self.repository)]

    def read(self, partition: _File):
        return _rows(partition) if partition.path else iter(())


class _StreamReader(DataSourceStreamReader):
    """The offset is the time of change and the name of the last file taken."""

    def __init__(self, path: str, repository: str, files: int):
        self.path, self.repository, self.files = path, repository, files
        self.taken = (0, "")

    def initialOffset(self) -> dict:
        return {"time": 0, "file": ""}

    def _after(self, offset) -> list[tuple[int, str]]:
        return [x for x in export_files(self.path) if x > offset]

    def latestOffset(self) -> dict:
        waiting = self._after(self.taken)[: self.files]
        self.taken = waiting[-1] if waiting else self.taken
        return {"time": self.taken[0], "file": self.taken[1]}

    def partitions(self, start: dict, end: dict):
        low, high = (start["time"], start["file"]), (end["time"], end["file"])
        self.taken = max(self.taken, high)
        return [_File(self.path, p, self.repository) for t, p in self._after(low) if (t, p) <= high]

    def read(self, partition: _File):
        return _rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing to do: files stay where they are."""


class CommitExport(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return COMMIT

    def _options(self) -> tuple[str, str]:
        return self.options["path"], self.options.get("repository", "")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(*self._options())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(*self._options(), int(self.options.get("filesPerTrigger", FILES_PER_TRIGGER)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(CommitExport)
