"""A data source for record folders: <path>/<video_id>/<artifact>, one text file an artifact, whose name may have folders in it.

    spark.dataSource.register(folders.RecordFolders)
    spark.read.format("record_folders").load(path)
    rows.write.format("record_folders").mode("append").save(path)

Rows are (video_id, artifact, content). Writing has two phases: tasks write below
<path>/_staging/<job>; when all have ended well, each file is moved to its place if
none is there, and never else. A file that is there with other content stays, and
the new one is told in <path>/_mismatches/<job>.json. If a task fails for good, the
staged files are removed and nothing else has changed."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from uuid import uuid4

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "video_id string, artifact string, content string"
#: Folders of a partition.
PER_PARTITION = 200
#: Files that are moved at a time.
MOVES = 32
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._=-]*(?:/[A-Za-z0-9][A-Za-z0-9._=-]*)*")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        where, at = fs.FileSystem.from_uri(path)
        return where, at.rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")


def _listed(where: fs.FileSystem, at: str, deep: bool = False) -> list[fs.FileInfo]:
    found = where.get_file_info(fs.FileSelector(at, allow_not_found=True, recursive=deep))
    return sorted((f for f in found if not f.base_name.startswith(("_", "."))), key=lambda f: f.path)


@dataclass
class Folders(InputPartition):
    names: list[str]

    def __init__(self, names: list[str]):
        super().__init__(None)
        self.names = names


class Reader(DataSourceReader):
    def __init__(self, path: str, artifacts: set[str] | None, per_partition: int):
        self.path, self.artifacts, self.per_partition = path, artifacts, per_partition

    def partitions(self) -> list[InputPartition]:
        where, at = _open(self.path)
        names = [f.base_name for f in _listed(where, at) if f.type == fs.FileType.Directory]
        return [Folders(names[k : k + self.per_partition]) for k in range(0, len(names), self.per_partition)] or [Folders([])]

    def read(self, partition: Folders) -> Iterator[tuple]:
        where, at = _open(self.path)
        for name in partition.names:
            for f in _listed(where, f"{at}/{name}", True):
                if f.type == fs.FileType.File and (self.artifacts is None or f.base_name in self.artifacts):
                    with where.open_input_stream(f.path) as stream:
                        yield name, f.path[len(f"{at}/{name}/") :], stream.read().decode("utf-8", "replace")


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[str, str]]


class Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.job = path, uuid4().hex

    def write(self, rows: Iterator) -> Staged:
        where, at = _open(self.path)
        task, files = uuid4().hex, []  # an attempt that fails leaves files that no message names
        for row in rows:
            video, artifact, content = row
            if content is None:
                continue
            if "/" in (video or "/") or not (_NAME.fullmatch(video) and _NAME.fullmatch(artifact or "")):
                raise ValueError(f"no name of a record: {video}/{artifact}")
            staged = f"{at}/_staging/{self.job}/{task}/{len(files)}"
            where.create_dir(staged.rpartition("/")[0], recursive=True)
            with where.open_output_stream(staged) as stream:
                stream.write(content.encode())
            files.append((staged, f"{at}/{video}/{artifact}"))
        return Staged(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        where, at = _open(self.path)
        files = sorted((target, staged) for m in messages if m for staged, target in m.files)
        groups: dict[str, list[str]] = {}
        for target, staged in files:
            groups.setdefault(target, []).append(staged)

        def bytes_of(path: str) -> bytes:
            with where.open_input_stream(path) as stream:
                return stream.read()

        def promote(item: tuple[str, list[str]]) -> str | None:
            target, staged = item
            bodies = sorted((bytes_of(s), s) for s in staged)
            if where.get_file_info(target).type == fs.FileType.NotFound:
                where.create_dir(target.rpartition("/")[0], recursive=True)
                where.move(bodies[0][1], target)
                kept, others = bodies[0][0], bodies[1:]
            else:
                kept, others = bytes_of(target), bodies
            return target.removeprefix(f"{at}/") if any(b != kept for b, _ in others) else None

        with ThreadPoolExecutor(MOVES) as pool:
            wrong = [x for x in pool.map(promote, groups.items()) if x]
        if wrong:
            where.create_dir(f"{at}/_mismatches", recursive=True)
            with where.open_output_stream(f"{at}/_mismatches/{self.job}.json") as stream:
                stream.write(json.dumps({"category": "artifact_mismatch", "artifacts": wrong}, indent=2).encode())
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        where, at = _open(self.path)
        if where.get_file_info(f"{at}/_staging/{self.job}").type == fs.FileType.Directory:
            where.delete_dir(f"{at}/_staging/{self.job}")


class RecordFolders(DataSource):
    """Options: path; artifacts (file names joined by commas: read only these), per_partition (folders)."""

    @classmethod
    def name(cls) -> str:
        return "record_folders"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        wanted = self.options.get("artifacts")
        return Reader(self.options["path"], set(wanted.split(",")) if wanted else None, int(self.options.get("per_partition", PER_PARTITION)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("records are never overwritten: use mode('append')")
        if [f.name for f in schema.fields] != [c.split()[0] for c in SCHEMA.split(", ")]:
            raise ValueError(f"rows must be {SCHEMA}")
        return Writer(self.options["path"])
