"""A data source for zipped CSV files: one partition for each member, read where the task runs.

Planning lists the archives of a folder, reads their directories and the members' first lines, and resolves each member's headers to our
columns; a member without a needed header stops it there. A task opens its archive in place, in any file system that pyarrow
knows, and streams its member: bytes that are no UTF-8 are replaced, lines may break inside quotes, and what a member lacks is ''.
Nothing is unpacked, and there is one plan whatever the number of members.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "zipped_csv"
ROWS = 8192


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """A file system and the path inside of it; a bare path is a local one."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(folder: str, pattern: str) -> list[str]:
    """Archives of a folder by name, as paths of the folder's kind."""
    system, inside = opened(folder)
    found = system.get_file_info(fs.FileSelector(inside, allow_not_found=False))
    names = sorted(x.base_name for x in found if x.type == fs.FileType.File and fnmatch.fnmatchcase(x.base_name, pattern))
    return [f"{folder.rstrip('/')}/{n}" for n in names]


def _lines(member) -> Iterator[list[str]]:
    csv.field_size_limit(1 << 30)
    return csv.reader(io.TextIOWrapper(member, encoding="utf-8-sig", errors="replace", newline=""))


@dataclass
class Member(InputPartition):
    """A member, and for each of our columns the place of its header, or -1."""

    path: str
    name: str
    places: tuple[int, ...]


def members(path: str, columns: tuple[str, ...], headers: dict[str, tuple[str, ...]], needed: frozenset[str]) -> list[Member]:
    out = []
    system, inside = opened(path)
    with system.open_input_file(inside) as file, zipfile.ZipFile(file) as archive:
        for name in (n for n in archive.namelist() if n.endswith(".csv")):
            with archive.open(name) as member:
                first = next(_lines(member), [])
            try:
                found = resolved(first, headers, needed)
            except ValueError as e:
                raise ValueError(f"{path}, {name}: {e}") from None
            out.append(Member(path, name, tuple(first.index(found[c]) if c in found else -1 for c in columns)))
    return out


def resolved(first: list[str], headers: dict[str, tuple[str, ...]], needed: frozenset[str]) -> dict[str, str]:
    """Our columns and the header each comes from, the first of its names that is there; ValueError if a needed one has none."""
    there = set(first)
    found = {ours: hit for ours, names in headers.items() for hit in [next(filter(there.__contains__, names), None)] if hit}
    if lacking := sorted(needed - set(found)):
        raise ValueError(f"no header for {', '.join(lacking)}")
    return found


class _Reader(DataSourceReader):
    def __init__(self, folder: str, pattern: str, columns: tuple[str, ...], headers: dict[str, tuple[str, ...]], needed: frozenset[str]):
        self.folder, self.pattern, self.columns, self.headers, self.needed = folder, pattern, columns, headers, needed

    def partitions(self) -> list[Member]:
        archives = listed(self.folder, self.pattern)
        with ThreadPoolExecutor(16) as pool:
            found = [m for part in pool.map(lambda a: members(a, self.columns, self.headers, self.needed), archives) for m in part]
        if not found:
            raise ValueError(f"no archive members in {self.folder}")
        return found

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        names = [*self.columns, "source_file"]
        system, inside = opened(partition.path)
        origin = inside.rsplit("/", 1)[-1]

        def batch(rows: list[list[str]]) -> pa.RecordBatch:
            made = [pa.array([r[k] if 0 <= k < len(r) else "" for r in rows], pa.string()) for k in partition.places]
            return pa.RecordBatch.from_arrays([*made, pa.array([origin] * len(rows), pa.string())], names=names)

        with system.open_input_file(inside) as file, zipfile.ZipFile(file) as archive, archive.open(partition.name) as member:
            lines = _lines(member)
            next(lines, None)
            rows: list[list[str]] = []
            for line in lines:
                if line:
                    rows.append(line)
                if len(rows) == ROWS:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


class ZippedCsv(DataSource):
    """Options: path, pattern, columns as `ours=name|name;…`, needed as names with commas."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _columns(self) -> dict[str, tuple[str, ...]]:
        return {ours: tuple(names.split("|")) for ours, names in (x.split("=", 1) for x in self.options["columns"].split(";"))}

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in (*self._columns(), "source_file"))

    def reader(self, schema) -> DataSourceReader:
        columns = self._columns()
        needed = frozenset(x for x in self.options.get("needed", "").split(",") if x)
        return _Reader(self.options["path"], self.options.get("pattern", "*.zip"), tuple(columns), columns, needed)


def read(spark: SparkSession, folder: str, headers: dict[str, tuple[str, ...]], needed: frozenset[str] = frozenset(), pattern: str = "*.zip") -> DataFrame:
    """All members of all archives of a folder: our columns as text, and source_file, the archive's name."""
    spark.dataSource.register(ZippedCsv)
    columns = ";".join(f"{ours}={'|'.join(names)}" for ours, names in headers.items())
    return spark.read.format(NAME).options(pattern=pattern, columns=columns, needed=",".join(sorted(needed))).load(folder)


def pack(rows: DataFrame, folder: str, headers: dict[str, str], stem: str) -> None:
    """Each partition of rows as an archive of one CSV member, under the given headers; an archive is there whole or not at all."""
    columns = list(headers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        system, inside = opened(folder)
        system.create_dir(inside, recursive=True)
        name = f"{stem}_{number:05d}"
        beside, n = f"{inside}/.{name}-{TaskContext.get().taskAttemptId()}", 0
        with system.open_output_stream(beside) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive, archive.open(f"{name}.csv", "w", force_zip64=True) as member:
            text = io.TextIOWrapper(member, encoding="utf-8", newline="", write_through=True)
            out = csv.writer(text)
            out.writerow(headers.values())
            for batch in batches:
                out.writerows(zip(*(["" if x is None else x for x in c.to_pylist()] for c in batch.columns), strict=True))
                n += batch.num_rows
            text.flush()
            text.detach()
        system.move(beside, f"{inside}/{name}.zip")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows.select(*[rows[c].cast("string").alias(c) for c in columns]).mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
