"""Landed archives and manifests."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice
from typing import IO

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from emberlake.functions.clean import file_stem
from emberlake.sources.files import listed, opened

LINES_PER_BATCH = 20_000
TASK_BYTES = 64 << 20  # unpacked bytes of the small members that share one task
LISTED_AT_ONCE = 16  # archives whose directories are read side by side
LINES = "archive string, member string, line_no long, line string"


def is_file(member: str) -> bool:
    return not member.endswith("/")


def zip_lines(files: DataFrame, keep: Callable[[str], bool] = is_file) -> DataFrame:
    """Lines of the members whose name passes ``keep``, from archives as ``path, content`` rows.

    Gives ``archive, member, line_no, line``. One archive is one task, as the format cannot be split; its
    members are read as streams, a batch of lines at a time.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as opened:
                    for member in filter(keep, opened.namelist()):
                        with opened.open(member) as raw:
                            yield from _batches(archive, member, raw)

    return files.select("path", "content").mapInPandas(
        members, "archive string, member string, line_no long, line string"
    )


@dataclass
class Members(InputPartition):
    """Members of archives that one task reads, one after another: (archive, member)."""

    members: tuple[tuple[str, str], ...]


class ZipLinesReader(DataSourceReader):
    def __init__(self, paths: Sequence[str], keep: Callable[[str], bool], task_bytes: int) -> None:
        self.paths, self.keep, self.task_bytes = paths, keep, task_bytes

    def members(self) -> list[tuple[int, str, str]]:
        """(unpacked bytes, archive, member), from the directories at the end of the archives alone."""

        def directory(archive: str) -> list[tuple[int, str, str]]:
            with opened(archive) as raw, zipfile.ZipFile(raw) as held:
                return [(m.file_size, archive, m.filename) for m in held.infolist() if is_file(m.filename)]

        archives = [found.path for found in listed(self.paths) if found.path.endswith(".zip")]
        with ThreadPoolExecutor(LISTED_AT_ONCE) as pool:
            found = [m for members in pool.map(directory, archives) for m in members]
        return [m for m in found if self.keep(m[2])]

    def partitions(self) -> list[Members]:
        """A large member is a task of its own, small ones share tasks, in order of size."""
        tasks: list[list[tuple[str, str]]] = []
        filled = self.task_bytes
        for size, archive, member in sorted(self.members(), reverse=True):
            if filled + size > self.task_bytes:
                tasks.append([])
                filled = 0
            tasks[-1].append((archive, member))
            filled += size
        return [Members(tuple(task)) for task in tasks] or [Members(())]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        for archive, member in partition.members:
            with opened(archive) as raw, zipfile.ZipFile(raw) as held, held.open(member) as stream:
                for batch in _batches(archive, member, stream):
                    yield pa.RecordBatch.from_pandas(batch, preserve_index=False)


class ZipLines(DataSource):
    """Spark data source ``zip_lines``: lines of the members of zip archives, ``archive, member, line_no, line``.

    A path is a file, a folder (searched with its subfolders) or a glob. A task reads one large member, or several
    small ones, as a stream from where the archive lies: neither an archive nor a member is ever whole in memory, and
    an archive's members are read side by side. A lost task reads its members again.
    """

    keep: Callable[[str], bool] = staticmethod(is_file)
    paths: Sequence[str] = ()

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> ZipLinesReader:
        paths = self.paths or [self.options["path"]]
        return ZipLinesReader(paths, type(self).keep, int(self.options.get("taskBytes", TASK_BYTES)))


def read_zip_lines(
    spark: SparkSession, path: str | Sequence[str], keep: Callable[[str], bool] = is_file, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Lines of the members whose name passes ``keep``, from landed archives."""
    # workers get the source itself, whether or not they have this package
    for module in (__name__, listed.__module__):
        cloudpickle.register_pickle_by_value(sys.modules[module])
    paths = [path] if isinstance(path, str) else list(path)
    spark.dataSource.register(type("ZipLines", (ZipLines,), {"keep": staticmethod(keep), "paths": tuple(paths)}))
    return spark.read.format("zip_lines").option("taskBytes", task_bytes).load()


def _batches(archive: str, member: str, raw: IO[bytes]) -> Iterator[pd.DataFrame]:
    text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace")
    start = 0
    while lines := [line.rstrip("\n") for line in islice(text, LINES_PER_BATCH)]:
        yield _frame(archive, member, start, lines)
        start += len(lines)


def _frame(archive: str, member: str, start: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {"archive": archive, "member": member, "line_no": range(start, start + len(lines)), "line": lines}
    )


def land_members(lines: DataFrame, path: str, name: Column) -> None:
    """Write the lines of each member as gzip text under a folder called by ``name``."""
    named = lines.select(name.alias("file"), "line_no", "line")
    named.sortWithinPartitions("file", "line_no").drop("line_no").write.mode("overwrite").partitionBy(
        "file"
    ).option("compression", "gzip").text(path)


class NotInManifest(LookupError):
    pass


def manifest_entries(manifest: DataFrame, date: Column) -> DataFrame:
    """Manifest rows last modified on a date: ``date, filename, link, mtime, last_modified``."""
    return manifest.where(F.substring("last_modified", 1, 10) == date).select(
        F.substring("last_modified", 1, 10).alias("date"),
        file_stem(F.col("name")).alias("filename"),
        F.col("downloadsLink").alias("link"),
        "mtime",
        "last_modified",
    )


def pick_from_manifest(manifest: DataFrame, date: str) -> dict:
    """The manifest row of a date that was modified first; raises where there is none."""
    row = manifest_entries(manifest, F.lit(date)).orderBy(F.col("mtime").cast("long"), "filename", "link").first()
    if row is None:
        raise NotInManifest(f"no file last modified on {date}")
    return row.asDict()
