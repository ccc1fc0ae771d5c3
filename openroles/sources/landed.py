"""Landed pages and details as a Spark data source, ``landed``.

Files lie in ``<path>/platform=<name>/`` as JSON lines, one landed document a
line. A task reads one range of at most ``splitBytes`` of one file; a range owns
the lines that start in it. The option ``platforms`` (names, comma-separated)
chooses folders, so files of others are not opened. Filters are not pushed: when
they were, frames that filter one relation by different platforms lost rows,
probably because its scans share one reader (not traced).

Defined cases: a line that is no JSON object, no UTF-8 or has a time that does
not parse, and a file that cannot be opened, are rows with ``error`` set and no
payload; all other lines are read. Absent fields are null, other fields are left
out, blank lines are skipped. A folder without files gives no rows, and one that
does not exist is an error. Names that start with ``_`` or ``.`` are no data.
"""

from __future__ import annotations

import io
import json
from datetime import datetime, timezone
from functools import reduce
from typing import Any, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from openroles import schemas
from openroles.sources import feeds

KINDS = {"pages": schemas.PAYLOADS, "details": schemas.DETAILS}
ARROW = {"string": pa.string(), "bigint": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}
SPLIT_BYTES = 64 << 20
BATCH_ROWS, BATCH_CHARS = 1000, 4 << 20


def file_system(uri: str):
    """The file system of a URI and the path within it."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


class LandedReader(DataSourceReader):
    def __init__(self, path: str, fields: list[tuple[str, str]], split_bytes: int, platforms: set[str] | None):
        self.path, self.fields, self.split_bytes, self.platforms = path, fields, split_bytes, platforms

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = file_system(self.path)
        ranges = []
        for folder in system.get_file_info(fs.FileSelector(root)):
            name, _, platform = folder.base_name.partition("=")
            platform = unquote(platform)
            if name != "platform" or (self.platforms is not None and platform not in self.platforms):
                continue
            for file in system.get_file_info(fs.FileSelector(folder.path, recursive=True)):
                if file.type == fs.FileType.File and file.size and file.base_name[0] not in "_.":
                    ranges += [InputPartition((platform, file.path, at, self.split_bytes))
                               for at in range(0, file.size, self.split_bytes)]
        return ranges or [InputPartition(None)]

    def lines(self, path: str, start: int, size: int) -> Iterator[tuple[int, bytes]]:
        """Lines of a file that start in a range, with their places."""
        system, _ = file_system(self.path)
        with io.BufferedReader(system.open_input_file(path), 1 << 20) as file:
            at = start
            if start:
                # The line before may end right where the range starts.
                file.seek(start - 1)
                at += len(file.readline()) - 1
            while at < start + size and (line := file.readline()):
                yield at, line
                at += len(line)

    def row(self, platform: str, line: bytes) -> list[Any]:
        found = json.loads(line)
        if not isinstance(found, dict):
            raise ValueError("no object")
        values: list[Any] = []
        for name, kind in self.fields:
            value = platform if name == "platform" else found.get(name)
            if value is not None and kind == "timestamp":
                value = datetime.fromisoformat(value)
                value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
            elif value is not None and kind == "bigint":
                value = int(value)
            elif value is not None and not isinstance(value, str):
                value = json.dumps(value)
            values.append(value)
        return values

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        platform, path, start, size = partition.value
        names = [n for n, _ in self.fields]
        types = [ARROW[t] for _, t in self.fields] + [pa.string()] * 2

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=[*names, "file", "error"])

        def failed(error: str) -> list[Any]:
            return [platform if n == "platform" else None for n in names] + [path, error]

        rows, chars = [], 0
        try:
            for at, line in self.lines(path, start, size):
                if not line.strip():
                    continue
                try:
                    rows.append([*self.row(platform, line), path, None])
                except (ValueError, TypeError) as exc:
                    rows.append(failed(f"line at byte {at}: {exc}"))
                chars += len(line)
                if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield batch(rows)
                    rows, chars = [], 0
        except OSError as exc:
            rows.append(failed(f"cannot be read: {exc}"))
        if rows:
            yield batch(rows)


class Landed(DataSource):
    """``spark.read.format("landed").option("kind", "pages" | "details").load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def _fields(self) -> list[tuple[str, str]]:
        return [tuple(f.split()) for f in KINDS[self.options.get("kind", "pages")].split(", ")]

    def schema(self) -> str:
        return KINDS[self.options.get("kind", "pages")] + ", file string, error string"

    def reader(self, schema) -> LandedReader:
        named = self.options.get("platforms")
        return LandedReader(self.options["path"], self._fields(), int(self.options.get("splitBytes", SPLIT_BYTES)),
                            None if named is None else set(named.split(",")))


def register(spark: SparkSession) -> None:
    """Makes the source known to the session."""
    spark.dataSource.register(Landed)


def read_files(spark: SparkSession, path: str, kind: str = "pages", platforms: Sequence[str] | None = None) -> DataFrame:
    register(spark)
    reader = spark.read.format("landed").option("kind", kind)
    return (reader if platforms is None else reader.option("platforms", ",".join(platforms))).load(path)


def documents(rows: DataFrame) -> DataFrame:
    """Rows that were read, in the schema of landed pages or details."""
    return rows.filter("error is null").drop("file", "error")


def file_errors(rows: DataFrame) -> DataFrame:
    """Lines and files that could not be read, by platform and file."""
    return rows.filter("error is not null").select("platform", "file", "error")


def all_feeds(spark: SparkSession, pages: str, details: str, asof: Column) -> DataFrame:
    """Postings of all platforms from landed files; each platform's feed reads its own files once."""
    def of(path: str, kind: str, platform: str) -> DataFrame:
        return documents(read_files(spark, path, kind, [platform]))

    plain = [f(of(pages, "pages", f.__name__)) for f in (feeds.greenhouse, feeds.lever, feeds.ashby)]
    frames = [*plain, feeds.smartrecruiters(*(of(p, k, "smartrecruiters") for p, k in ((pages, "pages"), (details, "details")))),
              feeds.workday(*(of(p, k, "workday") for p, k in ((pages, "pages"), (details, "details"))), asof)]
    return reduce(DataFrame.unionByName, [f.select(*feeds.POSTING_COLUMNS) for f in frames])
