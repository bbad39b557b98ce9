"""Text of fixed-width records as a data source with splits and pushed filters.

A file begins with lines of prose, of which the last one with the marker stands before the records; each record is a year and
twelve fields of one width. Records have one length, so a file is cut into splits of whole records wherever a split's
size ends, and each split is a task. A filter on the year is pushed to the source. With sorted=true (the years of a file
rise) the splits that can hold such years are found by bisection, a record's year at a time, so the rest of a file
is not read; without it all splits are read and rows are filtered as they come.

Files are found and read through pyarrow's file systems, so paths may be of any store it knows. Defined results: fields that
are no numbers, and marks of missing observations, give no rows; records whose year is no number give none; an empty file and
a file without a marker give none; a last record without an end of line counts; lines that are shorter or longer than
the first record end a file's splitting: it is then read as a whole, line by line, if that shows where the file is looked
at, and is an error where a split comes upon it.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from .files import MISSING

NAME, SCHEMA = "agrolith_records", "year int, month int, value double"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Bytes of a file within which the marker stands, of a split, and of what a task holds at once.
HEAD, SPLIT, BLOCK = 1 << 16, 64 << 20, 4 << 20
#: Characters of the year, and fields of a record.
YEAR, MONTHS = 4, 12
TESTS = {GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, EqualTo: operator.eq}


class Split(InputPartition):
    """Bytes of a file; length 0: lines of any length from low to the file's end."""

    def __init__(self, path: str, low: int, high: int, length: int) -> None:
        self.path, self.low, self.high, self.length = path, low, high, length


def opened(path: str) -> pa.NativeFile:
    system, own = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return system.open_input_file(own)


def listed(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files of a folder but hidden ones."""
    uri = "://" in path or path.startswith("file:")
    system, own = pafs.FileSystem.from_uri(path) if uri else (pafs.LocalFileSystem(), path)
    info = system.get_file_info(own)
    found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(own, recursive=True))
    prefix = path[: len(path) - len(own)] if uri and path.endswith(own) else "file://" if uri else ""
    return sorted((prefix + f.path, f.size) for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))


def year_of(record: bytes) -> int | None:
    text = record[:YEAR].strip()
    return int(text) if text.isdigit() else None


def fields_of(record: bytes, width: int) -> Iterator[tuple]:
    year = year_of(record)
    if year is None:
        return
    for month in range(MONTHS):
        try:
            value = float(record[YEAR + month * width : YEAR + (month + 1) * width])
        except ValueError:
            continue
        if value not in MISSING and value == value:
            yield year, month + 1, value


class RecordReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.marker = options["path"], options.get("marker", "STANDARDIZED").upper().encode()
        self.width, self.split = int(options.get("width", 6)), int(options.get("split", SPLIT))
        self.sorted = options.get("sorted", "false").lower() == "true"
        self.low, self.high, self.wanted = -(1 << 31), 1 << 31, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  Spark's name
        """Takes comparisons of the year with numbers; the others are Spark's. Years read are held to those taken."""
        for one in filters:
            if getattr(one, "attribute", None) != ("year",) or not isinstance(one, (*TESTS, In)):
                yield one
            elif isinstance(one, In):
                years = {v for v in one.value if v is not None}
                self.wanted = years if self.wanted is None else self.wanted & years
            else:
                self.low = max(self.low, one.value + isinstance(one, GreaterThan)) if isinstance(one, (GreaterThan, GreaterThanOrEqual, EqualTo)) else self.low
                self.high = min(self.high, one.value - isinstance(one, LessThan)) if isinstance(one, (LessThan, LessThanOrEqual, EqualTo)) else self.high

    def bounds(self) -> tuple[int, int]:
        if not self.wanted:
            return (self.low, self.high) if self.wanted is None else (1, 0)
        return max(self.low, min(self.wanted)), min(self.high, max(self.wanted))

    def keeps(self, year: int | None) -> bool:
        return year is not None and self.low <= year <= self.high and (self.wanted is None or year in self.wanted)

    def partitions(self) -> Sequence[InputPartition]:
        low, high = self.bounds()
        return [split for path, size in listed(self.path) if low <= high for split in self.splits_of(path, size, low, high)]

    def splits_of(self, path: str, size: int, low: int, high: int) -> list[Split]:
        with opened(path) as file:
            head = file.read(min(size, HEAD))
            marks = [at for at, line in lines_of(head) if self.marker in line.upper()]
            start = head.find(b"\n", marks[-1]) + 1 if marks else 0
            if not start or start >= size:
                return []
            length = (head.find(b"\n", start) + 1 or size) - start
            n = -(-(size - start) // length)
            ends = [start + k * length - 1 for k in sorted({1, n // 2, n - 1}) if 0 < k < n]  # where lines should end
            even = (size - start) % length in (0, length - 1) and all(self.byte_at(file, at) == b"\n" for at in ends)
            if not even:
                return [Split(path, start, size, 0)]
            first, last = 0, n
            if self.sorted:
                first = self.bisected(file, start, length, n, lambda year: year >= low)
                last = self.bisected(file, start, length, n, lambda year: year > high)
            each = max(self.split // length, 1)
            return [Split(path, start + k * length, min(start + min(k + each, last) * length, size), length) for k in range(first, last, each)]

    def byte_at(self, file: pa.NativeFile, at: int) -> bytes:
        file.seek(at)
        return file.read(1)

    def bisected(self, file: pa.NativeFile, start: int, length: int, n: int, far) -> int:
        """The number of the first record that lies far enough; years rise."""
        low, high = 0, n
        while low < high:
            middle = (low + high) // 2
            file.seek(start + middle * length)
            year = year_of(file.read(YEAR))
            if year is None:
                raise ValueError("a sorted file has a record without a year")
            low, high = (low, middle) if far(year) else (middle + 1, high)
        return low

    def read(self, partition: Split | None) -> Iterator[tuple]:
        if partition is None:  # no split holds a wanted year
            return
        with opened(partition.path) as file:
            file.seek(partition.low)
            left, rest = partition.high - partition.low, b""
            block = max(BLOCK // partition.length, 1) * partition.length if partition.length else BLOCK
            while left > 0:
                data = file.read(min(block, left))
                if not data:
                    break
                left -= len(data)
                *lines, rest = (rest + data).split(b"\n")
                for line in lines:
                    if partition.length and len(line) != partition.length - 1:
                        raise ValueError(f"{partition.path} has records of different lengths")
                    yield from self.rows(line)
            yield from self.rows(rest)

    def rows(self, line: bytes) -> Iterator[tuple]:
        if self.keeps(year_of(line)):
            yield from fields_of(line.rstrip(b"\r"), self.width)


def lines_of(head: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    for line in head.split(b"\n"):
        yield at, line
        at += len(line) + 1


class Records(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options)


def read_records(spark: SparkSession, path: str, **options):
    """year, month, value of fixed-width text; filters on year reach the source."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(Records)
    return spark.read.format(NAME).options(**options).load(path)
