"""Separated text as a stream by byte offsets: what a file gains is read from where the last run ended, inside the file."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Bytes of one task, bytes read at once.
PIECE, READ = 1 << 26, 1 << 20
MALFORMED, FILE, OFFSET = "_malformed", "_file", "_offset"


def _open(uri: str):
    """The file system of a path (file:, hdfs:, s3: and what else pyarrow knows) and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _files(folder: str) -> dict[str, int]:
    from pyarrow import fs

    system, root = _open(folder)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return {i.path: i.size for i in found if i.is_file and not i.base_name.startswith(("_", "."))}


def _lines(system, path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin in [start, end), by pieces of the file."""
    with system.open_input_file(path) as file:
        size = file.size()
        # a line that began before ``start`` belongs to the piece before
        at = start if start == 0 else start - 1
        file.seek(at)
        rest, begin, skip = b"", at, start > 0
        while True:
            chunk = file.read(READ)
            rest += chunk
            *whole, rest = rest.split(b"\n")
            for line in whole:
                if not skip:
                    if begin >= end:
                        return
                    yield begin, line
                skip = False
                begin += len(line) + 1
            if not chunk or begin >= size:
                break
            if begin >= end and not skip:
                return
        if rest and not skip and begin < end:
            yield begin, rest


def _complete(system, path: str, start: int, size: int) -> int:
    """The offset behind the last line end of ``path`` after ``start``; ``start`` without one."""
    with system.open_input_file(path) as file:
        end = size
        while end > start:
            begin = max(start, end - READ)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return start


@dataclass
class Piece(InputPartition):
    path: str
    start: int
    end: int


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.folder = options["path"]
        self.sep, self.quote = options.get("sep", "|"), options.get("quote", '"')
        self.piece = int(options.get("piecebytes", PIECE))
        self.names = [f.name for f in schema.fields if f.name not in (MALFORMED, FILE, OFFSET)]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Bytes of complete lines of every file; a last line without an end waits for it."""
        system, _ = _open(self.folder)
        return {path: _complete(system, path, 0, size) for path, size in sorted(_files(self.folder).items())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for path, last in end.items():
            first = start.get(path, 0)
            out += [Piece(path, a, min(a + self.piece, last)) for a in range(first, last, self.piece)]
        return out or [Piece("", 0, 0)]

    def read(self, partition: Piece) -> Iterator[tuple]:
        if not partition.path:
            return
        system, _ = _open(self.folder)
        for offset, raw in _lines(system, partition.path, partition.start, partition.end):
            if offset == 0:
                continue  # the header
            line = raw.rstrip(b"\r").decode("utf-8", "replace")
            if not line:
                continue
            fields = next(csv.reader([line], delimiter=self.sep, quotechar=self.quote))
            good = len(fields) == len(self.names)
            yield (*(fields if good else [None] * len(self.names)), None if good else line, partition.path, offset)

    def commit(self, end: dict) -> None:
        pass


class SeparatedLines(DataSource):
    """``spark.readStream.format("separated_lines").load(folder)``: text with a header line and one record a line.

    Options: ``sep`` (|), ``quote`` ("), ``pieceBytes`` (bytes of one task). Columns are strings named by the header of the first
    file, then ``_malformed`` (the line of a record with another number of fields), ``_file`` and ``_offset`` (the byte at which the line
    begins). The offset of the stream is a number of bytes for each file, kept in the query's checkpoint: after a stop
    the next run begins inside each file where the last one ended, and new files are read from their start. A line without an
    end waits until it has one. The number of files, not of rows, bounds what the driver holds.
    """

    @classmethod
    def name(cls) -> str:
        return "separated_lines"

    def schema(self) -> StructType:
        system, _ = _open(self.options["path"])
        for path, size in sorted(_files(self.options["path"]).items()):
            if size:
                _, line = next(_lines(system, path, 0, 1))
                header = line.decode("utf-8-sig", "replace").rstrip("\r")
                names = next(csv.reader([header], delimiter=self.options.get("sep", "|"), quotechar=self.options.get("quote", '"')))
                fields = [StructField(n.strip(), StringType()) for n in names] + [StructField(n, StringType()) for n in (MALFORMED, FILE)]
                return StructType([*fields, StructField(OFFSET, LongType())])
        raise FileNotFoundError(f"no file with a header in {self.options['path']}")

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(schema, self.options)


def read_lines_stream(spark: SparkSession, folder: str, **options: str):
    """A streaming DataFrame of ``SeparatedLines``."""
    spark.dataSource.register(SeparatedLines)
    return spark.readStream.format("separated_lines").options(**options).load(folder)


def offsets_of(progress: dict) -> dict:
    """The bytes of each file that a finished query has read."""
    ends = [json.loads(s["endOffset"]) if isinstance(s["endOffset"], str) else s["endOffset"] for s in progress["sources"]]
    return ends[0] if ends else {}
