"""A partitioned source and sink of documents: folders of JSON lines with commits.

It stands where a document store's connector would: Spark reads and writes it by a format
name and options, through its interface for data sources in Python. A load is a set of
files that come into view together: tasks write theirs apart, and only the commit names
them. Files that no commit names are not read, so a failed or repeated task leaves nothing behind.
Files are read by byte ranges, each from its first whole line on; where there are many, a task
takes several. Documents become JSON, and JSON columns, a batch at a time.

    spark.dataSource.register(DocumentDump)
    df.write.format("document_dump").mode("append").save(path)
    spark.read.format("document_dump").schema("a long").load(path)
"""

from __future__ import annotations

import datetime
import decimal
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "document_dump"
COMMITS, DATA = "commits", "data"
# Options: bytes of a range, and documents of a batch.
RANGE_BYTES, BATCH_ROWS = 64 << 20, 10_000
# With more ranges than this a task takes several, up to RANGE_BYTES in all.
TASKS = 1_000


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _committed(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of all commits, none if there is no folder."""
    system, folder = _at(path)
    found = []
    listed = system.get_file_info(fs.FileSelector(f"{folder}/{COMMITS}", allow_not_found=True))
    for info in sorted(listed, key=lambda i: i.path):
        if info.path.endswith(".json"):
            with system.open_input_stream(info.path) as stream:
                commit = json.loads(stream.read())
            found += [(f"{folder}/{DATA}/{name}", size) for name, size, _ in commit["files"]]
    return found


@dataclass
class Range:
    file: str
    start: int
    end: int


@dataclass
class Ranges(InputPartition):
    """What one task reads."""

    ranges: list[Range]


def _dealt(ranges: list[Range]) -> list[Ranges]:
    """All ranges, dealt in order to tasks of about equal bytes; neighbours in a file are read as one.

    Each task has one range while there are at most ``TASKS``.
    """
    if len(ranges) <= TASKS:
        return [Ranges([r]) for r in ranges]
    room = min(-(-sum(r.end - r.start for r in ranges) // TASKS), RANGE_BYTES)
    tasks, held = [], room
    for r in ranges:
        if held >= room:
            tasks.append(Ranges([]))
            held = 0
        mine = tasks[-1].ranges
        if mine and mine[-1].file == r.file and mine[-1].end == r.start:
            mine[-1] = Range(r.file, mine[-1].start, r.end)
        else:
            mine.append(r)
        held += r.end - r.start
    return tasks


class DocumentDump(DataSource):
    """See the module; options are ``path``, ``range_bytes`` and, for a read without schema, none.

    Without a schema the fields are those of the first document, so one should be given.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        for file, _ in _committed(self.options["path"]):
            system, _ = _at(self.options["path"])
            with system.open_input_stream(file) as stream:
                first = stream.read(1 << 20).split(b"\n", 1)[0]
            if first:
                fields = pa.Table.from_pylist([json.loads(first)]).schema
                from pyspark.sql.pandas.types import from_arrow_schema

                return from_arrow_schema(fields)
        raise ValueError("no documents to take a schema from: give one")

    def reader(self, schema: StructType) -> DumpReader:
        return DumpReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DumpWriter:
        return DumpWriter(self.options, overwrite)


class DumpReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path = options["path"]
        self.step = int(options.get("range_bytes", RANGE_BYTES))
        self.schema = to_arrow_schema(schema)

    def partitions(self) -> list[InputPartition]:
        ranges = [
            Range(file, start, min(start + self.step, size))
            for file, size in _committed(self.path)
            for start in range(0, size, self.step)
        ]
        return _dealt(ranges) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        lines = []
        for part in partition.ranges:
            for line in self._lines(part):
                lines.append(line)
                if len(lines) == BATCH_ROWS:
                    yield self._batch(lines)
                    lines = []
        yield self._batch(lines)

    def _lines(self, part: Range) -> Iterator[bytes]:
        """Lines that begin in the range; the one before its first byte belongs to the range before."""
        system, _ = _at(self.path)
        with system.open_input_file(part.file) as source, io.BufferedReader(source) as file:
            file.seek(max(0, part.start - 1))
            at = part.start
            if part.start:
                at = part.start - 1 + len(file.readline())
            while at < part.end:
                line = file.readline()
                at += len(line)
                if line.strip():
                    yield line

    def _batch(self, lines: list[bytes]) -> pa.RecordBatch:
        # Names of fields are made once for all lines of one text.
        documents = json.loads(b"[" + b",".join(lines) + b"]")
        if len(documents) != len(lines):
            raise ValueError("a line is not one document")
        columns = [_column([d.get(f.name) for d in documents], f.type) for f in self.schema]
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """JSON values as an Arrow array, fields of objects one after the other."""
    if pa.types.is_struct(kind) and kind.num_fields:
        fields = [kind.field(i) for i in range(kind.num_fields)]
        held = [_column([None if v is None else v.get(f.name) for v in values], f.type) for f in fields]
        missing = pa.array([v is None for v in values], pa.bool_())
        return pa.StructArray.from_arrays(held, fields=fields, mask=missing)
    if not _is_plain(kind):
        values = [_read_value(v, kind) for v in values]
    return pa.array(values, kind)


def _is_plain(kind: pa.DataType) -> bool:
    """Whether Arrow takes the JSON values of this type as they are."""
    if pa.types.is_list(kind):
        return _is_plain(kind.value_type)
    return pa.types.is_integer(kind) or pa.types.is_string(kind) or pa.types.is_boolean(kind)


def _read_value(value, kind: pa.DataType):
    """A JSON value as Arrow takes it."""
    if value is None:
        return None
    if pa.types.is_timestamp(kind):
        return datetime.datetime.fromisoformat(value)
    if pa.types.is_date(kind):
        return datetime.datetime.fromisoformat(value).date()
    if pa.types.is_decimal(kind):
        return decimal.Decimal(str(value))
    if pa.types.is_floating(kind):
        return float(value)
    if pa.types.is_struct(kind):
        return {f.name: _read_value(value.get(f.name), f.type) for f in kind}
    if pa.types.is_list(kind):
        return [_read_value(v, kind.value_type) for v in value]
    return value


def _written_value(value):
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    raise TypeError(f"{type(value).__name__} is no JSON")


_encode = json.JSONEncoder(ensure_ascii=False, default=_written_value).encode


def _texts(column: pa.Array) -> list[str]:
    """The JSON of each value of a column, as ``json.dumps`` has it."""
    kind = column.type
    if pa.types.is_struct(kind) and kind.num_fields:
        held = [_texts(c) for c in column.flatten()]
        texts = _objects([kind.field(i).name for i in range(kind.num_fields)], held)
    elif pa.types.is_list(kind):
        # A null list has no items, whatever its place holds.
        items, ends = _texts(column.flatten()), pc.fill_null(pc.list_value_length(column), 0)
        ends = [0, *pc.cumulative_sum(pc.cast(ends, pa.int64())).to_pylist()]
        texts = [f"[{', '.join(items[i:j])}]" for i, j in zip(ends, ends[1:])]
    elif pa.types.is_integer(kind) or pa.types.is_boolean(kind):
        texts = column.cast(pa.string()).to_numpy(zero_copy_only=False).tolist()
    elif pa.types.is_float64(kind):
        texts = _encode(pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False).tolist())
        texts = texts[1:-1].split(", ") if len(column) else []
    elif pa.types.is_string(kind):
        found = column.fill_null("").to_numpy(zero_copy_only=False).tolist()
        texts = [json.encoder.encode_basestring(v) for v in found]
    else:
        # Each value once, where they repeat.
        found = column.dictionary_encode() if pa.types.is_timestamp(kind) else None
        if found is None:
            return [_encode(v) for v in column.to_pylist()]
        texts = [_encode(v) for v in found.dictionary.to_pylist()]
        texts = [texts[i] for i in found.indices.fill_null(0).to_numpy().tolist()] if texts else ["null"] * len(column)
    if column.null_count:
        texts = [t if there else "null" for t, there in zip(texts, column.is_valid().to_pylist())]
    return texts


def _objects(names: list[str], fields: list[list[str]]) -> list[str]:
    """JSON objects of the texts of their fields."""
    pattern = ", ".join(f"{_encode(name)}: ".replace("%", "%%") + "%s" for name in names)
    pattern = f"{{{pattern}}}"
    return [pattern % row for row in zip(*fields)]


def _lines_of(batch: pa.RecordBatch) -> bytes:
    if not batch.num_columns:
        return b"{}\n" * batch.num_rows
    return "".join(f"{line}\n" for line in _objects(batch.schema.names, [_texts(c) for c in batch.columns])).encode()


@dataclass
class Written(WriterCommitMessage):
    file: str
    size: int
    documents: int


class DumpWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.load = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _at(self.path)
        system.create_dir(f"{folder}/{DATA}", recursive=True)
        # Each attempt of a task has a file of its own.
        name = f"{self.load}-{uuid.uuid4().hex}.jsonl"
        documents = 0
        with system.open_output_stream(f"{folder}/{DATA}/{name}") as stream:
            for batch in batches:
                stream.write(_lines_of(batch))
                documents += batch.num_rows
            size = stream.tell()
        return Written(name, size, documents)

    def commit(self, messages: list[Written | None]) -> None:
        """All of a load's files come into view by one small file; an overwrite hides what was there."""
        system, folder = _at(self.path)
        files = [[m.file, m.size, m.documents] for m in messages if m is not None and m.documents]
        system.create_dir(f"{folder}/{COMMITS}", recursive=True)
        before = system.get_file_info(fs.FileSelector(f"{folder}/{COMMITS}"))
        stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d%H%M%S%f")
        pending = f"{folder}/{COMMITS}/{stamp}-{self.load}.pending"
        with system.open_output_stream(pending) as stream:
            stream.write(json.dumps({"files": files}).encode())
        system.move(pending, pending.removesuffix(".pending") + ".json")
        if self.overwrite:
            for info in before:
                system.delete_file(info.path)

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing names the files of a load that failed; those that are known go."""
        system, folder = _at(self.path)
        for message in messages:
            if message is not None:
                system.delete_file(f"{folder}/{DATA}/{message.file}")


def register(spark: SparkSession) -> str:
    """Make the format known to ``spark``; returns its name."""
    spark.dataSource.register(DocumentDump)
    return FORMAT
