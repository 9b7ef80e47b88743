"""DBF tables as a Spark data source: ``spark.read.format("dbf").load(path)``; rows are all text. Rows have a fixed width,
so a file becomes a partition for each ``rowsPerPartition`` rows (100,000) and a task reads its own bytes only; rows leave
as Arrow batches. A path with a scheme is read through pyarrow's file systems.

Compressed DBC files are decoded by ``implode``, or by the option ``decoder``: a callable ``module:function`` that turns
DBC bytes into DBF bytes.
"""

from __future__ import annotations

import importlib
import itertools
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from meridian.sources.implode import dbf_of_dbc

ENCODINGS = ("iso-8859-1", "latin1", "cp1252", "utf-8")


@dataclass
class Field:
    name: str
    kind: str
    size: int


def header(data: bytes) -> tuple[int, int, int, list[Field]]:
    """Rows, where they start, bytes of a row, fields."""
    rows, start, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while at + 32 <= start and data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("ascii", "replace").strip().upper()
        fields.append(Field(name, chr(data[at + 11]), data[at + 16]))
        at += 32
    return rows, start, size, fields


def rows(data: bytes, encoding: str | None = None) -> Iterator[tuple]:
    """The rows of a whole file."""
    total, start, size, fields = header(data)
    return records(data[start : start + total * size], size, fields, encoding)


def records(data: bytes, size: int, fields: list[Field], encoding: str | None = None) -> Iterator[tuple]:
    """The rows that are not marked as deleted; the first encoding that fits is taken."""
    choices = (encoding,) if encoding else ENCODINGS

    def text(raw: bytes) -> str | None:
        for name in choices:
            try:
                return raw.decode(name).strip(" \0") or None
            except UnicodeDecodeError:
                continue
        return raw.decode("latin1").strip(" \0") or None

    for at in range(0, len(data) - size + 1, size):
        if data[at : at + 1] == b"\x1a":
            return
        if data[at : at + 1] == b"*":
            continue
        at += 1
        out = []
        for f in fields:
            out.append(text(data[at : at + f.size]))
            at += f.size
        yield tuple(out)


def _open(path: str):
    """A file for random reads."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    scheme, _, rest = path.partition("://")
    system, inner = fs.FileSystem.from_uri(f"s3://{rest}" if scheme in ("s3a", "s3n") else path)
    return system.open_input_file(inner)


def contents(path: str, decoder: str | None = None) -> bytes:
    with _open(path) as f:
        data = f.read()
    if not path.lower().endswith(".dbc"):
        return data
    if not decoder:
        return dbf_of_dbc(data)
    module, _, name = decoder.partition(":")
    return getattr(importlib.import_module(module), name)(data)


def _head(path: str, decoder: str | None) -> tuple[int, int, int, list[Field]]:
    if path.lower().endswith(".dbc"):
        return header(contents(path, decoder))
    with _open(path) as f:
        first = f.read(32)
        return header(first + f.read(struct.unpack_from("<H", first, 8)[0]))


class _Rows(InputPartition):
    """Rows first to last of a file; all of a compressed one, which cannot be read in parts."""

    def __init__(self, path: str, first: int, last: int):
        super().__init__(path)
        self.path, self.first, self.last = path, first, last


class DbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("path", "").split(",") if p]
        self.decoder, self.encoding = options.get("decoder"), options.get("encoding")
        self.each = int(options.get("rowsperpartition") or options.get("rowsPerPartition") or 100_000)

    def partitions(self) -> list[InputPartition]:
        out = []
        for p in self.paths:
            total = 0 if p.lower().endswith(".dbc") else _head(p, None)[0]
            out += [_Rows(p, i, min(total, i + self.each)) for i in range(0, total, self.each)] or [_Rows(p, 0, 0)]
        return out

    def read(self, partition: _Rows) -> Iterator[pa.RecordBatch]:
        total, start, size, fields = _head(partition.path, self.decoder)
        if partition.path.lower().endswith(".dbc"):
            found = rows(contents(partition.path, self.decoder), self.encoding)
        else:
            with _open(partition.path) as f:
                f.seek(start + partition.first * size)
                found = records(f.read((partition.last - partition.first) * size), size, fields, self.encoding)
        schema = pa.schema([(f.name, pa.string()) for f in fields])
        while some := list(itertools.islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some)], schema=schema)


class DbfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dbf"

    def schema(self) -> StructType:
        first = self.options["path"].split(",")[0]
        return StructType([StructField(f.name, StringType()) for f in _head(first, self.options.get("decoder"))[3]])

    def reader(self, schema: StructType) -> DbfReader:
        return DbfReader(dict(self.options))
