"""``spark.read.format("variants").load(path)``: variant tables with a JSON header as a data source.

The schema comes from the first bytes of the first file, on the driver. Files are cut into byte ranges, each read by a task from
the first line that begins in it; compressed files are one range. ``.schema("pos long, `1G` long")`` prunes: only the named columns are converted.
Paths are local ones or such as pyarrow opens (hdfs, s3, ...); in a folder, files that do not begin with ``_`` or ``.`` are read in order of name.
"""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .metadata import Metadata, parse_header

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
COMPRESSED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd", ".lz4": "lz4"}


def located(path: str) -> tuple[fs.FileSystem, str]:
    """file:/x, file:///x, x and other schemes."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def data_files(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    store, root = located(path)
    found = store.get_file_info(root)
    if found.type == fs.FileType.File:
        return store, [found]
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    inside = store.get_file_info(fs.FileSelector(root))
    return store, sorted((x for x in inside if x.type == fs.FileType.File and x.base_name[0] not in "._"), key=lambda x: x.path)


def opened(store: fs.FileSystem, path: str):
    """A stream of the bytes, uncompressed."""
    kind = COMPRESSED.get(posixpath.splitext(path)[1])
    return store.open_input_stream(path, compression=kind) if kind else store.open_input_stream(path, compression=None)


def head_lines(path: str, block: int = 1 << 16) -> list[str]:
    """The comment lines before the first row; only the blocks that hold them are read."""
    lines: list[str] = []
    store, files = data_files(path)
    for file in files:
        with opened(store, file.path) as stream:
            rest = b""
            while True:
                more = stream.read(block)
                parts = (rest + more).split(b"\n")
                rest = parts.pop() if more else b""
                for line in parts:
                    if line.startswith(b"#"):
                        lines.append(line.decode("utf-8", "replace"))
                    elif line.strip():
                        return lines
                if not more:
                    break
    return lines


def header_of(path: str, columns: int | None = None) -> Metadata:
    return parse_header(head_lines(path), columns)


def table_schema(meta: Metadata) -> StructType:
    """The header's columns: positions and individuals' numbers are whole, all others text."""
    starts = sorted(c for _, c in meta.individuals)
    width = starts[1] - starts[0] if len(starts) > 1 else len(meta.column_names) - starts[0] + 1 if starts else 0
    whole = {meta.pos, meta.rPos} | {c + i for c in starts for i in range(width)}
    return StructType([StructField(n, LongType() if i in whole else StringType()) for i, n in enumerate(meta.column_names, 1)])


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    length: int  # -1: to the end, compressed


class VariantReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, range_bytes: int):
        self.path, self.schema, self.range_bytes = path, schema, range_bytes
        self.names = header_of(path).column_names
        missing = [f.name for f in schema.fields if f.name not in self.names]
        if missing:
            raise ValueError(f"the table has no column {missing[0]}")

    def partitions(self) -> list[ByteRange]:
        out = []
        for file in data_files(self.path)[1]:
            if posixpath.splitext(file.path)[1] in COMPRESSED:
                out.append(ByteRange(file.path, 0, -1))
            else:
                out += [ByteRange(file.path, at, min(self.range_bytes, file.size - at)) for at in range(0, file.size, self.range_bytes)]
        return out

    def _blocks(self, part: ByteRange) -> Iterator[bytes]:
        """Whole lines that begin within the range."""
        store, _ = located(self.path)
        if part.length < 0:
            with opened(store, part.path) as stream:
                rest = b""
                while more := stream.read(BLOCK_BYTES):
                    block, end, rest = (rest + more).rpartition(b"\n")
                    yield block + end
                yield rest
            return
        with store.open_input_file(part.path) as f:
            # one byte earlier: a range that begins right behind a line feed begins with a whole line
            at, end, rest = max(0, part.start - 1), part.start + part.length, b""
            f.seek(at)
            skip = part.start > 0
            while True:
                more = f.read(BLOCK_BYTES)
                data = rest + more
                if skip:
                    _, found, data = data.partition(b"\n")
                    if not found and more:
                        at, rest = at + len(more), b""
                        continue
                    skip = False
                    at = at + len(rest) + len(more) - len(data) if found else end
                    if not found:
                        return
                # data begins at byte ``at``, at the beginning of a line
                if at >= end:
                    return
                if at + len(data) > end and (stop := data.find(b"\n", end - at - 1)) >= 0:
                    yield data[: stop + 1]
                    return
                if not more:
                    yield data
                    return
                block, found, rest = data.rpartition(b"\n")
                yield block + found
                at += len(block) + len(found)

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        wanted = [f.name for f in self.schema.fields]
        kinds = {f.name: pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in self.schema.fields}
        parse = csv.ParseOptions(delimiter="\t", quote_char=False, newlines_in_values=False, invalid_row_handler=lambda row: "skip")
        convert = csv.ConvertOptions(include_columns=wanted, column_types={n: pa.string() for n in wanted}, strings_can_be_null=False, check_utf8=False)
        for block in self._blocks(part):
            lines = [x.rstrip(b"\r") for x in block.split(b"\n") if x.strip() and not x.startswith(b"#")]
            short = len(self.names) - 1
            lines = [x + b"\t" * (short - n) if (n := x.count(b"\t")) < short else b"\t".join(x.split(b"\t", short + 1)[: short + 1]) if n > short else x for x in lines]
            if not lines:
                continue
            options = csv.ReadOptions(column_names=list(self.names), use_threads=False, block_size=max(1 << 20, 2 * len(block) + 1024))
            table = csv.read_csv(pa.BufferReader(b"\n".join(lines) + b"\n"), options, parse, convert)
            columns = [whole_numbers(table[n]) if kinds[n] == pa.int64() else table[n].combine_chunks() for n in wanted]
            yield pa.RecordBatch.from_arrays(columns, wanted)


def whole_numbers(column: pa.ChunkedArray) -> pa.Array:
    """Cells as numbers; null where they are none."""
    try:
        return column.combine_chunks().cast(pa.int64())
    except pa.ArrowInvalid:
        def number(x: str) -> int | None:
            try:
                return int(x)
            except ValueError:
                return None

        found = [number(x) for x in column.to_pylist()]
        return pa.array([x if x is not None and abs(x) <= np.iinfo("int64").max else None for x in found], pa.int64())


class VariantSource(DataSource):
    """Options: ``path``; ``rangeBytes``, how many bytes of a file a task reads."""

    @classmethod
    def name(cls) -> str:
        return "variants"

    def schema(self) -> StructType:
        return table_schema(header_of(self.options["path"]))

    def reader(self, schema: StructType) -> VariantReader:
        return VariantReader(self.options["path"], schema, int(self.options.get("rangeBytes", RANGE_BYTES)))


def read_variants(spark, path: str, columns: list[str] | None = None, range_bytes: int = RANGE_BYTES):
    """The table as a DataFrame, of these columns alone if they are named."""
    spark.dataSource.register(VariantSource)
    reader = spark.read.format("variants").option("rangeBytes", range_bytes)
    if columns is not None:
        whole = table_schema(header_of(path))
        reader = reader.schema(StructType([whole[c] for c in columns]))
    return reader.load(path)
