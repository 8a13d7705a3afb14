"""Token ids in Arrow IPC files whose batches are fixed-size lists.

Documents are dealt in ranges of ascending doc_id; a task encodes its range and writes two files to the shared folder:

* ``<shard>.arrow``: ``input_ids`` fixed_size_list<uint16 or uint32>[length] and ``mask`` fixed_size_list<bool>[length], in
  record batches of ``BATCH_ROWS`` sequences. The range's ids fill the sequences without gaps; the last one is padded
  with 0, and its mask says how far it goes. Row ``i`` is row ``i % BATCH_ROWS`` of batch ``i // BATCH_ROWS``, and a
  memory-mapped file hands out its values without a copy.
* ``<shard>.docs.arrow``: doc_id, start in the shard and number of ids of each document.

Files carry the name of their task attempt, and only what successful attempts report enters the manifest (a table), so a
lost executor or a second attempt leaves no wrong shard. Shards begin at the sum of the ids of the shards before them; the
manifest has one row per shard.

Null and empty texts have the end id only; null ids come first; equal ids keep all their rows, ordered by text. An empty
table gives an empty manifest and an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, new_path, small_batches, table, tasks, text_or_empty
from .tokens import encoded, slices

LENGTH = 2048
BATCH_ROWS = 256
END_ID = 2
READ_ROWS = 4096
MANIFEST = "shard int, file string, first_doc long, n_docs long, n_ids long"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def sequence_schema(length: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("input_ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))])


class _SequenceWriter:
    def __init__(self, store: fs.FileSystem, path: str, length: int, id_type: pa.DataType):
        self.length, self.id_type, self.schema = length, id_type, sequence_schema(length, id_type)
        self.sink = store.open_output_stream(path)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.held, self.n = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= BATCH_ROWS * self.length:
            self._write(self.n // (BATCH_ROWS * self.length) * BATCH_ROWS * self.length)

    def _write(self, n: int) -> None:
        ids = np.concatenate(self.held)
        for at in range(0, n, BATCH_ROWS * self.length):
            part = ids[at : min(n, at + BATCH_ROWS * self.length)]
            rows = -(-len(part) // self.length)
            values, mask = np.zeros(rows * self.length, self.id_type.to_pandas_dtype()), np.zeros(rows * self.length, bool)
            values[: len(part)], mask[: len(part)] = part, True
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (values, mask)]
            self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.held, self.n = [ids[n:]], self.n - n

    def close(self) -> None:
        if self.n:
            self._write(self.n)
        self.out.close()
        self.sink.close()


def write_token_files(docs: DataFrame, folder: str, path: str, length: int = LENGTH, end_id: int = END_ID, vocabulary: int = 1 << 16) -> DataFrame:
    """Writes the files and returns the manifest. ``vocabulary``: above 65536 ids, they take 32 bits each."""
    id_type = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = slices(batches)
        if (first := next(batches, None)) is None:
            return
        store, root = opened(folder)
        store.create_dir(root)
        shard = TaskContext.get().partitionId()
        file = f"{shard:06d}-{uuid.uuid4().hex}"
        out = _SequenceWriter(store, f"{root}/{file}.arrow", length, id_type)
        docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])
        at = n_docs = 0
        with store.open_output_stream(f"{root}/{file}.docs.arrow") as sink, pa.ipc.new_file(sink, docs_schema) as index:
            for b in (x for xs in ([first], batches) for x in xs):
                counts = []
                for ids in encoded(path, b.column(1), end_id):
                    out.add(ids)
                    counts.append(len(ids))
                starts = at + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("int64")
                index.write_batch(pa.RecordBatch.from_arrays([b.column(0), pa.array(starts), pa.array(counts, pa.int64())], schema=docs_schema))
                at += sum(counts)
                n_docs += len(counts)
        out.close()
        row = [[shard], [file], [first.column(0)[0].as_py()], [n_docs], [at]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()], strict=True)], ["shard", "file", "first_doc", "n_docs", "n_ids"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    ranged = rows.repartitionByRange(tasks(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return cut(ranged.mapInArrow(write, MANIFEST), "manifest").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


class TokenFile:
    """Random access to the sequences and documents of one shard; on a local file the arrays are views of the mapped file."""

    def __init__(self, folder: str, file: str):
        store, root = opened(folder)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(f"{root}/{file}.arrow") if local else store.open_input_file(f"{root}/{file}.arrow")
        self.reader = pa.ipc.open_file(self.source)
        with store.open_input_file(f"{root}/{file}.docs.arrow") as f:
            self.docs = pa.ipc.open_file(f).read_all()
        self.length = self.reader.schema.field("input_ids").type.list_size

    def _values(self, batch: int) -> np.ndarray:
        return self.reader.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        batch = self.reader.get_batch(i // BATCH_ROWS)
        at = i % BATCH_ROWS
        return batch.column(0)[at].values.to_numpy(zero_copy_only=True), batch.column(1)[at].values.to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """doc_id, start in the shard and ids of each document, batch after batch."""
        step, at, values = BATCH_ROWS * self.length, -1, np.empty(0)
        for d, start, n in zip(*(self.docs.column(i).to_pylist() for i in range(3)), strict=True):
            parts = []
            for k in range(start // step, (start + n - 1) // step + 1):
                if k != at:
                    values, at = self._values(k), k
                parts.append(values[max(0, start - k * step) : start + n - k * step])
            yield d, start, parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = ((d, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, start, ids in TokenFile(folder, file).documents())
                while rows := list(islice(found, READ_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = manifest.select("file", "start").repartition(tasks(manifest.sparkSession))
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_path(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest, folder)
