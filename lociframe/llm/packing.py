"""Best-fit packing with large-item matching.

Documents become pieces of at most ``capacity`` tokens. A plan only needs to know how many pieces have each length, so
it is made from a histogram of at most ``capacity`` rows, at any input size:

* large items, above a third of the capacity, fit at most twice in a sequence: from the longest down, each is matched
  with the longest large partner that fits;
* smaller items, longest first, go to the tightest gap that takes them, and to new sequences when no gap does.

Equal lengths are placed as runs: ``count`` pieces of one length go to consecutive sequences, ``each`` in a sequence.
Sequences with the same filling are one range of numbers; placing one length splits at most two ranges, so the number
of runs depends on the capacity, not on the input. Pieces are numbered within their length by a hash bucket and a row
number in it (the number of buckets grows with the square root of the pieces), and find their run by binary search.

Null and empty texts are one end token; equal rows are packed as separate documents, and a repeated doc_id only makes
their numbers interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, small_batches, table, text_or_empty
from .tokens import encoded, slices

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def document_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece. Only documents above the capacity are cut: the first piece takes what whole pieces leave over."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), encoded(path, b.column(1), end_id), strict=True):
                at = 0
                for piece in range(-(-len(ids) // capacity)):
                    to = at + capacity if at or len(ids) % capacity == 0 else len(ids) % capacity
                    rows.append((doc_id, piece, at, to - at, zlib.crc32(ids[at:to].tobytes())))
                    at = to
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text")).mapInArrow(cut_up, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first number, count, each, first sequence, offset) that place ``counts[length]`` pieces of each length."""
    left, used, runs = dict(counts), dict.fromkeys(counts, 0), []
    gaps: dict[int, list[list[int]]] = {}  # gap -> ranges [first sequence, number of sequences]
    sequences = 0

    def put(length: int, count: int, each: int, first: int, offset: int) -> None:
        runs.append((length, used[length], count, each, first, offset))
        used[length] += count
        left[length] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                bisect.insort(open_gaps, gap)
            gaps.setdefault(gap, []).append([first, count])

    open_gaps: list[int] = []
    large = sorted((x for x in counts if 3 * x > capacity), reverse=True)
    rising = large[::-1]
    for x in large:
        while left[x]:
            at = bisect.bisect_right(rising, capacity - x) - 1
            while at >= 0 and not left[rising[at]]:
                rising.pop(at)
                at -= 1
            mate = rising[at] if at >= 0 else 0
            pairs = left[x] // 2 if mate == x else min(left[x], left[mate]) if mate else 0
            if mate and not pairs:  # one is left of a length that pairs with itself
                at -= 1
                while at >= 0 and not left[rising[at]]:
                    at -= 1
                mate = rising[at] if at >= 0 else 0
                pairs = min(left[x], left[mate]) if mate else 0
            count = pairs or left[x]
            put(x, count, 1, sequences, 0)
            if mate:
                put(mate, count, 1, sequences, x)
            leave(capacity - x - mate, sequences, count)
            sequences += count
    for x in sorted((x for x in counts if 3 * x <= capacity and x > 0), reverse=True):
        while left[x]:
            at = bisect.bisect_left(open_gaps, x)
            if at == len(open_gaps):
                gap, each = capacity, capacity // x
                first, there = sequences, -(-left[x] // each)
                sequences += there
            else:
                gap = open_gaps[at]
                each = gap // x
                first, there = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    open_gaps.pop(at)
            full = min(there, left[x] // each)
            if full:
                put(x, full * each, each, first, capacity - gap)
                leave(gap - each * x, first, full)
            some = left[x] if full < there else 0
            if some:
                put(x, some, some, first + full, capacity - gap)
                leave(gap - some * x, first + full, 1)
            untouched = there - full - bool(some)
            leave(gap, first + full + bool(some), untouched)
    return runs


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to (doc_id, piece, length, ...) rows that come from a table."""
    spark = pieces.sparkSession
    counts = dict(pieces.groupBy("length").count().collect())  # at most ``capacity`` rows
    buckets = max(16, int(sum(counts.values()) ** 0.5) + 1)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    bases = bases.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("row", F.row_number().over(within)).join(bases, ["length", "bucket"])
    numbered = numbered.withColumn("number", F.col("base") + F.col("row") - 1).drop("bucket", "row", "base")

    runs = spark.sparkContext.broadcast(np.array(sorted(plan(counts, capacity)), "int64").reshape(-1, 6))  # bounded by the capacity

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        r = runs.value
        x, k = length.to_numpy("int64"), number.to_numpy("int64")
        at = np.searchsorted(r[:, 0] * (1 << 48) + r[:, 1], x * (1 << 48) + k, "right") - 1
        j, each = k - r[at, 1], r[at, 3]
        return pd.DataFrame({"sequence_id": r[at, 4] + j // each, "offset": r[at, 5] + j % each * x})

    placed = numbered.withColumn("at", find("length", "number"))
    return placed.select(*pieces.columns, F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return place(cut(document_pieces(docs, path, capacity, end_id), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: sequence_id, input_ids and segment (number of the piece in its sequence) of each token."""

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for doc_id, ids in zip(b.column(0).to_pylist(), encoded(path, b.column(1), end_id), strict=True):
                first = len(ids) % capacity or capacity
                parts = np.split(ids, range(first, len(ids), capacity))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()), pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))], ["doc_id", "piece", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    pieces = rows.mapInArrow(ids_of, "doc_id long, piece int, ids array<int>").join(placed, ["doc_id", "piece"])
    packed = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # capacity bounds a group
    segments = F.flatten(F.transform("parts", lambda p, i: F.array_repeat(i.cast("int"), F.size(p["ids"]))))
    return packed.select("sequence_id", F.flatten("parts.ids").alias("input_ids"), segments.alias("segment"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
