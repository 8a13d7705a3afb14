"""Exact deduplication through an extendible-hash index on shared files.

1. A text's key is a 64-bit hash of its normalised form. A task folds the copies it reads, within ``FOLD_BYTES``, to one record of
   the text and its ids, so that a text that fills a third of the table reaches its owner as a few records.
2. Owners take equal ranges of keys, those of one prefix; they are a power of two, at least one for each ``OWNER_ROWS`` rows by a count of the table. Hashed keys fill them evenly. An owner reads
   its records in order of the key, chains the texts of a key and compares their bytes: that comparison alone decides which rows
   are equal. Only the texts of one key are held in memory.
3. Keys go into buckets as they come: a bucket that gets more than ``BUCKET_KEYS`` keys is halved by the next bit, to any
   depth. As keys come in order, a bucket is written when a key behind it comes, so an owner holds one bucket and the borders of those not yet reached. The index goes to files in the shared folder: entries (bucket, key, chain, digest, the id that stays, group size), members
   (key, chain, ids), and the directory, a row (first key, depth, keys) for each bucket. The entries of the doubled directory that point to the same
   bucket are that one row; a range without keys is one empty bucket that has no row.
4. A row is looked up by its key: the directory tells its bucket, by the first bits of the key at each depth that occurs, and the bucket its entry, by key and chain.

Nulls and edge cases: a null text counts as empty; rows of one group with the same largest doc_id are all kept by
``kept``; a null doc_id loses to any other and keeps its group if all are null. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import string
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, sent_if_small, small_batches, table, tasks, text_or_empty

BUCKET_KEYS = 64
FOLD_BYTES = 32 << 20
IDS_IN_ROW = 8192
#: Rows for which there is an owner, on average.
OWNER_ROWS = 2_000_000
INDEX = "key long, chain int, ids array<long>, sha binary, keep_id long, group_size long, depth int, keys long, bucket long"


def normalised(text: str) -> bytes:
    """UTF-8 with A-Z in lower case; ``bytes.lower`` touches ASCII letters only."""
    return text.encode("utf-8", "surrogatepass").lower()


def normalised_text(text: Column) -> Column:
    """The same on the JVM."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


UNSIGNED = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _folded(bits: int):
    """(doc_id, text) -> (owner, key, norm, ids): the copies that a task meets together are one record."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            keys = [xxhash.xxh64_intdigest(t, 42) for t in held]
            owners = [k >> (64 - bits) if bits else 0 for k in keys]
            columns = [pa.array(owners, pa.int32()), pa.array([signed(k) for k in keys], pa.int64()), pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["owner", "key", "norm", "ids"])

        held: dict[bytes, list] = {}
        size = 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = normalised(t)
                if (ids := held.get(t)) is None:
                    held[t] = [i]
                    size += len(t) + 200
                else:
                    ids.append(i)
                    size += 40
                if size > FOLD_BYTES:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return fold


class Buckets:
    """Buckets of a range of keys, whose first ``depth`` bits are fixed; unsigned keys are added in rising order, each once."""

    def __init__(self, low: int, depth: int, bucket_keys: int):
        self.ahead, self.keys, self.limit = [(low, depth)], [], bucket_keys  # the last range is the open one

    def _close(self) -> tuple[int, int, int]:
        low, depth = self.ahead.pop()
        n, self.keys = len(self.keys), []
        return low, depth, n

    def add(self, key: int) -> list[tuple[int, int, int]]:
        """(first key, depth, number of keys) of the buckets that are complete now; they lie before the key."""
        done = []
        while key >> (64 - self.ahead[-1][1]) != self.ahead[-1][0] >> (64 - self.ahead[-1][1]):
            done.append(self._close())
        self.keys.append(key)
        while len(self.keys) > self.limit and self.ahead[-1][1] < 64:
            low, depth = self.ahead.pop()
            middle = low + (1 << (63 - depth))
            self.ahead += [(middle, depth + 1), (low, depth + 1)]
            if key >= middle:
                right = [k for k in self.keys if k >= middle]
                self.keys = self.keys[: len(self.keys) - len(right)]
                done.append(self._close())
                self.keys = right
        return done

    def finish(self) -> list[tuple[int, int, int]]:
        return [self._close() for _ in range(len(self.ahead))]


def split(keys: np.ndarray, low: int, depth: int, bucket_keys: int) -> list[tuple[int, int, int]]:
    """(first key, depth, number of keys) of the buckets of a range: unsigned keys in order, from ``low``, whose first ``depth`` bits are fixed."""
    buckets = Buckets(low, depth, bucket_keys)
    return [x for k in keys.tolist() for x in buckets.add(k)] + buckets.finish()


def _chained(bits: int, bucket_keys: int):
    """Records of an owner in order of their key -> its part of the index."""
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in INDEX.split(", ")]
    fixed = max(1, bits)  # signed order is unsigned order where the first bit is fixed

    def chain_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        entries: deque[tuple] = deque()  # of the open bucket
        chain: list[list] = []
        buckets, last, waiting = None, None, 0

        def write(complete: list[tuple[int, int, int]]) -> None:
            for low, depth, n in complete:
                done.append((signed(low), None, None, None, None, None, depth, n, None))
                while entries and (entries[0][0] & UNSIGNED) >> (64 - depth) == low >> (64 - depth):
                    done.append((*entries.popleft(), signed(low)))

        def close() -> None:
            """The last key's texts become entries, and the key goes into its bucket."""
            nonlocal buckets
            if last is None:
                return
            key = last & UNSIGNED
            if buckets is not None and buckets[0] != key >> (64 - fixed):
                write(buckets[1].finish())
                buckets = None
            if buckets is None:
                buckets = key >> (64 - fixed), Buckets(key >> (64 - fixed) << (64 - fixed), fixed, bucket_keys)
            write(buckets[1].add(key))
            entries.extend((last, i, None, hashlib.sha256(t).digest(), m, n, None, None) for i, (t, m, n) in enumerate(chain))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)

        for b in batches:
            for key, t, ids in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if key != last:
                    close()
                    chain, last = [], key
                known = [i for i in ids if i is not None]
                m = max(known) if known else None
                for at, x in enumerate(chain):
                    if x[0] == t:
                        x[1] = m if x[1] is None or m is not None and m > x[1] else x[1]
                        x[2] += len(ids)
                        break
                else:
                    at = len(chain)
                    chain.append([t, m, len(ids)])
                done.extend((key, at, ids[i : i + IDS_IN_ROW], None, None, None, None, None, None) for i in range(0, len(ids), IDS_IN_ROW))
                waiting += len(ids)
                if waiting > 4 * IDS_IN_ROW:
                    yield batch()
                    done.clear()
                    waiting = 0
        close()
        if buckets is not None:
            write(buckets[1].finish())
        if done:
            yield batch()

    return chain_up


def owner_bits(rows: int, partitions: int) -> int:
    """Bits of the key that tell its owner: owners for all partitions, and for each ``OWNER_ROWS`` rows."""
    return max(0, partitions - 1, -(-rows // OWNER_ROWS) - 1).bit_length()


def build_index(docs: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Writes the index of ``docs`` to the shared folder: entries have a digest and their bucket, members have ids, buckets a depth."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    bits = owner_bits(docs.count(), tasks(spark))
    records = rows.mapInArrow(_folded(bits), "owner int, key long, norm binary, ids array<long>")
    owned = records.repartitionById(1 << bits, F.col("owner")).sortWithinPartitions("key")
    return cut(owned.mapInArrow(_chained(bits, bucket_keys), INDEX), "index")


def located(index: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows (key, ...) with ``bucket``, the first key of the bucket that the directory has for the key; rows in ranges without any key are left out."""
    directory = index.where("depth IS NOT NULL").select(F.col("key").alias("bucket"), "depth")
    depths = [r["depth"] for r in directory.select("depth").distinct().collect()]  # at most 64
    first = lambda d: F.expr(f"shiftleft(shiftright(key, {64 - d}), {64 - d})") if d < 64 else F.col("key")
    at = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), first(d).alias("bucket")) for d in depths])) if depths else F.explode(F.array().cast("array<struct<depth:int,bucket:bigint>>"))
    probes = rows.withColumn("probe", at).select("*", "probe.*").drop("probe")
    return probes.join(sent_if_small(directory), ["bucket", "depth"], "left_semi").drop("depth")


def exact_groups(docs: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, key, chain for each row of ``docs``."""
    index = build_index(docs, bucket_keys)
    members = located(index, index.where("ids IS NOT NULL").select("key", "chain", "ids"))
    entries = index.where("sha IS NOT NULL").select("bucket", "key", "chain", "sha", "keep_id", "group_size")
    found = members.join(entries, ["bucket", "key", "chain"]).withColumn("doc_id", F.explode("ids"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "key", "chain")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("key", "chain")


def op3_sql() -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH t AS (SELECT doc_id, {lowered} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)"""
