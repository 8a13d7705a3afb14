"""SimHash near-duplicates through a Gray-order hierarchical index.

1. One pass makes the fingerprint of each whole text; equal fingerprints become one class with its smallest doc_id, so
   that copies never meet each other.
2. Fingerprints at ``MAX_DIFF`` = 2 or fewer bits share one of three blocks of bits. Each class goes to its three cells
   (mask, fingerprint & mask). Cells are counted first; those of one class end there. A cell above ``CELL`` classes is
   split again: its open bits are cut in three blocks, of which a linked pair again shares one. Distinct fingerprints
   with 11 open bits number 2048 at most, so this ends with cells that fit in memory, and no pair is lost.
3. In a cell, fingerprints in order of their Gray rank are the leaves of a tree: a node holds the bits that all below
   it share, and only those that its parent does not hold. The tree is joined with itself from the root; a pair of
   nodes carries the differences found so far, and is dropped with all below it once they exceed ``MAX_DIFF``.
4. A cell emits a spanning forest of its links, and the components of all forests are the result.

Nulls and edge cases: null and empty texts have fingerprint zero and link like any other; rows without doc_id take part,
but give no id; an empty table gives an empty result. Equal rows share a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table, tasks, text_or_empty
from .components import components

MAX_DIFF = 2
CELL = 2048
LAST_BITS = 11  # distinct fingerprints with so many open bits fit in a cell
FAN = 4
SHINGLE = 3
CHUNK = 1 << 15
#: Classes without any doc_id get node numbers from here on, above all ids.
NO_ID = 1 << 62


def fingerprint(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes split at ASCII white space and lower A-Z only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else iter([b" ".join(words)])
    n, counts = max(1, len(words) - SHINGLE + 1), np.zeros(64, "int64")
    for at in range(0, n, CHUNK):
        h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for _, s in zip(range(CHUNK), shingles)), "<u8")
        counts += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.int64())], ["doc_id", "fp"])


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each word in the sequence of Gray codes."""
    x = fp.astype("uint64")
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def _grown(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of ``values`` repeated, and 0, 1, ... within its repeats."""
    ends = np.cumsum(counts)
    return np.repeat(values, counts), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def linked(cell: np.ndarray, fp: np.ndarray, max_diff: int = MAX_DIFF) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i < j) of fingerprints in the same cell at ``max_diff`` or fewer bits; rows are in order of cell and Gray rank."""
    n = len(fp)
    fp = fp.astype("uint64")
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[starts, n])
    place = np.arange(n) - np.repeat(starts, sizes)
    levels = [(np.arange(n), np.full(n, ~np.uint64(0)), fp)]  # first row, shared bits, their values
    width = 1
    while width < sizes.max(initial=1):
        width *= FAN
        first = np.flatnonzero(place % width == 0)
        both, any_ = np.bitwise_and.reduceat(fp, first), np.bitwise_or.reduceat(fp, first)
        shared = ~(both ^ any_)
        levels.append((first, shared, both & shared))
    a = b = np.arange(len(starts))
    known, diff = np.zeros(len(starts), "uint64"), np.zeros(len(starts), "int64")
    for k in range(len(levels) - 1, -1, -1):
        first, shared, value = levels[k]
        if k < len(levels) - 1:
            above = levels[k + 1][0]
            child = np.searchsorted(first, above)
            children = np.diff(np.r_[child, len(first)])
            pair, at = _grown(np.arange(len(a)), children[a] * children[b])
            a2, b2 = child[a[pair]] + at // children[b[pair]], child[b[pair]] + at % children[b[pair]]
            keep = (a2 <= b2) if k else (a2 < b2)
            keep |= a[pair] != b[pair]
            a, b, known, diff = a2[keep], b2[keep], known[pair][keep], diff[pair][keep]
        elif not k:
            return np.empty(0, "int64"), np.empty(0, "int64")
        common = shared[a] & shared[b]
        diff = diff + np.bitwise_count((value[a] ^ value[b]) & common & ~known)
        near = diff <= max_diff
        a, b, known, diff = a[near], b[near], common[near], diff[near]
    return a, b


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position that each of ``n`` positions reaches by the links a, b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        old = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (old == label).all():
            break
    return label


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mask, cell, fp, node), whole cells together -> spanning forests (a, b) of each cell's links."""

    def links(part: list[np.ndarray]) -> pa.RecordBatch:
        mask, cell, fp, node = part
        order = np.lexsort((gray_rank(fp), cell, mask))
        mask, cell, fp, node = mask[order], cell[order], fp[order], node[order]
        number = np.cumsum(np.r_[False, (mask[1:] != mask[:-1]) | (cell[1:] != cell[:-1])])
        label = forest(len(fp), *linked(number, fp))
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], ["a", "b"])

    rest: list[np.ndarray] = [np.empty(0, "int64")] * 4
    for b in batches:
        rest = [np.r_[r, b.column(i).to_numpy()] for i, r in enumerate(rest)]
        starts = np.flatnonzero(np.r_[True, (rest[0][1:] != rest[0][:-1]) | (rest[1][1:] != rest[1][:-1])])
        squares = np.cumsum(np.diff(starts).astype("int64") ** 2)
        at = 0
        while len(squares) - at:  # whole cells, with a bound on their pairs; the last cell may go on
            to = max(at + 1, int(np.searchsorted(squares, (squares[at - 1] if at else 0) + CELL * CELL, "right")))
            yield links([r[starts[at] : starts[to]] for r in rest])
            at = to
        rest = [r[starts[-1] :] for r in rest]
    if len(rest[0]):
        yield links(rest)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def narrower(mask: int) -> list[int]:
    """The masks that fix one of three blocks of the open bits too."""
    bits = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(bits) * i // (MAX_DIFF + 1) for i in range(MAX_DIFF + 2)]
    return [mask | sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def fingerprint_links(classes: DataFrame, cell_size: int = CELL) -> DataFrame:
    """(fp, node) with distinct fp -> edges (a, b) of nodes that have the components of all links."""
    spark, masks, rows, edges = classes.sparkSession, [0], classes.withColumn("mask", F.lit(0).cast("long")), None
    while True:
        steps = spark.createDataFrame([(_signed(m), _signed(x)) for m in masks for x in narrower(m)], "mask long, next long")  # 3 ** level rows
        cells = rows.join(F.broadcast(steps), "mask").select(F.col("next").alias("mask"), F.col("fp").bitwiseAND(F.col("next")).alias("cell"), "fp", "node")
        masks = [x for m in masks for x in narrower(m)]
        limit = max(cell_size, CELL) if all(64 - m.bit_count() <= LAST_BITS for m in masks) else cell_size
        counts = cut(cells.groupBy("mask", "cell").agg(F.count("*").alias("n")).where("n > 1"), "counts")
        small = cells.join(counts.where(f"n <= {limit}"), ["mask", "cell"]).select("mask", "cell", "fp", "node")
        dealt = small.repartition(tasks(spark), "mask", "cell").sortWithinPartitions("mask", "cell")
        found = cut(dealt.mapInArrow(_cell_links, "a long, b long"), "links")
        edges = found if edges is None else edges.union(found)
        large = counts.where(f"n > {limit}")
        if large.isEmpty():
            return edges
        rows = cut(cells.join(large, ["mask", "cell"]).select("fp", "node", "mask"), "large")


def near_groups(docs: DataFrame, cell_size: int = CELL) -> DataFrame:
    """doc_id, fp (64-bit fingerprint) and component_id of each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    prints = cut(rows.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    nameless = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64("fp"), 3)
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).withColumn("node", F.coalesce("node", nameless)), "classes")
    found = cut(components(fingerprint_links(classes, cell_size)), "components")
    named = classes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    named = cut(named, "named").withColumnRenamed("fp", "class_fp")
    joined = prints.join(named, F.col("fp") == F.col("class_fp"))
    return joined.select("doc_id", "fp", F.when(F.col("component_id") < NO_ID, F.col("component_id")).alias("component_id"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
