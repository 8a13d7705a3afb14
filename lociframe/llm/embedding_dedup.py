"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one vector kept per group.

1. Equal vectors of a label become one class with its smallest vec_id and its size.
2. Centroids are fitted on at most ``SAMPLE`` classes; every class is assigned to its nearest centroid. A class near the
   border of another cell visits it: it may have partners there. Both ends of a link across a border lie within
   sqrt(1 - threshold ** 2) of it, 0.199 at 0.98; that margin is the default, and no link is lost. There are at most ``MAX_CELLS``
   cells; full ones are cut again, each by its own k-means, into ``INNER`` cells at most.
3. A cell of one label is cut in blocks of about ``BLOCK`` rows. A unit is a pair of blocks of which one holds residents;
   its cosines are one matrix product. For each row it gives the number of its links, and a spanning forest.
4. Link counts are summed; the forests' components are the groups, and a group's smallest vec_id is kept.

Vectors without label, null, empty or zero vectors and those with null or non-finite components link with nothing, and
vectors of different lengths do not either. Components keep their precision: vectors are equal, and cosines computed, as doubles. Rows without vec_id take part but give no id. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, small_batches, table, tasks
from .components import components
from .simhash import NO_ID, forest

COSINE = 0.98
SAMPLE = 20_000
CLASSES_PER_CELL = 1024
MAX_CELLS, FULL, INNER, INNER_SAMPLE = 2048, 4096, 64, 4000
BLOCK = 512
ROUNDS = 10


def exact_margin(threshold: float) -> float:
    """How far from a border the ends of a link across it can lie, with room for rounding."""
    return max(0.0, 1 - threshold * threshold) ** 0.5 + 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of very large or small components are lost
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    centres = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        full = np.linalg.norm(sums, axis=1) > 1e-12
        if full.any():
            centres[full] = unit(sums[full])
    return centres


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), "float64")
    return unit(values.reshape(len(column), -1))


def _classes(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label", usable.alias("usable"))


class Cells:
    """Centroids, and how near a vector must be to the border of a cell to visit it."""

    def __init__(self, centres: np.ndarray, margin: float):
        self.centres, self.reach = centres, np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T)) * margin + 1e-9

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, whether it is the row's own)."""
        near = x @ self.centres.T
        own = near.argmax(axis=1)
        rows, cells = np.nonzero(near.max(axis=1, keepdims=True) - near <= self.reach[own])
        return rows, cells, own[rows] == cells


def _visits(centres: dict[int, np.ndarray], margin: float):
    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {d: Cells(c, margin) for d, c in centres.items()}
        for b in batches:
            dims = np.diff(b.column(3).offsets.to_numpy())
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                if int(dim) not in found:  # no sample has this length
                    rows, cells, home = np.arange(len(part)), np.zeros(len(part), "int64"), np.ones(len(part), bool)
                else:
                    rows, cells, home = found[int(dim)].visits(matrix(part.column(3)))
                taken = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), taken.column(2), taken.column(3), pa.array(np.full(len(rows), dim), pa.int32()), pa.array(cells.astype("int32")), pa.array(home)], ["node", "n", "label", "embedding", "dim", "cell", "home"])

    return visits


def split_cells(cells: DataFrame, margin: float, name: str = "cells") -> DataFrame:
    """Cells of more than ``FULL`` residents are cut again by k-means, fitted on about ``INNER_SAMPLE`` of their residents each.

    Whoever is in a cell visits the inner cells that its border margin reaches; only residents are at home in one. So no link is lost.
    """
    spark = cells.sparkSession
    full = cut(cells.where("home").groupBy("dim", "cell").agg(F.count("*").alias("homes")).where(F.col("homes") > FULL), "full")
    if full.isEmpty():
        return cells
    drawn = cells.where("home").join(F.broadcast(full), ["dim", "cell"])  # at most MAX_CELLS rows a length
    drawn = drawn.where(F.pmod(F.xxhash64("node", F.lit(3)), F.col("homes")) < INNER_SAMPLE)

    def fit(t: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(t.sort_values("node")["embedding"].to_list()).astype("float64"))
        centres = spherical_kmeans(x, min(INNER, int(t["homes"].iloc[0]) // CLASSES_PER_CELL + 1))
        return pd.DataFrame({"dim": t["dim"].iloc[0], "cell": t["cell"].iloc[0], "centre": list(centres)})

    inner: dict[tuple[int, int], list] = {}
    for r in drawn.select("dim", "cell", "homes", "node", "embedding").groupBy("dim", "cell").applyInPandas(fit, "dim int, cell int, centre array<double>").collect():  # MAX_CELLS * INNER rows at most
        inner.setdefault((r["dim"], r["cell"]), []).append(r["centre"])
    held = spark.sparkContext.broadcast({k: np.array(v) for k, v in inner.items()})

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[tuple[int, int], Cells] = {}
        for b in batches:
            dims, at = b.column(4).to_numpy(), b.column(5).to_numpy()
            for key in {*zip(dims.tolist(), at.tolist(), strict=True)}:
                part = b.filter(pa.array((dims == key[0]) & (at == key[1])))
                if key not in held.value:
                    yield part
                    continue
                if key not in made:
                    if len(made) > 64:
                        made.clear()
                    made[key] = Cells(held.value[key], margin)
                rows, inner, home = made[key].visits(matrix(part.column(3)))
                taken = part.take(pa.array(rows))
                home &= taken.column(6).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*taken.columns[:5], pa.array((MAX_CELLS + key[1] * INNER + inner).astype("int32")), pa.array(home)], schema=b.schema)

    return cut(cells.mapInArrow(visits, cells.schema), name)


def _unit_links(threshold: float):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of their unit -> (node, links) and (node, links 0, other): a count or an edge."""

        def close(t: pa.Table) -> pa.RecordBatch:
            node, n, query, resident = t["node"].to_numpy(), t["n"].to_numpy(), t["query"].to_numpy(), t["resident"].to_numpy()
            x = matrix(t["embedding"].combine_chunks())
            q, r = np.flatnonzero(query), np.flatnonzero(resident)
            near = x[q] @ x[r].T >= threshold
            near &= q[:, None] != r[None]
            both = t["both"][0].as_py()  # two blocks of residents, or one with itself: the residents' counts are due here too
            count = np.zeros(len(node), "int64")
            count[q] += near @ n[r]
            if both:
                one_way = near & ~query[r][None]  # a resident that is a query as well has its count already
                count[r] += n[q] @ one_way
            a, b = np.nonzero(near)
            label = forest(len(node), q[a], r[b])
            counted, moved = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(label)))
            nodes = np.r_[node[counted], node[moved]]
            others = pa.array(np.r_[node[counted], node[label[moved]]], pa.int64(), mask=np.r_[np.ones(len(counted), bool), np.zeros(len(moved), bool)])
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.r_[count[counted], np.zeros(len(moved), "int64")]), others], ["node", "links", "other"])

        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            units = b.column(0).to_numpy()
            cuts = np.r_[0, np.flatnonzero(units[1:] != units[:-1]) + 1, len(units)]
            for at, to in zip(cuts[:-1], cuts[1:], strict=True):
                if held and units[at] != last:
                    yield close(pa.Table.from_batches(held))
                    held = []
                last = units[at]
                held.append(b.slice(at, to - at))
        if held:
            yield close(pa.Table.from_batches(held))

    return links


def vector_links(classes: DataFrame, threshold: float = COSINE, margin: float | None = None, block: int = BLOCK) -> DataFrame:
    """(node, n, label, embedding) -> rows (node, links) with other null, and edges (node, other)."""
    spark, margin = classes.sparkSession, exact_margin(threshold) if margin is None else margin
    small_batches(spark)
    kind = classes.schema["embedding"].dataType.simpleString()
    total = classes.count()
    k = min(MAX_CELLS, total // CLASSES_PER_CELL + 1)
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toPandas()["embedding"]
    centres = {d: spherical_kmeans(unit(np.stack(x.to_numpy()).astype("float64")), k) for d, x in sample.groupby(sample.map(len))} if k > 1 else {}
    cells = cut(classes.mapInArrow(_visits(centres, margin), f"node long, n long, label int, embedding {kind}, dim int, cell int, home boolean"), "cells")
    cells = split_cells(cells, margin)
    keys = ["label", "dim", "cell"]
    sizes = cut(cells.groupBy(*keys).agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors")), "sizes")
    blocks = lambda c: F.ceil(F.col(c) / block).cast("int")
    sized = cells.join(sizes.select(*keys, blocks("homes").alias("h"), blocks("visitors").alias("v")), keys).where("h > 0")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("home"), F.col("h")).otherwise(F.col("v"))).cast("int")
    pair = lambda q, r, query, resident: F.struct(q.alias("q"), r.alias("r"), F.lit(query).alias("query"), F.lit(resident).alias("resident"))
    span = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    mine = F.col("own")
    as_resident = F.concat(
        F.transform(F.filter(span("h"), lambda i: i < mine), lambda i: pair(i, mine, False, True)),
        F.array(pair(mine, mine, True, True)),
        F.transform(F.filter(span("h"), lambda i: i > mine), lambda i: pair(mine, i, True, False)),
        F.transform(span("v"), lambda i: pair(i + F.col("h"), mine, False, True)),
    )
    as_visitor = F.transform(span("h"), lambda i: pair(mine + F.col("h"), i, True, False))
    units = sized.withColumn("own", own).withColumn("at", F.explode(F.when(F.col("home"), as_resident).otherwise(as_visitor)))
    key = F.xxhash64(*keys, "at.q", "at.r")
    units = units.select(key.alias("unit"), *keys, F.col("at.q").alias("q"), F.col("at.r").alias("r"), "node", "n", F.col("at.query").alias("query"), F.col("at.resident").alias("resident"), (F.col("at.q") < F.col("h")).alias("both"), "embedding")
    dealt = units.repartition(tasks(spark), *keys, "q", "r").sortWithinPartitions("unit", *keys, "q", "r")
    return cut(dealt.mapInArrow(_unit_links(threshold), "node long, links long, other long"), "links")


def near_vectors(vectors: DataFrame, threshold: float = COSINE, margin: float | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of (vec_id, embedding, label)."""
    rows = _classes(vectors)
    single = rows.schema["embedding"].dataType.simpleString() == "array<float>"  # such components are exact as they are
    usable = rows.where("usable").withColumn("embedding", F.col("embedding").cast("array<float>" if single else "array<double>"))
    nameless = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64("label", "embedding"), 3)
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")).withColumn("node", F.coalesce("node", nameless))
    classes = cut(classes.select("node", "n", F.col("label").cast("int").alias("label"), "embedding"), "classes")
    found = vector_links(classes, threshold, margin)
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    groups = cut(components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))), "groups")
    named = classes.join(counts, "node", "left").join(groups, "node", "left")
    named = cut(named.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")), "named")
    same = (F.col("r.embedding") == F.col("c.embedding")) & (F.col("r.label") == F.col("c.label"))
    linked = usable.alias("r").join(named.alias("c"), same).select("vec_id", "n_links", F.when(F.col("component_id") < NO_ID, F.col("component_id")).alias("component_id"))
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
