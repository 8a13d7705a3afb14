"""Bootstrap of the distance matrix: every replicate draws each site a Poisson number of times, and all replicates are one pass.

A Poisson weight of mean 1 for each (replicate, site) is what drawing as many sites as there are comes to, without knowing
their number or moving a row. Weights are read off a hash of both, so replicates can be repeated, and made again by another engine.
A task holds its sums, a number for each replicate and pair of individuals, and adds its sites as matrix products; only these sums are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A prime below 2^31: products of two remainders stay within 64 bits.
PRIME = (1 << 31) - 1
MOST = 12
BATCH_SITES = 2048


def poisson_steps() -> list[int]:
    """Remainders from which on a weight is at least 1, 2, ..., ``MOST``."""
    share, total, steps = math.exp(-1), 0.0, []
    for n in range(MOST):
        total += share / math.factorial(n)
        steps.append(int(total * PRIME))
    return steps


def remainders(sites: np.ndarray, replicates: np.ndarray) -> np.ndarray:
    """Hash of each replicate and site, replicates x sites."""
    x = ((sites.astype("int64") % PRIME * 48_271)[None] + (replicates.astype("int64") * 1_103_515_245)[:, None] + 12_345) % PRIME
    x = (x * x % PRIME + 7 * x + 3) % PRIME
    return (x * x % PRIME * 48_271 + x) % PRIME


def weights(sites: np.ndarray, replicates: np.ndarray) -> np.ndarray:
    return np.searchsorted(poisson_steps(), remainders(sites, replicates), "right").astype(float)


def distance_bootstrap(calls: DataFrame, replicates: int, metric: str = "reads", min_coverage: int = 1, min_quality: int = 0) -> DataFrame:
    """(replicate, i, j, distance, informative): mean difference of allele frequency (reads) or genotype over the drawn sites that both are good at.

    ``informative`` counts drawn sites, as often as they were drawn; pairs without any are left out. Individuals bound what a site's row and a task's sums hold.
    """
    good = calls.where((F.col("a") + F.col("b") >= max(1, min_coverage)) & (F.col("q") >= min_quality) & (F.lit(True) if metric == "reads" else F.col("g") >= 0))
    value = F.col("a") / (F.col("a") + F.col("b")) if metric == "reads" else F.col("g").cast("double")
    individuals = sorted(r["ind"] for r in good.select("ind").distinct().collect())  # a row per individual
    held = good.groupBy("site").agg(F.array_sort(F.collect_list(F.struct("ind", value.alias("f")))).alias("v"))
    first, second = np.triu_indices(len(individuals), 1)
    names, drawn = np.array(individuals, "int64"), np.arange(1, replicates + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros((replicates, len(first))), np.zeros((replicates, len(first)))
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_SITES):
                batch = whole.slice(at, BATCH_SITES)
                values = np.full((batch.num_rows, len(names)), np.nan)
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False))
                values[row, np.searchsorted(names, pc.list_flatten(batch.column(1)).to_numpy())] = pc.list_flatten(batch.column(2)).to_numpy()
                apart = np.abs(values[:, first] - values[:, second])
                both, w = ~np.isnan(apart), weights(batch.column(0).to_numpy(), drawn)
                total += w @ np.where(both, apart, 0.0)
                number += w @ both
        r, p = np.nonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (r + 1, names[first[p]], names[second[p]], total[r, p], number[r, p].astype("int64"))], ["replicate", "i", "j", "total", "n"])

    rows = held.select(F.col("site").cast("long").alias("site"), F.col("v.ind").cast("array<long>").alias("ind"), F.col("v.f").alias("f"))
    sums = rows.mapInArrow(run, "replicate long, i long, j long, total double, n long").groupBy("replicate", "i", "j").agg(F.sum("total").alias("total"), F.sum("n").alias("informative"))
    return sums.select("replicate", "i", "j", (F.col("total") / F.col("informative")).alias("distance"), "informative")


def bootstrap_spread(replicates: DataFrame) -> DataFrame:
    """Of each pair: mean, standard deviation and the 2.5 and 97.5 percent points of its replicates."""
    at = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY distance)")
    return replicates.groupBy("i", "j").agg(F.avg("distance").alias("mean"), F.stddev_samp("distance").alias("deviation"), at(0.025).alias("low"), at(0.975).alias("high"))
