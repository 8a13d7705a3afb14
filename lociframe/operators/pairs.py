"""Statistics of pairs of individuals: a site's calls become one array, and pairs are formed within a row, without a join."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sites import SITE


def pair_rows(calls: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per key and pair i < j with both structs x and y. Individuals, not rows, bound the array."""
    held = calls.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ind", *fields))).alias("v"))
    pairs = F.flatten(F.transform("v", lambda x: F.transform(F.filter("v", lambda y: y["ind"] > x["ind"]), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    return held.select(*keys, F.inline(pairs)).select(*keys, F.col("x.ind").alias("i"), F.col("y.ind").alias("j"), "x", "y")


def pair_distance(calls: DataFrame, metric: str = "reads", min_coverage: int = 1, min_quality: int = 0) -> DataFrame:
    """Mean allele-frequency (reads) or genotype difference over sites at which both are good enough, and how many those are."""
    good = calls.where((F.col("a") + F.col("b") >= max(1, min_coverage)) & (F.col("q") >= min_quality) & (F.lit(True) if metric == "reads" else F.col("g") >= 0))
    value = F.col("a") / (F.col("a") + F.col("b")) if metric == "reads" else F.col("g").cast("double")
    rows = pair_rows(good.withColumn("f", value), SITE, ["f"])
    return rows.groupBy("i", "j").agg(F.avg(F.abs(F.col("x.f") - F.col("y.f"))).alias("distance"), F.count("*").alias("informative"))


def reference_distance(calls: DataFrame, base: Column) -> DataFrame:
    """Distance of each individual to the reference. ``base``: 1 or 2 for an allele, 3 for another nucleotide, 0 for none."""
    f = F.col("a") / (F.col("a") + F.col("b"))
    away = F.when(base == 1, 1 - f).when(base == 2, f).otherwise(1.0)
    return calls.where((F.col("a") + F.col("b") > 0) & (base != 0)).groupBy("ind").agg(F.avg(away).alias("distance"), F.count("*").alias("informative"))


def offspring_heterozygosity(calls: DataFrame, mothers: Iterable[int], fathers: Iterable[int]) -> DataFrame:
    """Expected heterozygosity of the offspring of each pair, over sites with both genotypes."""
    held = calls.where("g >= 0").groupBy(*SITE).agg(
        F.array_sort(F.collect_list(F.when(F.col("ind").isin(list(mothers)), F.struct("ind", "g")))).alias("m"),
        F.array_sort(F.collect_list(F.when(F.col("ind").isin(list(fathers)), F.struct("ind", "g")))).alias("f"),
    )
    rows = held.select("m", F.explode("f").alias("f")).select(F.explode("m").alias("m"), "f")
    p, q = F.col("m.g") / 2, F.col("f.g") / 2
    return rows.groupBy(F.col("m.ind").alias("mother"), F.col("f.ind").alias("father")).agg(F.avg(p * (1 - q) + q * (1 - p)).alias("heterozygosity"), F.count("*").alias("sites"))


def mitochondrial_pi(calls: DataFrame, min_coverage: int, min_shared: int) -> DataFrame:
    """Mean over pairs of the share of differing positions among those both cover, for pairs that share enough."""
    rows = pair_rows(calls.where((F.col("a") + F.col("b") >= min_coverage) & F.col("g").isin(0, 2)), SITE, ["g"])
    pairs = rows.groupBy("i", "j").agg(F.count_if(F.col("x.g") != F.col("y.g")).alias("differ"), F.count("*").alias("shared")).where(F.col("shared") >= min_shared)
    return pairs.agg(F.avg(F.col("differ") / F.col("shared")).alias("pi"), F.count("*").alias("pairs"))


def king(calls: DataFrame) -> DataFrame:
    """Kinship of each pair from shared heterozygotes and opposite homozygotes."""
    rows = pair_rows(calls.where("g >= 0"), SITE, ["g"])
    x, y = F.col("x.g"), F.col("y.g")
    sums = rows.groupBy("i", "j").agg(F.count("*").alias("n_snp"), F.count_if((x == 1) & (y == 1)).alias("hethet"), F.count_if(F.abs(x - y) == 2).alias("ibs0"), F.count_if(x == 1).alias("het_i"), F.count_if(y == 1).alias("het_j"))
    return sums.withColumn("kinship", (F.col("hethet") - 2 * F.col("ibs0")) / F.nullif(F.col("het_i") + F.col("het_j"), F.lit(0)))


#: Least kinship of each relationship.
RELATIONSHIPS = ((0.354, "duplicate or MZ twin"), (0.177, "1st degree"), (0.0884, "2nd degree"), (0.0442, "3rd degree"))


def relationship(kinship: Column) -> Column:
    first = F.when(kinship > RELATIONSHIPS[0][0], RELATIONSHIPS[0][1])
    for least, name in RELATIONSHIPS[1:]:
        first = first.when(kinship >= least, name)
    return first.otherwise("")


def covariance(calls: DataFrame, individuals: int) -> DataFrame:
    """Products of individuals' standardised genotypes, summed over sites; sites with a missing call or under two minor alleles are left out."""
    held = calls.where("g >= 0").groupBy(*SITE).agg(F.array_sort(F.collect_list(F.struct("ind", "g"))).alias("v"), F.sum("g").alias("s"), F.count("*").alias("n"))
    held = held.where((F.col("n") == individuals) & (F.least(F.col("s"), 2 * F.col("n") - F.col("s")) >= 2))
    p = (1 + F.col("s")) / (2 + 2 * F.col("n"))
    z = F.transform("v", lambda x: F.struct(x["ind"].alias("ind"), ((x["g"] - F.col("s") / F.col("n")) / F.sqrt(p * (1 - p))).alias("z")))
    rows = held.select("site", z.alias("z")).select(F.explode("z").alias("x"), "z").select("x", F.explode("z").alias("y"))
    return rows.groupBy(F.col("x.ind").alias("i"), F.col("y.ind").alias("j")).agg(F.sum(F.col("x.z") * F.col("y.z")).alias("product"))


def principal_points(products: DataFrame, individuals: int, axes: int = 2) -> list[tuple[int, int, float]]:
    """(individual, axis from 1, coordinate): unit eigenvectors of the covariance, largest eigenvalue first; the largest coordinate of an axis is positive.

    The matrix has a row per individual, not per site, and is solved on the driver.
    """
    m = np.zeros((individuals, individuals))
    for r in products.collect():
        m[r["i"], r["j"]] = r["product"]
    _, vectors = np.linalg.eigh((m + m.T) / 2)
    out = []
    for axis in range(min(axes, individuals)):
        v = vectors[:, -1 - axis]
        v = v if v[np.abs(v).argmax()] > 0 else -v
        out += [(i, axis + 1, float(x)) for i, x in enumerate(v)]
    return out
