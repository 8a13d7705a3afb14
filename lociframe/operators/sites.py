"""Filters and aggregates over the calls of a site: one grouping by site, or none."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import CHUNK, by_position

SITE = ["site", "chrom", "pos"]


def among(individuals: Iterable[int]) -> Column:
    return F.col("ind").isin(list(individuals))


def total_coverage(calls: DataFrame, individuals: Iterable[int]) -> DataFrame:
    return calls.where(among(individuals)).groupBy(*SITE).agg(F.sum(F.col("a") + F.col("b")).alias("coverage"))


def filter_total_coverage(calls: DataFrame, individuals: Iterable[int], low: int | None, high: int | None) -> DataFrame:
    """Sites whose summed coverage lies within the bounds, both included."""
    sums = total_coverage(calls, individuals)
    return sums.where((F.lit(True) if low is None else F.col("coverage") >= low) & (F.lit(True) if high is None else F.col("coverage") <= high))


def filter_coverage_share(calls: DataFrame, individuals: Iterable[int], low: float, high: float) -> DataFrame:
    """Sites from the ``low`` to the ``high`` share of the coverage distribution; thresholds are exact order statistics of one aggregate."""
    sums = total_coverage(calls, individuals)
    bounds = sums.agg(F.expr(f"percentile_disc({low}) WITHIN GROUP (ORDER BY coverage)").alias("lo"), F.expr(f"percentile_disc({high}) WITHIN GROUP (ORDER BY coverage)").alias("hi"))
    return sums.join(F.broadcast(bounds), F.col("coverage").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")  # bounds: one row


def filter_every_individual(calls: DataFrame, individuals: Iterable[int], min_coverage: int, min_quality: int) -> DataFrame:
    """Sites at which every individual of the population has enough reads and quality."""
    chosen = list(individuals)
    good = (F.col("a") + F.col("b") >= min_coverage) & (F.col("q") >= min_quality)
    return calls.where(among(chosen)).groupBy(*SITE).agg(F.count_if(good).alias("n")).where(F.col("n") == len(chosen))


def filter_defined(calls: DataFrame, individuals: Iterable[int], least: int) -> DataFrame:
    return calls.where(among(individuals)).groupBy(*SITE).agg(F.count_if(F.col("g") != -1).alias("defined")).where(F.col("defined") >= least)


def _followers(pos: np.ndarray, spacing: int) -> np.ndarray:
    """Of each site in order, the place of the first one at ``spacing`` or more behind it; their number where there is none."""
    return np.searchsorted(pos, pos + spacing, "left")


def filter_spacing(sites: DataFrame, spacing: int, width: int = CHUNK) -> DataFrame:
    """Greedy along a chromosome: a site stays if it is at least ``spacing`` behind the last one that stayed; of sites at one position, the first.

    Which site follows one that stays does not depend on what came before. So a chunk of ``width`` positions is a step function: from the position at
    which a site may stay again, to the last site that stays in it. Walks that begin at different sites soon
    meet, so there are few steps. The steps of a chromosome's chunks, not its sites, are followed in one
    group; that tells each chunk where to begin, and chunks then mark their sites on their own.
    """
    rows = sites.select(*SITE).withColumn("chunk", by_position(width))
    if spacing <= 0:
        return rows.drop("chunk")

    def steps(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        pos = np.unique(t["pos"].to_numpy())
        last, follow = np.arange(len(pos)), _followers(pos, spacing)
        for i in range(len(pos) - 1, -1, -1):
            if follow[i] < len(pos):
                last[i] = last[follow[i]]
        upto = np.flatnonzero(np.append(last[1:] != last[:-1], True))  # the last beginning that ends at the same site
        return pd.DataFrame({"chrom": key[0], "chunk": key[1], "upto": pos[upto], "last": pos[last[upto]]})

    def follow_chunks(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        out, free = [], None
        for chunk, part in t.sort_values(["chunk", "upto"]).groupby("chunk"):
            out.append((key[0], chunk, free))
            upto, last = part["upto"].to_numpy(), part["last"].to_numpy()
            at = 0 if free is None else int(np.searchsorted(upto, free, "left"))
            if at < len(upto):
                free = int(last[at]) + spacing
        return pd.DataFrame(out, columns=["chrom", "chunk", "free"]).astype({"free": "Int64"})

    def mark_sites(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["pos", "site"])
        pos = t["pos"].to_numpy()
        follow, kept = _followers(pos, spacing), []
        i = 0 if pd.isna(t["free"].iloc[0]) else int(np.searchsorted(pos, t["free"].iloc[0], "left"))
        while i < len(pos):
            kept.append(i)
            i = int(follow[i])
        return t.iloc[kept][SITE]

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    summary = rows.groupBy("chrom", "chunk").applyInPandas(steps, f"chrom {kind['chrom']}, chunk long, upto long, last long")
    begins = summary.groupBy("chrom").applyInPandas(follow_chunks, f"chrom {kind['chrom']}, chunk long, free long")
    return rows.join(begins, ["chrom", "chunk"]).groupBy("chrom", "chunk").applyInPandas(mark_sites, sites.select(*SITE).schema)


def aggregate_population(calls: DataFrame, individuals: Iterable[int]) -> DataFrame:
    """One virtual individual: summed reads, highest quality; genotype 2 or 0 if all defined ones are, -1 if none, else 1."""
    defined = F.when(F.col("g") != -1, F.col("g"))
    low, high = F.min(defined), F.max(defined)
    g = F.when(low.isNull(), -1).when(low == 2, 2).when(high == 0, 0).otherwise(1).cast("long")
    return calls.where(among(individuals)).groupBy(*SITE).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("q").alias("q"), g.alias("g"))


def coverage_distribution(rows: DataFrame, key: str) -> DataFrame:
    """(key, coverage) -> key, coverage, and the whole percent of sites with at most that coverage, at most 99."""
    counts = rows.groupBy(key, "coverage").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(key).orderBy("coverage")
    total = F.sum("n").over(Window.partitionBy(key))
    percent = F.least(F.lit(99), F.floor(100 * F.sum("n").over(upto) / total)).cast("long")
    return counts.select(key, "coverage", percent.alias("percent"))


def percent_steps(distribution: DataFrame, key: str) -> DataFrame:
    """First differences of the cumulative percents: what is plotted."""
    before = F.lag("percent", 1, 0).over(Window.partitionBy(key).orderBy("coverage"))
    return distribution.select(key, "coverage", (F.col("percent") - before).alias("step"))


def allele_counts(calls: DataFrame, individuals: Iterable[int]) -> DataFrame:
    """Chromosomes with a call, and copies of allele 2 among them."""
    defined = F.col("g") >= 0
    return calls.where(among(individuals)).groupBy(*SITE).agg(F.sum(F.when(defined, 2).otherwise(0)).alias("na"), F.sum(F.when(defined, 2 - F.col("g")).otherwise(0)).alias("ac"))
