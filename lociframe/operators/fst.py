"""Fixation indices between two populations: conditional sums of one pass over the calls, then arithmetic per site."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shuffles import permutations

from .sites import SITE


def _sum_in(individuals: Iterable[int], value: Column, where: Column) -> Column:
    return F.sum(F.when(F.col("ind").isin(list(individuals)) & where, value).otherwise(F.lit(0)))


def population_sums(calls: DataFrame, pop1: Iterable[int], pop2: Iterable[int], source: str = "reads", extra: tuple[Column, ...] = ()) -> DataFrame:
    """a1, n1, a2, n2 of each site: allele-1 count and allele total of either population, from reads or from genotypes."""
    reads = source == "reads"
    value, size = (F.col("a"), F.col("a") + F.col("b")) if reads else (F.col("g"), F.lit(2))
    where = F.lit(True) if reads else F.col("g") >= 0
    sums = [f(p).alias(f"{c}{i}") for i, p in ((1, pop1), (2, pop2)) for c, f in (("a", lambda p: _sum_in(p, value, where)), ("n", lambda p: _sum_in(p, size, where)))]
    return calls.where(F.col("ind").isin([*pop1, *pop2])).groupBy(*SITE).agg(*sums, *extra)


def with_frequencies(sums: DataFrame) -> DataFrame:
    rows = sums.where("n1 > 0 AND n2 > 0")
    return rows.withColumn("p1", F.col("a1") / F.col("n1")).withColumn("p2", F.col("a2") / F.col("n2"))


def not_fixed() -> Column:
    return ~((F.col("p1") + F.col("p2")).isin(0.0, 2.0))


def wright() -> Column:
    mean = (F.col("p1") + F.col("p2")) / 2
    return F.coalesce(((F.col("p1") - F.col("p2")) / 2) ** 2 / F.nullif(mean * (1 - mean), F.lit(0.0)), F.lit(0.0))


def reich_parts() -> tuple[Column, Column]:
    h = [F.col(f"a{i}") * (F.col(f"n{i}") - F.col(f"a{i}")) / (F.col(f"n{i}") * (F.col(f"n{i}") - 1)) for i in (1, 2)]
    top = (F.col("p1") - F.col("p2")) ** 2 - h[0] / F.col("n1") - h[1] / F.col("n2")
    return top, top + h[0] + h[1]


def weir_cockerham() -> Column:
    n1, n2, p1, p2 = (F.col(c) for c in ("n1", "n2", "p1", "p2"))
    n = n1 + n2
    nc = n - (n1 * n1 + n2 * n2) / n
    mean = (F.col("a1") + F.col("a2")) / n
    msp = n1 * (p1 - mean) ** 2 + n2 * (p2 - mean) ** 2
    msg = (n1 * p1 * (1 - p1) + n2 * p2 * (1 - p2)) / (n - 2)
    return (msp - msg) / F.nullif(msp + (nc - 1) * msg, F.lit(0.0))


def site_fst(calls: DataFrame, pop1: Iterable[int], pop2: Iterable[int], estimator: str = "wright", source: str = "reads", discard_fixed: bool = True) -> DataFrame:
    rows = with_frequencies(population_sums(calls, pop1, pop2, source))
    if estimator == "wright":
        value = wright()
    elif estimator == "reich":
        rows = rows.where("n1 > 1 AND n2 > 1")
        top, bottom = reich_parts()
        value = top / F.nullif(bottom, F.lit(0.0))
    else:
        rows = rows.where("n1 + n2 > 2")
        value = weir_cockerham()
    rows = rows.where(not_fixed()) if discard_fixed else rows
    return rows.select(*SITE, value.alias("fst"))


def retained_fst(calls: DataFrame, pop1: Iterable[int], pop2: Iterable[int], min_reads: int, min_quality: int, retain: bool = True) -> DataFrame:
    """Wright's index where both populations have enough reads and some call of enough quality; else -1, or no row."""
    best = [F.max(F.when(F.col("ind").isin(list(p)), F.col("q"))).alias(f"q{i}") for i, p in ((1, pop1), (2, pop2))]
    rows = with_frequencies(population_sums(calls, pop1, pop2, "reads", tuple(best)))
    enough = (F.col("n1") >= min_reads) & (F.col("n2") >= min_reads) & (F.col("q1") >= min_quality) & (F.col("q2") >= min_quality)
    rows = rows if retain else rows.where(enough)
    return rows.select(*SITE, F.when(enough, wright()).otherwise(F.lit(-1.0)).alias("fst"))


def overall_fst(calls: DataFrame, pop1: Iterable[int], pop2: Iterable[int], source: str = "reads") -> DataFrame:
    """Mean of the three indices over the sites that are not fixed, and the ratio of sums of the second."""
    rows = with_frequencies(population_sums(calls, pop1, pop2, source)).where("n1 > 1 AND n2 > 1").where(not_fixed())
    top, bottom = reich_parts()
    parts = rows.select(wright().alias("w"), top.alias("top"), bottom.alias("bottom"), weir_cockerham().alias("wc"))
    reich = F.avg(F.col("top") / F.nullif(F.col("bottom"), F.lit(0.0)))
    return parts.agg(F.count("*").alias("sites"), reich.alias("mean_reich"), (F.sum("top") / F.sum("bottom")).alias("ratio_reich"), F.avg("w").alias("mean_wright"), F.avg("wc").alias("mean_weir_cockerham"))


def shuffled_fst(calls: DataFrame, everyone: int, size1: int, size2: int, shuffles: int, seed: int = 1) -> DataFrame:
    """Mean Wright index of populations that random permutations of the individuals draw, with the members of either.

    All shuffles come from one pass: the calls meet the table of shuffles, whose size is a parameter.
    """
    drawn = permutations(calls.sparkSession, everyone, shuffles, seed).where(F.col("place") < size1 + size2)
    drawn = drawn.select("shuffle", F.col("item").alias("ind"), (F.col("place") < size1).alias("first"))
    rows = calls.select(*SITE, "ind", "a", "b").join(F.broadcast(drawn), "ind")
    value, total = F.col("a"), F.col("a") + F.col("b")
    sums = [F.sum(F.when(w, v).otherwise(0)).alias(n) for w, i in ((F.col("first"), 1), (~F.col("first"), 2)) for v, n in ((value, f"a{i}"), (total, f"n{i}"))]
    rows = with_frequencies(rows.groupBy("shuffle", *SITE).agg(*sums)).where(not_fixed())
    found = rows.groupBy("shuffle").agg(F.avg(wright()).alias("mean_fst"), F.count("*").alias("sites"))
    names = lambda w: F.array_join(F.array_sort(F.collect_list(F.when(w, F.col("ind")))).cast("array<string>"), ",")
    members = drawn.groupBy("shuffle").agg(names(F.col("first")).alias("members1"), names(~F.col("first")).alias("members2"))
    return found.join(F.broadcast(members), "shuffle")


def shuffled_fst_summary(shuffled: DataFrame) -> DataFrame:
    """Largest and mean value over all shuffles, and the populations of the largest (ties: of the first shuffle)."""
    best = F.max(F.struct("mean_fst", (-F.col("shuffle")).alias("s"), "members1", "members2"))
    return shuffled.agg(best.alias("b"), F.avg("mean_fst").alias("mean"), F.count("*").alias("shuffles")).select(F.col("b.mean_fst").alias("largest"), "mean", F.col("b.members1").alias("members1"), F.col("b.members2").alias("members2"), "shuffles")
