"""Populations of individuals: unions, usable sites, and how far populations differ along components."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import chi2_tails, f_tails
from .sites import filter_every_individual


def union_of_populations(members: DataFrame) -> DataFrame:
    """(ord, population, ind) -> each individual once, with the population that names it first."""
    first = F.min(F.struct("ord", "population")).alias("first")
    return members.groupBy("ind").agg(first).select("ind", F.col("first.population").alias("population"))


def usable_sites(calls: DataFrame, individuals: list[int], min_coverage: int, min_quality: int) -> DataFrame:
    """One row: how many of all sites have enough reads and quality in every individual."""
    used = filter_every_individual(calls, individuals, min_coverage, min_quality).select("site").distinct().agg(F.count("*").alias("used"))
    return used.crossJoin(F.broadcast(calls.select("site").distinct().agg(F.count("*").alias("sites"))))  # one row


def average_divergence(products: DataFrame, groups: DataFrame) -> DataFrame:
    """(i, j, product) of all ordered pairs, (ind, population) -> mean distance of each pair of populations, the mean of equal pairs being 1.

    The distance of two individuals is X(i, i) + X(j, j) - 2 X(i, j). All tables are of individuals, not of sites.
    """
    own = products.where("i = j").select(F.col("i").alias("k"), F.col("product").alias("d"))
    rows = products.join(own.select(F.col("k").alias("i"), F.col("d").alias("di")), "i").join(own.select(F.col("k").alias("j"), F.col("d").alias("dj")), "j")
    named = rows.join(groups.select(F.col("ind").alias("i"), F.col("population").alias("p")), "i").join(groups.select(F.col("ind").alias("j"), F.col("population").alias("q")), "j")
    means = named.groupBy("p", "q").agg(F.avg(F.col("di") + F.col("dj") - 2 * F.col("product")).alias("d"))
    whole = Window.partitionBy()  # pairs of populations
    return means.select("p", "q", (F.col("d") / F.avg(F.when(F.col("p") == F.col("q"), F.col("d"))).over(whole)).alias("divergence"))


def component_anova(coordinates: DataFrame, groups: DataFrame) -> DataFrame:
    """(ind, component, value), (ind, population) -> F, degrees of freedom and p of each pair of populations along each component."""
    rows = coordinates.join(groups, "ind")
    sums = rows.groupBy("component", "population").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    x, y = sums.alias("x"), sums.alias("y")
    both = x.join(y, (F.col("x.component") == F.col("y.component")) & (F.col("x.population") < F.col("y.population")))
    n, s, ss = (F.col(f"x.{c}") + F.col(f"y.{c}") for c in ("n", "s", "ss"))
    between = F.col("x.s") ** 2 / F.col("x.n") + F.col("y.s") ** 2 / F.col("y.n") - s**2 / n
    within = ss - F.col("x.s") ** 2 / F.col("x.n") - F.col("y.s") ** 2 / F.col("y.n")
    found = both.select(F.col("x.component").alias("component"), F.col("x.population").alias("p"), F.col("y.population").alias("q"), (n - 2).alias("within_df"), (between / F.nullif(within / F.nullif(n - 2, F.lit(0)), F.lit(0.0))).alias("f"))
    return found.withColumn("p_value", f_tails("f", F.lit(1), "within_df"))


def population_chi2(anova: DataFrame) -> DataFrame:
    """The F of each pair of populations summed over the components, as a chi-square with as many degrees of freedom."""
    sums = anova.groupBy("p", "q").agg(F.sum("f").alias("chi2"), F.count("f").alias("df"))
    return sums.withColumn("p_value", chi2_tails("chi2", "df"))


def specified(people: DataFrame, columns: Iterable[int], pasted: str) -> DataFrame:
    """People (col, name) that are ticked by column, or the first word of whose name occurs in the pasted text."""
    first = F.split("name", r"\s+")[0]
    return people.where(F.col("col").isin(list(columns)) | F.contains(F.lit(pasted), first))


def population_faults(population: DataFrame, table: DataFrame, other: DataFrame) -> DataFrame:
    """One row: how many individuals (ind) of a population the table lacks, and how many another population has too."""
    chosen = population.select("ind").distinct()
    outside = chosen.join(table.select("ind").distinct(), "ind", "left_anti").agg(F.count("*").alias("outside"))
    return outside.crossJoin(chosen.join(other.select("ind").distinct(), "ind", "left_semi").agg(F.count("*").alias("shared")))  # one row each
