"""Assignments of mates: random ones, and the best one by an auction whose rounds are joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import stored
from .shuffles import permutations


def random_assignments(weights: DataFrame, n: int, shuffles: int, seed: int = 1) -> DataFrame:
    """Mean weight of ``shuffles`` random assignments; mothers are 0 to n - 1 and fathers n to 2n - 1."""
    mates = permutations(weights.sparkSession, n, shuffles, seed).select("shuffle", F.col("item").alias("mother"), (F.col("place") + n).cast("long").alias("father"))
    return weights.join(F.broadcast(mates), ["mother", "father"]).groupBy("shuffle").agg(F.avg("weight").alias("mean_weight"))


def assignment_report(pairs: DataFrame, random: DataFrame) -> DataFrame:
    """Lines of text: a line per pair of the best assignment, then its mean and that of random ones."""
    lines = pairs.orderBy("mother").select(F.col("mother").alias("place"), F.format_string("%s %s %.6f", F.col("mother").cast("string"), F.col("father").cast("string"), F.col("weight")).alias("value"))
    best = pairs.agg(F.lit(1 << 40).alias("place"), F.format_string("mean of best pairs: %.6f", F.avg("weight")).alias("value"))
    mean = random.agg(F.lit((1 << 40) + 1).alias("place"), F.format_string("mean of random pairs: %.6f", F.avg("mean_weight")).alias("value"))
    return lines.union(best).union(mean).orderBy("place").select("value")


def optimal_assignment(weights: DataFrame, digits: int = 6) -> DataFrame:
    """(mother, father, weight) of a complete bipartite graph with as many mothers as fathers -> the pairs of the best total.

    Bertsekas' auction: every free mother bids for the father of the largest weight less price, by what it exceeds the second
    best plus a step; each father goes to the highest bid. With whole-number weights (weight times 10 ** digits times n + 1)
    and a step of 1 the result is the optimum. The step begins large and falls, prices being kept, so that rounds are few.
    """
    n = weights.select("mother").distinct().count()
    if weights.count() != n * n or weights.select("father").distinct().count() != n:
        raise ValueError("every mother needs a weight for every father, and as many fathers as mothers")
    w = stored(weights.select("mother", "father", "weight", (F.round(F.col("weight") * 10**digits) * (n + 1)).cast("long").alias("value")))
    prices = stored(w.select("father", F.lit(0).cast("long").alias("price")).distinct())
    top = (w.agg(F.max("value") - F.min("value")).first()[0] or 0) // 4
    steps = [1]
    while steps[-1] * 8 < top:
        steps.append(steps[-1] * 8)
    for step in reversed(steps):
        held = stored(w.select("mother", "father", "weight").limit(0))
        while True:
            free = w.join(held.select("mother"), "mother", "left_anti").join(prices, "father").withColumn("net", F.col("value") - F.col("price"))
            order = Window.partitionBy("mother").orderBy(F.desc("net"), "father")
            best = free.withColumn("r", F.row_number().over(order)).withColumn("second", F.lead("net").over(order)).where("r = 1")
            bids = best.withColumn("bid", F.col("price") + F.col("net") - F.coalesce("second", "net") + step)
            won = bids.withColumn("place", F.row_number().over(Window.partitionBy("father").orderBy(F.desc("bid"), "mother"))).where("place = 1")
            won = stored(won.select("mother", "father", "weight", "bid"))
            if won.isEmpty():
                break
            held = stored(held.join(won.select("father"), "father", "left_anti").select("mother", "father", "weight").union(won.drop("bid")))
            prices = stored(prices.join(won.select("father", "bid"), "father", "left").select("father", F.coalesce("bid", "price").alias("price")))
    return held
