"""Operators along a chromosome: sampling, runs of high scores, admixture paths, orders and ranks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import prefix
from .prefix import CHUNK, by_position, carried, numbered, within
from .shuffles import mark


def uniform_sample(sites: DataFrame, genome_length: int, wanted: int, width: int = CHUNK) -> DataFrame:
    """(site, chrom, pos): about ``wanted`` sites at even spacing.

    Walking a chromosome and taking a site whenever it has reached the next mark (marks grow by the spacing with each site
    taken) has a closed form: with the t-th site in window f = floor(pos / spacing), t + min(0, least f - t' + 1 for t' <= t)
    sites are taken so far; a site is taken where that grows, which is where the least value has not fallen with it.
    """
    space = max(1, genome_length // wanted)
    along = within(["chrom"], "pos", "site")
    rows = sites.select("site", "chrom", "pos").withColumn("chunk", by_position(width))
    rows = rows.withColumn("t", F.row_number().over(along)).withColumn("slack", F.floor(F.col("pos") / space) + 1 - F.col("t"))
    rows = rows.withColumn("least", F.min("slack").over(along))
    n = F.coalesce("n", F.lit(0))
    rows = carried(rows, ["chrom"], {"n": F.count("*"), "low": F.min("slack")}, {"n": F.sum}, {"lowest": (F.col("low_") - n, F.min)})
    rows = rows.withColumn("now", F.least(F.lit(0), F.col("least") - n, "lowest"))
    # k = t + now, and k before = t - 1 + now before; now is 0 in front of the first site
    past = Window.partitionBy("chrom", "chunk").orderBy("pos", "site")
    before = F.coalesce(F.lag("now").over(past), F.least(F.lit(0), "lowest"))
    return rows.withColumn("before", before).where(F.col("now") + 1 > F.col("before")).select("site", "chrom", "pos")


def thin(rows: DataFrame, order: list[str], wanted: int) -> DataFrame:
    """At most ``wanted`` of the rows, at even ranks: each row of rank r (from 0) for which some i has ceil(i * n / wanted + n / wanted / 2) - 1 = r."""
    n = rows.count()
    if n <= wanted:
        return rows
    step = n / wanted
    marks = rows.sparkSession.range(wanted).select((F.ceil(F.col("id") * step + step / 2) - 1).cast("long").alias("r")).distinct()
    return numbered(rows, "r", *[F.asc(c) for c in order]).join(marks, "r", "left_semi").drop("r")


def score_shift(runs: DataFrame, percentile: float) -> DataFrame:
    """The order statistic that is subtracted from all scores."""
    return runs.agg(F.expr(f"percentile_disc({percentile}) WITHIN GROUP (ORDER BY score)").cast(runs.schema["score"].dataType).alias("shift"))


def best_run(runs: DataFrame, shift: int, width: int = CHUNK) -> DataFrame:
    """Of each chromosome, the contiguous run with the largest sum of score - shift; ties to the first, and then shortest."""
    along = within(["chrom"], "pos")
    rows = runs.select("chrom", "pos", (F.col("score") - shift).alias("x")).withColumn("chunk", by_position(width)).withColumn("upto", F.sum("x").over(along))
    rows = rows.withColumn("least", F.min(F.struct((F.col("upto") - F.col("x")).alias("low"), F.col("pos").alias("start"))).over(along))
    carry = F.coalesce("total_before", F.lit(0))
    lifted = lambda c, by: F.struct((F.col(f"{c}.low") + by).alias("low"), F.col(f"{c}.start").alias("start"))
    rows = carried(rows, ["chrom"], {"total_before": F.sum("x"), "own": F.min("least")}, {"total_before": F.sum}, {"least_before": (lifted("own_", carry), F.min)})
    lows = F.least(lifted("least", carry), F.col("least_before"))
    rows = rows.withColumn("from", lows).withColumn("total", F.col("upto") + carry - F.col("from.low"))
    best = rows.groupBy("chrom").agg(F.max(F.struct("total", (-F.col("pos")).alias("minus_end"), (-F.col("from.start")).alias("minus_start"))).alias("b"))
    return best.where("b.total > 0").select("chrom", (-F.col("b.minus_start")).alias("start"), (1 - F.col("b.minus_end")).alias("end"), F.col("b.total").alias("score"))


def maximal_segments(x: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring runs (Ruzzo and Tompa): first and last index, and sum."""
    stack: list[list] = []  # first, last, sum before, sum after
    total = 0
    for i, v in enumerate(x.tolist()):
        if v > 0:
            new = [i, i, total, total + v]
            while True:
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= new[2]:
                    j -= 1
                if j < 0 or stack[j][3] >= new[3]:
                    break
                new = [stack[j][0], i, stack[j][2], new[3]]
                del stack[j:]
            stack.append(new)
        total += v
    return [(a, b, hi - lo) for a, b, lo, hi in stack]


def max_runs(runs: DataFrame, shift: int, width: int = CHUNK) -> DataFrame:
    """All maximal runs of score - shift of each chromosome; only stretches around positive scores reach the scan.

    A stretch is cut wherever the sum since the last cut falls to zero or below: no maximal run crosses such a place. The
    cuts are found by windows, so that a group is one excursion above zero and not a chromosome.
    """
    along = within(["chrom"], "pos")
    rows = runs.select("chrom", "pos", (F.col("score") - shift).alias("x")).withColumn("chunk", by_position(width)).withColumn("upto", F.sum("x").over(along))
    rows = rows.withColumn("least", F.min("upto").over(along))
    carry = F.coalesce("total_before", F.lit(0))
    rows = carried(rows, ["chrom"], {"total_before": F.sum("x"), "low": F.min("upto")}, {"total_before": F.sum}, {"least_before": (F.col("low_") + carry, F.min)})
    upto, least = F.col("upto") + carry, F.least(F.col("least") + carry, F.col("least_before"))
    rows = rows.select("chrom", "chunk", "pos", "x", F.when(upto <= F.least(F.lit(0), least), F.col("pos")).alias("cut"))
    rows = carried(rows.withColumn("last", F.max("cut").over(along)), ["chrom"], {"last_before": F.max("cut")}, {"last_before": F.max})
    rows = rows.where("cut IS NULL").withColumn("stretch", F.coalesce("last", "last_before"))

    def scan(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("pos")
        pos = t["pos"].to_numpy()
        found = maximal_segments(t["x"].to_numpy())
        return pd.DataFrame([(key[0], int(pos[a]), int(pos[b]) + 1, int(s)) for a, b, s in found], columns=["chrom", "start", "end", "score"])

    return rows.groupBy("chrom", "stretch").applyInPandas(scan, "chrom long, start long, end long, score long")


def shuffled_threshold(runs: DataFrame, shift: int, shuffles: int, seed: int = 1, digits: int = 2) -> DataFrame:
    """Largest run over ``shuffles`` random permutations of each chromosome's scores; runs above it are significant.

    Marks are hexadecimal digests, so the first ``digits`` of them cut each permutation into 16^digits even chunks.
    """
    rows = runs.select("chrom", "pos", (F.col("score") - shift).alias("x"), F.explode(F.sequence(F.lit(1), F.lit(shuffles))).alias("shuffle"))
    rows = rows.withColumn("mark", mark(seed, "shuffle", "chrom", "pos")).withColumn("chunk", F.substring("mark", 1, digits))
    keys = ["shuffle", "chrom"]
    along = within(keys, "mark", "pos")
    # of each chunk: its sum, its least running sum before a row, and its own largest run; a run across chunks ends at the largest running sum
    rows = rows.withColumn("upto", F.sum("x").over(along)).withColumn("low", F.min(F.col("upto") - F.col("x")).over(along))
    chunk = rows.groupBy(*keys, "chunk").agg(F.sum("x").alias("sum"), F.min("low").alias("low"), F.max("upto").alias("high"), F.max(F.col("upto") - F.col("low")).alias("own"))
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunk = chunk.withColumn("carry", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).withColumn("lowest", F.min(F.col("low") + F.col("carry")).over(earlier))
    across = F.col("high") + F.col("carry") - F.col("lowest")
    return chunk.groupBy("shuffle").agg(F.max(F.greatest(F.lit(0), "own", across)).alias("largest"))


def significant_runs(runs: DataFrame, shift: int, shuffles: int) -> DataFrame:
    bound = shuffled_threshold(runs, shift, shuffles).agg(F.max("largest").alias("bound"))
    return max_runs(runs, shift).join(F.broadcast(bound), F.col("score") > F.col("bound")).drop("bound")  # bound: one row


def ranked(rows: DataFrame, value: Column, method: str = "dense") -> DataFrame:
    """Rows with ``rank``, the largest value first."""
    return prefix.ranked(rows, "rank", method, (value, True))


def significant(value: Column, digits: int) -> Column:
    """Rounded to significant digits."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(value))))
    return F.when(value == 0, 0.0).otherwise(F.round(value * scale) / scale)


def parse_order(text: str) -> list[tuple[int, int]]:
    """``5,6-12,20`` as first and last numbers; ranges may fall."""
    out = []
    for part in filter(None, (x.strip() for x in text.split(","))):
        first, _, last = part.partition("-")
        if not first.isdigit() or last and not last.isdigit():
            raise ValueError(f"not a row number or range: {part}")
        out.append((int(first), int(last or first)))
    return out


def reorder(rows: DataFrame, number: str, order: str) -> DataFrame:
    """Rows with ``place``: those listed first, in the order of the list (first mention counts), then the others as they were."""
    spark = rows.sparkSession
    listed = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(parse_order(order))] or [(0, 0, -1)][:0], "i long, a long, b long")
    numbers = listed.select("i", F.posexplode(F.sequence("a", "b")).alias("j", "n")).groupBy("n").agg(F.min(F.struct("i", "j")).alias("at"))
    numbers = numbers.select("n", F.row_number().over(Window.orderBy("at")).alias("new"))
    joined = rows.join(numbers, F.col(number) == F.col("n"), "left")
    return joined.withColumn("place", F.coalesce(F.col("new").cast("long"), F.col(number) + (1 << 32))).drop("n", "new")


