"""Admixture: the source populations of the segments of admixed chromosomes.

States are numbered by the populations of the two copies of a chromosome: 1 to k both from one population; then one from each
of two, in order (of three populations: 4 is first and second, 5 first and third, 6 second and third); 0 is heterochromatin.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import stored
from .prefix import CHUNK, by_position
from .sequences import in_spans


def admixture_states(calls: DataFrame, admixed: Iterable[int], *populations: Iterable[int] | None, add_logs: bool = True) -> DataFrame:
    """(chrom, pos, ind, s1, s2, ...): (log-)likelihood of each admixed genotype under every state.

    Allele frequencies come from genotypes with one pseudo-copy of either allele. A population that is None is the reference
    sequence: one individual with two copies of allele 1.
    """
    defined = F.col("g") >= 0

    def frequency(p: Iterable[int] | None):
        if p is None:
            return F.lit(0.75)
        mine = F.col("ind").isin(list(p)) & defined
        return (F.sum(F.when(mine, F.col("g")).otherwise(0)) + 1) / (F.sum(F.when(mine, 2).otherwise(0)) + 2)

    everyone = F.collect_list(F.when(F.col("ind").isin(list(admixed)) & defined, F.struct("ind", "g")))
    held = calls.groupBy("site", "chrom", "pos").agg(*[frequency(p).alias(f"f{i}") for i, p in enumerate(populations)], everyone.alias("v"))
    rows = held.select("chrom", "pos", *[f"f{i}" for i in range(len(populations))], F.inline("v"))
    both = lambda s, t: F.when(F.col("g") == 2, s * t).when(F.col("g") == 0, (1 - s) * (1 - t)).otherwise(s * (1 - t) + t * (1 - s))
    pairs = [(i, i) for i in range(len(populations))] + list(combinations(range(len(populations)), 2))
    value = F.log if add_logs else lambda x: x
    return rows.select("chrom", "pos", "ind", *[value(both(F.col(f"f{i}"), F.col(f"f{j}"))).alias(f"s{n}") for n, (i, j) in enumerate(pairs, 1)])


def forward(scores: np.ndarray, penalty: float, best: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best sums at the last row by state, and for each row the state before it. ``best``: sums in front of the first row; None: nothing is there. Ties keep the state, and then the lower one."""
    n, k = scores.shape
    back = np.zeros((n, k), "int64")
    for i in range(n):
        if best is None:
            best, back[i] = scores[0].copy(), np.arange(k)
            continue
        move = best.max() - penalty
        back[i] = np.where(best >= move, np.arange(k), int(best.argmax()))
        best = np.maximum(best, move) + scores[i]
    return best, back


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """States (0, 1, ...) with the largest sum of scores less ``penalty`` per change."""
    best, back = forward(scores, penalty)
    state = np.zeros(len(scores), "int64")
    state[-1] = best.argmax()
    for i in range(len(scores) - 1, 0, -1):
        state[i - 1] = back[i, state[i]]
    return state


def _intervals(pos: np.ndarray, state: np.ndarray) -> list[dict]:
    first = np.flatnonzero(np.r_[True, state[1:] != state[:-1]])
    last = np.r_[first[1:], len(state)] - 1
    return [{"start": int(pos[a]), "end": int(pos[b]) + 1, "state": int(state[a])} for a, b in zip(first, last, strict=True)]


INTERVALS = "array<struct<start: long, end: long, state: long>>"


def admixture_path(states: DataFrame, penalty: float, heterochromatin: DataFrame | None = None, width: int = CHUNK) -> DataFrame:
    """Intervals of constant state of each individual and chromosome. Sites in ``heterochromatin`` (chrom, start, end) have state 0.

    1. One pass along each individual's chromosome, a batch of rows at a time, notes the best sums (k numbers) in front of each chunk of ``width`` positions. Sums are
    added site by site: in any other order they would differ in their last digits, and states that tie would be told apart by where chunks begin.
    2. With these, a chunk finds its best path for each state it may end in: where that begins, and its intervals. No group holds more than a chunk.
    3. From the best last state the chunks' ends are followed back, each chunk gives the intervals of its path, and intervals that meet at a border in one state are joined.
    """
    names = [c for c in states.columns if c[0] == "s" and c[1:].isdigit()]
    k = len(names)
    if heterochromatin is None:
        rows = states.withColumn("dark", F.lit(False))
    else:
        dark = in_spans(states.select("chrom", "pos").distinct(), heterochromatin).select("chrom", "pos", F.lit(True).alias("in_dark")).distinct()
        rows = states.join(dark, ["chrom", "pos"], "left").withColumn("dark", F.coalesce("in_dark", F.lit(False)))
    rows = stored(rows.select("chrom", "ind", "pos", "dark", *names).withColumn("chunk", by_position(width)))
    keys = "chrom long, ind long, chunk long"

    def fronts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in order of chromosome, individual and position -> the sums in front of each chunk."""
        last, best = (), None
        for t in batches:
            scores, dark, out = t[names].to_numpy(), t["dark"].to_numpy(bool), []
            at = t[["chrom", "ind", "chunk"]].to_numpy()
            cuts = np.r_[0, np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1, len(at)] if len(at) else [0]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                here = tuple(at[i].tolist())
                if here[:2] != last[:2]:
                    best = None
                if here != last:
                    out.append((*here, None if best is None else best.tolist()))
                last, best = here, forward(scores[i:j][~dark[i:j]], penalty, best)[0]
            yield pd.DataFrame(out, columns=["chrom", "ind", "chunk", "best"])

    def paths(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("pos")
        pos, open_, best = t["pos"].to_numpy(), ~t["dark"].to_numpy(bool), t["best"].iloc[0]
        end, back = forward(t.loc[open_, names].to_numpy(), penalty, None if best is None else np.asarray(best)) if open_.any() else (None, np.zeros((0, k), "int64"))
        path = np.zeros((len(back) + 1, k), "int64")  # for each state at the end, the states from the one in front of the chunk on
        path[-1] = np.arange(k)
        for i in range(len(back) - 1, -1, -1):
            path[i] = back[i, path[i + 1]]
        out = []
        for b in range(k):
            state = np.zeros(len(pos), "int64")
            state[open_] = path[1:, b] + 1
            out.append((*key, b, int(path[0, b]), None if end is None else float(end[b]), _intervals(pos, state)))
        return pd.DataFrame(out, columns=["chrom", "ind", "chunk", "last", "first", "total", "intervals"])

    def follow_back(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        chunks, ends, state = sorted(t["chunk"].unique(), reverse=True), [], None
        maps = {c: p.sort_values("last") for c, p in t.groupby("chunk")}
        for c in chunks:
            totals = maps[c]["total"].to_numpy(float)
            if state is None and not np.isnan(totals).all():
                state = int(totals.argmax())  # the last chunk with an open site
            ends.append((*key, c, state or 0))
            if state is not None:
                state = int(maps[c]["first"].iloc[state])
        return pd.DataFrame(ends, columns=["chrom", "ind", "chunk", "last"])

    ahead = rows.repartition("chrom", "ind").sortWithinPartitions("chrom", "ind", "pos").mapInPandas(fronts, f"{keys}, best array<double>")
    found = rows.join(ahead, ["chrom", "ind", "chunk"]).groupBy("chrom", "ind", "chunk").applyInPandas(paths, f"{keys}, last long, first long, total double, intervals {INTERVALS}")
    found = stored(found)
    ends = found.drop("intervals").groupBy("chrom", "ind").applyInPandas(follow_back, f"{keys}, last long")
    return _joined(found.join(ends, ["chrom", "ind", "chunk", "last"]).select("chrom", "ind", "chunk", "intervals"))


def _joined(chunks: DataFrame) -> DataFrame:
    """(chrom, ind, chunk, intervals) -> intervals, those that meet at a border in one state made one.

    Inner intervals stay as they are. Only a chunk's first and last one, or the only one, are put in order by individual and chromosome.
    """
    rows = chunks.select("chrom", "ind", "chunk", F.size("intervals").alias("n"), F.posexplode("intervals").alias("at", "v")).select("chrom", "ind", "chunk", "n", "at", "v.*")
    edge = (F.col("at") == 0) | (F.col("at") == F.col("n") - 1)
    along = Window.partitionBy("chrom", "ind").orderBy("start")
    before, chunk_before = F.lag("state").over(along), F.lag("chunk").over(along)
    turns = rows.where(edge).withColumn("new", F.when((before == F.col("state")) & (chunk_before != F.col("chunk")), 0).otherwise(1))
    merged = turns.withColumn("part", F.sum("new").over(along)).groupBy("chrom", "ind", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("state").alias("state"))
    return rows.where(~edge).select("chrom", "ind", "start", "end", "state").union(merged.select("chrom", "ind", "start", "end", "state"))


def extended(path: DataFrame, lengths: DataFrame) -> DataFrame:
    """The path with its last interval reaching to the end of the chromosome; lengths: (chrom, length)."""
    last = F.row_number().over(Window.partitionBy("chrom", "ind").orderBy(F.desc("start"))) == 1
    joined = path.withColumn("last", last).join(lengths, "chrom", "left")
    return joined.withColumn("end", F.when(F.col("last"), F.greatest("end", "length")).otherwise(F.col("end"))).select(*path.columns)


def state_shares(path: DataFrame) -> DataFrame:
    """Percent of the covered genome in each state, per individual."""
    sums = path.groupBy("ind", "state").agg(F.sum(F.col("end") - F.col("start")).alias("length"))
    whole = F.sum("length").over(Window.partitionBy("ind"))
    return sums.select("ind", "state", (100 * F.col("length") / whole).alias("percent"))


def karyotype_rows(path: DataFrame, lengths: DataFrame) -> DataFrame:
    """What a karyotype is drawn from: (ind, chrom, left, right, state), ends as shares of the longest chromosome; (chrom, length) may lack chromosomes, which then end with the path."""
    reach = path.groupBy("chrom").agg(F.max("end").alias("reach")).join(lengths, "chrom", "full_outer").select("chrom", F.greatest("reach", "length").alias("length"))
    longest = reach.agg(F.max("length").alias("longest"))  # one row
    at = lambda c: (F.col(c) / F.col("longest"))
    return path.join(F.broadcast(longest)).select("ind", "chrom", at("start").alias("left"), at("end").alias("right"), "state")
