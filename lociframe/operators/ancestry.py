"""Ancestry proportions: shares of K ancestral populations in each individual, and K by masked genotypes.

The likelihood is binomial: an individual's genotype at a site is two draws with the probability sum_k q[k] f[k, site]. Shares Q
(individuals x K) are the only state. Frequencies F are a function of them: at each site, from the pooled frequency, ``inner``
steps of EM with Q fixed. So nothing per site is stored or joined between rounds; a round is one pass over the stored genotypes that sums
each individual's expected draws from each population, and the n x K sums make the next Q (an EM step). Tasks sum their sites in NumPy and emit one row per individual and population,
and the driver holds no more than the models' Q.

Several models share a pass: all K that are tried, and all folds of cross-validation. A fold masks the genotypes of which a digest of site and
individual gives its number; masked genotypes are predicted by the model that did not see them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stored
from .shuffles import mark

#: Frequencies stay this far from 0 and 1.
EDGE = 1e-5
INNER = 10
BATCH_SITES = 4096


def fold_of(folds: int, seed: int = 1) -> Column:
    """0 to folds - 1, by a digest of site and individual that every engine can repeat."""
    return F.pmod(F.conv(F.substring(mark(seed, "site", "ind"), 1, 8), 16, 10).cast("long"), F.lit(folds))


def first_shares(individuals: list[int], k: int) -> np.ndarray:
    """Uneven shares to start from, by the individual's number."""
    weights = np.array([[500 + (i * 7919 + (a + 1) * 104_729 + 13) % 1000 for a in range(k)] for i in individuals], float).reshape(len(individuals), k)
    return weights / weights.sum(axis=1, keepdims=True)


@dataclass
class Model:
    q: np.ndarray  # individuals x K
    fold: int = -1  # the masked fold; -1: none


@dataclass
class Genotypes:
    """Stored rows (site, places array, g array, fold array), and the individuals by place."""

    rows: DataFrame
    individuals: list[int]


def genotypes(calls: DataFrame, folds: int = 1) -> Genotypes:
    defined = calls.where("g >= 0")
    individuals = sorted(r["ind"] for r in defined.select("ind").distinct().collect())  # a row per individual
    places = F.create_map(*[F.lit(x) for pair in ((i, n) for n, i in enumerate(individuals)) for x in pair]) if individuals else F.create_map().cast("map<long,int>")
    cell = F.struct(places[F.col("ind")].cast("int").alias("place"), F.col("g").cast("byte").alias("g"), fold_of(folds).cast("int").alias("fold"))
    held = defined.groupBy("site").agg(F.array_sort(F.collect_list(cell)).alias("v"))
    return Genotypes(stored(held.select("site", F.col("v.place").alias("place"), F.col("v.g").alias("g"), F.col("v.fold").alias("fold"))), individuals)


def frequencies(q: np.ndarray, g: np.ndarray, seen: np.ndarray, inner: int) -> np.ndarray:
    """K x sites, for genotypes g and their mask of seen ones (individuals x sites)."""
    ones, twos = np.where(seen, g, 0.0), np.where(seen, 2.0 - g, 0.0)
    f = np.repeat(((1 + ones.sum(axis=0)) / (2 + 2 * seen.sum(axis=0)))[None], q.shape[1], axis=0)
    for _ in range(inner):
        p = q @ f
        a, b = f * (q.T @ (ones / p)), (1 - f) * (q.T @ (twos / (1 - p)))
        f = np.clip(np.where(a + b > 0, a / np.where(a + b > 0, a + b, 1), f), EDGE, 1 - EDGE)
    return f


def draws(q: np.ndarray, f: np.ndarray, g: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Expected draws of each individual from each population, summed over sites."""
    p = q @ f
    return q * ((np.where(seen, g, 0.0) / p) @ f.T + (np.where(seen, 2.0 - g, 0.0) / (1 - p)) @ (1 - f).T)


def deviance(q: np.ndarray, f: np.ndarray, g: np.ndarray, hidden: np.ndarray) -> tuple[float, int]:
    """Of hidden genotypes against their prediction: sum and number."""
    mean = 2 * (q @ f)[hidden]
    x = g[hidden]
    part = lambda n, m: np.where(n > 0, n * np.log(np.where(n > 0, n, 1) / m), 0.0)
    return float((part(x, mean) + part(2 - x, 2 - mean)).sum()), len(x)


def _matrices(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Genotypes and folds, individuals x sites; -1 where there is no call."""
    lengths = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
    place, g, fold = (pc.list_flatten(batch.column(i)).to_numpy(zero_copy_only=False) for i in range(3))
    site = np.repeat(np.arange(batch.num_rows), lengths)
    matrix, folds = np.full((n, batch.num_rows), -1, np.int8), np.full((n, batch.num_rows), -1, np.int32)
    matrix[place, site], folds[place, site] = g, fold
    return matrix, folds


def _summed(table: Genotypes, models: list[Model], inner: int, last: bool) -> dict[int, np.ndarray]:
    """One pass: for each model draws, or, if ``last``, deviance and number of its masked genotypes."""
    n = len(table.individuals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(2 if last else m.q.size) for m in models]
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_SITES):
                g, fold = _matrices(batch.slice(at, BATCH_SITES), n)
                for m, total in zip(models, sums, strict=True):
                    seen = (g >= 0) & (fold != m.fold)
                    f = frequencies(m.q, g, seen, inner)
                    total += deviance(m.q, f, g.astype(float), (g >= 0) & ~seen) if last else draws(m.q, f, g, seen).ravel()
        where = [(i, j) for i, s in enumerate(sums) for j in range(len(s))]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in where], pa.int32()), pa.array([j for _, j in where], pa.int32()), pa.array(np.concatenate(sums))], ["model", "at", "x"])

    found = table.rows.select("place", "g", "fold").mapInArrow(run, "model int, at int, x double").groupBy("model", "at").agg(F.sum("x").alias("x"))
    sums = [np.zeros(2 if last else m.q.size) for m in models]
    for r in found.collect():  # models x individuals x K
        sums[r["model"]][r["at"]] = r["x"]
    return dict(enumerate(sums))


def fit(table: Genotypes, models: list[Model], rounds: int, inner: int = INNER, tolerance: float = 0.0) -> list[Model]:
    """All models after ``rounds`` rounds, or when no share of any moves by more than ``tolerance``."""
    for _ in range(rounds):
        sums, moved = _summed(table, models, inner, False), 0.0
        for i, m in enumerate(models):
            new = sums[i].reshape(m.q.shape)
            whole = new.sum(axis=1, keepdims=True)
            new = np.where(whole > 0, new / np.where(whole > 0, whole, 1), m.q)
            moved, m.q = max(moved, float(np.abs(new - m.q).max(initial=0))), new
        if moved <= tolerance:
            break
    return models


def ancestry_shares(calls: DataFrame, k: int, rounds: int, inner: int = INNER, tolerance: float = 0.0) -> DataFrame:
    """(ind, population, share), populations 1 to k. Individuals without a call are left out."""
    table = genotypes(calls)
    (model,) = fit(table, [Model(first_shares(table.individuals, k))], rounds, inner, tolerance)
    rows = [(int(i), a + 1, float(x)) for i, shares in zip(table.individuals, model.q, strict=True) for a, x in enumerate(shares)]
    return calls.sparkSession.createDataFrame(rows, "ind long, population long, share double")


def ancestral_frequencies(calls: DataFrame, shares: DataFrame, inner: int = INNER) -> DataFrame:
    """(site, population, frequency of allele 1) that belong to shares: a table as long as the sites, which stays on the executors."""
    table = genotypes(calls)
    held = {(r["ind"], r["population"]): r["share"] for r in shares.collect()}  # individuals x K
    k = max((a for _, a in held), default=0)
    q = np.array([[held[i, a + 1] for a in range(k)] for i in table.individuals]).reshape(len(table.individuals), k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_SITES):
                part = batch.slice(at, BATCH_SITES)
                g, _ = _matrices(part, len(q))
                f = frequencies(q, g, g >= 0, inner)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(3).to_numpy(), k)), pa.array(np.tile(np.arange(1, k + 1), part.num_rows)), pa.array(f.T.ravel())], ["site", "population", "frequency"])

    return table.rows.select("place", "g", "fold", F.col("site").cast("long").alias("site")).mapInArrow(run, "site long, population long, frequency double")


def ancestry_cross_validation(calls: DataFrame, ks: list[int], folds: int, rounds: int, inner: int = INNER, tolerance: float = 0.0) -> DataFrame:
    """(k, error, masked): mean deviance of masked genotypes for each number of populations. All models are fitted in the same passes."""
    table = genotypes(calls, folds)
    models = fit(table, [Model(first_shares(table.individuals, k), fold) for k in ks for fold in range(folds)], rounds, inner, tolerance)
    sums = _summed(table, models, inner, True)
    rows = []
    for at, k in enumerate(ks):
        total, number = sum(sums[i] for i in range(at * folds, (at + 1) * folds))
        rows.append((k, float(total / number) if number else None, int(number)))
    return calls.sparkSession.createDataFrame(rows, "k long, error double, masked long")
