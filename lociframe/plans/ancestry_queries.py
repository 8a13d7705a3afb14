"""Queries of ancestry proportions and of the bootstrap. Their SQL writes each round of EM out as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import ancestry, resampling
from .catalog import query
from .site_queries import WITH, rounded
from .views import calls

ROUNDS, INNER, FOLDS, REPLICATES = 4, 3, 5, 40


def em_sql(name: str, k: int, rounds: int, inner: int, folds: int = 0) -> str:
    """Tables ``{name}q{rounds}`` (fold, ind, q1, ...) and ``{name}f`` (fold, site, f1, ...), over ``calls``; with folds, each without its masked genotypes."""
    each = range(1, k + 1)
    fold = "('0x' || substr(md5('1:' || site || ':' || ind), 1, 8))::BIGINT % " + str(folds)
    held = f"SELECT fold, site, ind, g::DOUBLE AS g FROM calls, (SELECT unnest(range({folds})) AS fold) WHERE g >= 0 AND {fold} <> fold" if folds else "SELECT -1 AS fold, site, ind, g::DOUBLE AS g FROM calls WHERE g >= 0"
    weight = lambda a: f"(500 + (ind * 7919 + {a} * 104729 + 13) % 1000)"
    whole = " + ".join(weight(a) for a in each)
    inds = f"(SELECT DISTINCT fold, ind FROM calls, (SELECT unnest(range({folds})) AS fold) WHERE g >= 0)" if folds else "(SELECT DISTINCT -1 AS fold, ind FROM calls WHERE g >= 0)"
    out = [f"{name}g AS MATERIALIZED ({held})", f"{name}q0 AS MATERIALIZED (SELECT fold, ind, {', '.join(f'{weight(a)} / ({whole})::DOUBLE AS q{a}' for a in each)} FROM {inds})"]
    out.append(f"{name}p AS MATERIALIZED (SELECT fold, site, (1 + sum(g)) / (2 + 2 * count(*)) AS f FROM {name}g GROUP BY 1, 2)")
    p = "(" + " + ".join(f"q{a} * f{a}" for a in each) + ")"

    def f_steps(r: int) -> str:
        last = f"(SELECT fold, site, {', '.join(f'f AS f{a}' for a in each)} FROM {name}p)"
        for t in range(1, inner + 1):
            up = lambda a: f"(f{a} * sum(g * q{a} / p))"
            down = lambda a: f"((1 - f{a}) * sum((2 - g) * q{a} / (1 - p)))"
            cells = ", ".join(f"greatest(1e-5, least(1 - 1e-5, {up(a)} / ({up(a)} + {down(a)}))) AS f{a}" for a in each)
            shares, freqs = ", ".join(f"q{a}" for a in each), ", ".join(f"f{a}" for a in each)
            out.append(f"{name}f{r}_{t} AS MATERIALIZED (SELECT fold, site, {cells} FROM (SELECT g.fold, g.site, g, {shares}, {freqs}, {p} AS p FROM {name}g g JOIN {name}q{r} q ON q.fold = g.fold AND q.ind = g.ind JOIN {last} f ON f.fold = g.fold AND f.site = g.site) GROUP BY fold, site, {freqs})")
            last = f"{name}f{r}_{t}"
        return last

    for r in range(rounds):
        last = f_steps(r)
        draws = lambda a: f"sum(g * q{a} * f{a} / {p} + (2 - g) * q{a} * (1 - f{a}) / (1 - {p}))"
        out.append(f"{name}q{r + 1} AS MATERIALIZED (SELECT g.fold, g.ind, {', '.join(f'{draws(a)} / (2 * count(*)) AS q{a}' for a in each)} FROM {name}g g JOIN {name}q{r} q ON q.fold = g.fold AND q.ind = g.ind JOIN {last} f ON f.fold = g.fold AND f.site = g.site GROUP BY 1, 2)")
    out.append(f"{name}f AS (SELECT * FROM {f_steps(rounds)})")
    return ", ".join(out)


def error_sql(k: int) -> str:
    """Sum and number of the deviances of masked genotypes, with the tables of ``em_sql(f"k{k}_", k, ...)``; a site without seen genotypes has the frequency a half."""
    mean = "2 * (" + " + ".join(f"q{a} * coalesce(f{a}, 0.5)" for a in range(1, k + 1)) + ")"
    fold = f"('0x' || substr(md5('1:' || c.site || ':' || c.ind), 1, 8))::BIGINT % {FOLDS}"
    part = lambda n, m: f"CASE WHEN {n} > 0 THEN {n} * ln({n} / {m}) ELSE 0 END"
    return f"""SELECT {k}::BIGINT AS k, round(sum({part('g', 'mean')} + {part('(2 - g)', '(2 - mean)')}) / count(*), 6) AS error, count(*) AS masked
        FROM (SELECT c.g::DOUBLE AS g, {mean} AS mean FROM calls c JOIN k{k}_q{ROUNDS} q ON q.ind = c.ind AND q.fold = {fold} LEFT JOIN k{k}_f f ON f.site = c.site AND f.fold = q.fold WHERE c.g >= 0)"""


@query(f"{WITH}, {em_sql('em', 2, ROUNDS, INNER)} SELECT ind, population::BIGINT AS population, round(CASE population WHEN 1 THEN q1 ELSE q2 END, 6) AS share FROM emq{ROUNDS}, (VALUES (1), (2)) v(population)")
def ancestry_em(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ancestry.ancestry_shares(calls(spark, d), 2, ROUNDS, INNER), "share")


@query(f"{WITH}, {em_sql('em', 2, ROUNDS, INNER)} SELECT site, population::BIGINT AS population, round(CASE population WHEN 1 THEN f1 ELSE f2 END, 6) AS frequency FROM emf, (VALUES (1), (2)) v(population)")
def ancestry_frequencies(spark: SparkSession, d: str) -> DataFrame:
    table = calls(spark, d)
    return rounded(ancestry.ancestral_frequencies(table, ancestry.ancestry_shares(table, 2, ROUNDS, INNER), INNER), "frequency")


@query(f"{WITH}, {', '.join(em_sql(f'k{k}_', k, ROUNDS, INNER, FOLDS) for k in (1, 2, 3))} {' UNION ALL '.join(error_sql(k) for k in (1, 2, 3))}")
def ancestry_cv(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ancestry.ancestry_cross_validation(calls(spark, d), [1, 2, 3], FOLDS, ROUNDS, INNER), "error")


PRIME = resampling.PRIME
DRAWN = f"""h1 AS (SELECT site, r, (site % {PRIME} * 48271 + r * 1103515245 + 12345) % {PRIME} AS x FROM (SELECT DISTINCT site FROM calls), (SELECT unnest(range(1, {REPLICATES + 1})) AS r)),
    h2 AS (SELECT site, r, (x * x % {PRIME} + 7 * x + 3) % {PRIME} AS x FROM h1), h3 AS (SELECT site, r, (x * x % {PRIME} * 48271 + x) % {PRIME} AS x FROM h2),
    drawn AS (SELECT site, r, {' + '.join(f'(x >= {s})::BIGINT' for s in resampling.poisson_steps())} AS w FROM h3),
    v AS (SELECT site, ind, a / (a + b)::DOUBLE AS f FROM calls WHERE a + b >= 1),
    replicates AS (SELECT r AS replicate, x.ind AS i, y.ind AS j, sum(w * abs(x.f - y.f)) / sum(w) AS distance, sum(w)::BIGINT AS informative
        FROM v x JOIN v y ON x.site = y.site AND x.ind < y.ind JOIN drawn d ON d.site = x.site WHERE w > 0 GROUP BY 1, 2, 3)"""


@query(f"{WITH}, {DRAWN} SELECT replicate, i, j, round(distance, 6) AS distance, informative FROM replicates")
def distance_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    return rounded(resampling.distance_bootstrap(calls(spark, d), REPLICATES), "distance")


@query(f"""{WITH}, {DRAWN} SELECT i, j, round(avg(distance), 6) AS mean, round(stddev_samp(distance), 6) AS deviation, round(quantile_disc(distance, 0.025), 6) AS low, round(quantile_disc(distance, 0.975), 6) AS high
    FROM replicates GROUP BY 1, 2""")
def distance_bootstrap_spread(spark: SparkSession, d: str) -> DataFrame:
    return rounded(resampling.bootstrap_spread(resampling.distance_bootstrap(calls(spark, d), REPLICATES)), "mean", "deviation", "low", "high")
