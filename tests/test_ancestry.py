"""Ancestry proportions against plain loops, and the bootstrap against drawn sites."""

import math

import numpy as np

from lociframe.operators import ancestry, pairs, resampling


def made(spark, seed=1, sites=240, individuals=10, missing=0.1):
    """Genotypes of two ancestral populations and mixtures of them."""
    rng = np.random.default_rng(seed)
    f = np.vstack([rng.uniform(0.05, 0.35, sites), rng.uniform(0.65, 0.95, sites)])
    q = np.linspace(0, 1, individuals)
    g = rng.binomial(2, q[:, None] * f[1] + (1 - q)[:, None] * f[0])
    g[rng.random(g.shape) < missing] = -1
    g[:, 5] = -1  # nobody has a call
    calls = spark.createDataFrame([(j, j % 4, j, i * 3 + 1, 1, 1, 30, int(g[i, j])) for i in range(individuals) for j in range(sites)], "site long, chrom long, pos long, ind long, a long, b long, q long, g long")
    return calls, g, q


def looped(g, q, rounds, inner):
    n, sites = g.shape
    k = q.shape[1]

    def frequencies(q):
        f = np.zeros((k, sites))
        for j in range(sites):
            seen = [i for i in range(n) if g[i, j] >= 0]
            x = [(1 + sum(g[i, j] for i in seen)) / (2 + 2 * len(seen))] * k
            for _ in range(inner):
                up, down = [0.0] * k, [0.0] * k
                for i in seen:
                    p = sum(q[i, a] * x[a] for a in range(k))
                    for a in range(k):
                        up[a] += g[i, j] * q[i, a] * x[a] / p
                        down[a] += (2 - g[i, j]) * q[i, a] * (1 - x[a]) / (1 - p)
                x = [min(1 - 1e-5, max(1e-5, u / (u + d))) if u + d else y for u, d, y in zip(up, down, x, strict=True)]
            f[:, j] = x
        return f

    for _ in range(rounds):
        f, new = frequencies(q), np.zeros_like(q)
        for i in range(n):
            seen = [j for j in range(sites) if g[i, j] >= 0]
            for j in seen:
                p = q[i] @ f[:, j]
                new[i] += g[i, j] * q[i] * f[:, j] / p + (2 - g[i, j]) * q[i] * (1 - f[:, j]) / (1 - p)
            new[i] /= 2 * len(seen)
        q = new
    return q, frequencies(q)


def test_shares_equal_loops(spark):
    calls, g, _ = made(spark, sites=60, individuals=6)
    individuals = [3 * i + 1 for i in range(6)]
    want, f = looped(g, ancestry.first_shares(individuals, 3), 4, 3)
    shares = ancestry.ancestry_shares(calls, 3, 4, 3)
    got = {(r["ind"], r["population"]): r["share"] for r in shares.collect()}
    assert all(abs(got[i, a + 1] - want[n, a]) < 1e-9 for n, i in enumerate(individuals) for a in range(3)) and len(got) == 18
    freqs = {(r["site"], r["population"]): r["frequency"] for r in ancestry.ancestral_frequencies(calls, shares, 3).collect()}
    assert len(freqs) == 59 * 3 and all(abs(x - f[a - 1, j]) < 1e-9 for (j, a), x in freqs.items())


def test_shares_find_the_mixture_and_likelihood_rises(spark):
    calls, g, truth = made(spark)
    table = ancestry.genotypes(calls)
    model, seen, last = ancestry.Model(ancestry.first_shares(table.individuals, 2)), g >= 0, -math.inf
    for _ in range(5):
        ancestry.fit(table, [model], 4)
        p = model.q @ ancestry.frequencies(model.q, g, seen, 50)
        likelihood = (np.where(seen, g, 0) * np.log(p) + np.where(seen, 2 - g, 0) * np.log(1 - p)).sum()
        assert likelihood > last
        last = likelihood
    ancestry.fit(table, [model], 60, tolerance=1e-4)
    found = model.q[:, 0] if model.q[-1, 0] > 0.5 else model.q[:, 1]
    assert np.abs(found - truth).max() < 0.12


def test_cross_validation_prefers_the_true_number(spark):
    calls, g, _ = made(spark, sites=250, individuals=40)
    rows = {r["k"]: r for r in ancestry.ancestry_cross_validation(calls, [1, 2, 4], 5, 25).collect()}
    assert rows[2]["error"] < rows[1]["error"] and rows[2]["error"] < rows[4]["error"]
    assert all(r["masked"] == (g >= 0).sum() for r in rows.values())


def test_ancestry_of_nothing(spark):
    calls, _, _ = made(spark, sites=8)
    assert ancestry.ancestry_shares(calls.where("g = 5"), 2, 2).isEmpty()
    assert ancestry.ancestry_cross_validation(calls.where("g = 5"), [1, 2], 3, 1).where("error IS NOT NULL").isEmpty()
    only = ancestry.ancestry_shares(calls.where("ind = 1"), 2, 2).collect()
    assert len(only) == 2 and abs(sum(r["share"] for r in only) - 1) < 1e-9


def test_bootstrap(spark):
    calls, g, _ = made(spark, sites=300, individuals=4)
    for metric in ("reads", "genotypes"):
        got = {(r["replicate"], r["i"], r["j"]): (r["distance"], r["informative"]) for r in resampling.distance_bootstrap(calls, 30, metric).collect()}
        w = resampling.weights(np.arange(300), np.arange(1, 31))
        for r in range(30):
            for x in range(4):
                for y in range(x + 1, 4):
                    both = np.ones(300, bool) if metric == "reads" else (g[x] >= 0) & (g[y] >= 0)
                    n = w[r][both].sum()
                    total = 0.0 if metric == "reads" else (w[r][both] * np.abs(g[x] - g[y])[both]).sum()
                    assert got[r + 1, 3 * x + 1, 3 * y + 1][1] == n and abs(got[r + 1, 3 * x + 1, 3 * y + 1][0] - total / n) < 1e-9
    spread = {(r["i"], r["j"]): r for r in resampling.bootstrap_spread(resampling.distance_bootstrap(calls, 200, "genotypes")).collect()}
    whole = {(r["i"], r["j"]): r["distance"] for r in pairs.pair_distance(calls, "genotypes").collect()}
    for key, r in spread.items():
        assert abs(r["mean"] - whole[key]) < 4 * r["deviation"] / math.sqrt(200) and r["low"] < whole[key] < r["high"]
    assert resampling.distance_bootstrap(calls.limit(0), 5).isEmpty()


def test_weights_are_poisson():
    w = resampling.weights(np.arange(20_000), np.arange(1, 41))
    assert abs(w.mean() - 1) < 0.005 and abs(w.var() - 1) < 0.01
    for n in range(5):
        assert abs((w == n).mean() - math.exp(-1) / math.factorial(n)) < 0.004
    assert abs(np.corrcoef(w)[np.triu_indices(40, 1)]).max() < 0.04
    assert abs(np.corrcoef(w[:, :-1].ravel(), w[:, 1:].ravel())[0, 1]) < 0.01
