"""Operators against plain loops."""

import itertools
import random

import numpy as np
import pytest

from lociframe.functions import tails, text_rules
from lociframe.functions.nucleotides import consensus, genotype_from_digits, reverse_complement
from lociframe.operators import admixture, fst, graphs, mating, ordered, pairs, shuffles, sites
from pyspark.sql import functions as F


def test_uniform_sample_equals_the_walk(spark):
    rng = random.Random(1)
    rows = [(i, c, rng.randrange(20_000)) for i, c in enumerate(rng.choices(range(3), k=300))]
    got = {r["site"] for r in ordered.uniform_sample(spark.createDataFrame(rows, "site long, chrom long, pos long"), 60_000, 40).collect()}
    want = set()
    for chrom in range(3):
        mark = 0
        for site, _, pos in sorted((r for r in rows if r[1] == chrom), key=lambda r: (r[2], r[0])):
            if pos >= mark:
                want.add(site)
                mark += 60_000 // 40
    assert got == want


def brute_segments(x):
    """Maximal runs by their recursive definition: the best one, then left and right of it."""
    if not len(x) or max(x) <= 0:
        return []
    best = max(((sum(x[a:b]), -(b - a), -a) for a in range(len(x)) for b in range(a + 1, len(x) + 1)))
    a, b = -best[2], -best[2] - best[1]
    return brute_segments(x[:a]) + [(a, b)] + [(b + i, b + j) for i, j in brute_segments(x[b:])]


def test_maximal_segments():
    rng = random.Random(2)
    for _ in range(200):
        x = [rng.choice([-7, -3, -1, 2, 3, 5]) + rng.random() / 1000 for _ in range(rng.randrange(12))]
        assert [(a, b + 1) for a, b, _ in ordered.maximal_segments(np.array(x))] == brute_segments(x)


def test_max_runs_by_stretches(spark):
    rng = random.Random(3)
    rows = [(c, p, rng.choice([-5, -2, 0, 1, 4])) for c in range(3) for p in range(60)]
    got = {(r["chrom"], r["start"], r["end"], r["score"]) for r in ordered.max_runs(spark.createDataFrame(rows, "chrom long, pos long, score long"), 0).collect()}
    want = set()
    for c in range(3):
        x = np.array([s for k, _, s in rows if k == c])
        want |= {(c, a, b + 1, int(s)) for a, b, s in ordered.maximal_segments(x)}
    assert got == want


def test_best_path_is_best():
    rng = np.random.default_rng(4)
    for _ in range(20):
        s = rng.normal(size=(7, 3))
        value = lambda path, s=s: sum(s[i, k] for i, k in enumerate(path)) - 0.7 * sum(a != b for a, b in itertools.pairwise(path))
        best = max(value(p) for p in itertools.product(range(3), repeat=7))
        assert abs(value(admixture.best_path(s, 0.7)) - best) < 1e-9


def test_tails():
    low, high = tails.hypergeometric(2, 10, 4, 5)
    assert abs(low - 31 / 42) < 1e-9 and abs(high - 31 / 42) < 1e-9
    low, high = tails.binomial(1, 3, 0.5)
    assert abs(low - 0.5) < 1e-9 and abs(high - 0.875) < 1e-9
    assert tails.binomial(0, 3, 0.0) == (1.0, 1.0)


def test_order_parsing_and_reordering(spark):
    assert ordered.parse_order("5,6-8,3-1") == [(5, 5), (6, 8), (3, 1)]
    with pytest.raises(ValueError, match="not a row number"):
        ordered.parse_order("4,x")
    rows = spark.createDataFrame([(i,) for i in range(1, 7)], "n long")
    got = [r["n"] for r in ordered.reorder(rows.withColumnRenamed("n", "row"), "row", "5,3-2,5").withColumnRenamed("row", "n").orderBy("place").collect()]
    assert got == [5, 3, 2, 1, 4, 6]


def test_thin_keeps_even_ranks(spark):
    rows = spark.range(10)
    assert ordered.thin(rows, ["id"], 4).count() == 4
    assert ordered.thin(rows, ["id"], 20).count() == 10


def test_wright_bounds_and_symmetry(spark):
    rng = random.Random(5)
    rows = [(s, 0, s * 10, i, rng.randrange(9), rng.randrange(9), 50, rng.choice([-1, 0, 1, 2])) for s in range(60) for i in range(8)]
    calls = spark.createDataFrame(rows, "site long, chrom long, pos long, ind long, a long, b long, q long, g long")
    one, two = (fst.site_fst(calls, *p).orderBy("site").toPandas() for p in (((0, 1), (2, 3)), ((2, 3), (0, 1))))
    assert ((one.fst >= 0) & (one.fst <= 1)).all() and np.allclose(one.fst, two.fst)
    d = pairs.pair_distance(calls)
    assert d.count() == 28 and d.where("distance < 0 OR distance > 1").isEmpty()
    assert sites.filter_spacing(calls.select("site", "chrom", "pos").distinct(), 25).count() == 20


def test_components_bipartition_and_assignment(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges = [(u, v) for u, v in edges if u != v]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    got = {r["node"]: r["component"] for r in graphs.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == label
    with pytest.raises(ValueError, match="bipartite"):
        graphs.bipartition(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "u long, v long"))
    weights = [[round(rng.random(), 3) for _ in range(4)] for _ in range(4)]
    best = max(sum(weights[i][p[i]] for i in range(4)) for p in itertools.permutations(range(4)))
    table = spark.createDataFrame([(i, 10 + j, weights[i][j]) for i in range(4) for j in range(4)], "mother long, father long, weight double")
    assert abs(mating.optimal_assignment(table).agg(F.sum("weight")).first()[0] - best) < 1e-9


def test_kinship_of_sibs(spark):
    ped = spark.createDataFrame([(1, None, None), (2, None, None), (3, 1, 2), (4, 1, 2), (5, 3, 4)], "id long, p1 long, p2 long")
    phi = {(r["a"], r["b"]): r["value"] for r in graphs.kinship(ped).collect()}
    assert phi[1, 3] == phi[3, 4] == 0.25 and phi[5, 5] == 0.625 and phi[1, 2] == 0 and len(phi) == 15


def test_nucleotides(spark):
    row = spark.range(1).select(consensus(F.lit("T"), F.lit("A")), consensus(F.lit("A"), F.lit("N")), reverse_complement(F.lit("ACGTMN")), genotype_from_digits(F.lit("00")), genotype_from_digits(F.lit("12"))).first()
    assert list(row) == ["W", "A", "NKACGT", -1, 1]


def test_empty_tables(spark):
    calls = spark.createDataFrame([], "site long, chrom long, pos long, ind long, a long, b long, q long, g long")
    assert fst.site_fst(calls, (0,), (1,)).isEmpty()
    assert pairs.king(calls).isEmpty()
    assert sites.filter_coverage_share(calls, (0,), 0.1, 0.9).isEmpty()
    assert graphs.components(spark.createDataFrame([], "u long, v long")).isEmpty()


def test_rules_on_text():
    assert [text_rules.bound(x) for x in ("7", "0", "15%", "100%")] == [7, 0, -15, -100]
    for bad in ("x", "-1", "101%", "%"):
        with pytest.raises(ValueError, match="integer|negative|above"):
            text_rules.bound(bad)
    assert text_rules.class_columns("c1, C3", 3) == [0, 2]
    for bad in ("1", "c0", "c4", "cx"):
        with pytest.raises(ValueError, match="column"):
            text_rules.class_columns(bad, 3)


def test_tails_have_their_closed_forms():
    for x in (0.2, 3.0, 40.0):
        assert abs(tails.chi2_tail(x, 2) - np.exp(-x / 2)) < 1e-12
        assert abs(tails.f_tail(x, 2, 8) - (1 + x / 4) ** -4) < 1e-12
    assert tails.f_tail(0, 1, 5) == tails.chi2_tail(0, 3) == 1.0


def test_permutations(spark):
    rows = shuffles.permutations(spark, 6, 40).collect()
    orders = {}
    for r in rows:
        orders.setdefault(r["shuffle"], []).append((r["place"], r["item"]))
    orders = [tuple(i for _, i in sorted(v)) for v in orders.values()]
    assert len(orders) == 40 and all(sorted(o) == list(range(6)) for o in orders) and len(set(orders)) > 30


def test_eigenvalues_of_the_covariance(spark, small):
    from lociframe.plans.views import calls
    from lociframe.registry import QUERIES

    g = {}
    for r in calls(spark, small).where("g >= 0").collect():
        g.setdefault(r["site"], {})[r["ind"]] = r["g"]
    x = []
    for v in g.values():
        s = sum(v.values())
        if len(v) == 8 and min(s, 16 - s) >= 2:
            p = (1 + s) / 18
            x.append([(v[i] - s / 8) / np.sqrt(p * (1 - p)) for i in range(8)])
    values = np.linalg.svd(np.array(x).reshape(-1, 8), compute_uv=False) ** 2 if x else np.zeros(0)
    values = np.r_[values, np.zeros(8 - len(values))]
    want = values * 7 / values.sum() if values.sum() else values
    got = [r["eigenvalue"] for r in QUERIES["pca_eigen"](spark, small).orderBy("component").collect()]
    assert np.allclose(got, want, atol=2e-6)


def test_assignment_report(spark):
    pairs = spark.createDataFrame([(1, 5, 0.5), (0, 4, 0.25)], "mother long, father long, weight double")
    random = spark.createDataFrame([(0, 0.2), (1, 0.3)], "shuffle long, mean_weight double")
    assert [r["value"] for r in mating.assignment_report(pairs, random).collect()] == ["0 4 0.250000", "1 5 0.500000", "mean of best pairs: 0.375000", "mean of random pairs: 0.250000"]


def test_principal_points(spark):
    from lociframe.operators import pairs

    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 6)) * np.array([9, 1, 1, 4, 1, 1])
    m = x.T @ x
    products = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(6) for j in range(6)], "i long, j long, product double")
    got = pairs.principal_points(products, 6)
    for axis, value in enumerate(sorted(np.linalg.eigvalsh(m))[::-1][:2], 1):
        v = np.array([c for _, a, c in got if a == axis])
        assert np.allclose(m @ v, value * v) and abs(v @ v - 1) < 1e-9 and v[np.abs(v).argmax()] > 0
