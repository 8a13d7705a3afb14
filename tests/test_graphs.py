"""Paths from many origins, inbreeding from ancestors, and nested bins, against plain searches."""

import random
from collections import deque

from pyspark.sql import functions as F

from lociframe.operators import enrichment, graphs, sequences


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_paths_from_more_origins_than_bits(spark):
    r = random.Random(1)
    edges = sorted({(p, r.randrange(150), r.randrange(150)) for p in "ab" for _ in range(220)} | {("c", 1, 1), ("c", 1, 2)})
    origins = [(p, n) for p in "ab" for n in range(0, 150, 1 if p == "a" else 40)] + [("c", 1), ("c", 77)]
    want = []
    for p, o in origins:
        out, queue = {o: 0}, deque([o])
        while queue:
            x = queue.popleft()
            for q, a, b in edges:
                if q == p and a == x and b not in out:
                    out[b] = out[x] + 1
                    queue.append(b)
        want += [(p, o, n, d) for n, d in out.items()]
    e, o = spark.createDataFrame(edges, "pathway string, src long, dst long"), spark.createDataFrame(origins, "pathway string, node long")
    assert found(graphs.shortest_paths(e, o)) == sorted(want, key=repr)
    assert graphs.shortest_paths(e, o.limit(0)).isEmpty()
    roles = o.withColumn("role", F.lit("source")).union(spark.createDataFrame([(p, n, "sink") for p in "ab" for n in range(5, 150, 7)], "pathway string, node long, role string"))
    ends = [(p, d) for p, _, n, d in want if p in "ab" and n % 7 == 5]
    got = {r["pathway"]: (r["paths"], r["mean_length"]) for r in graphs.path_statistics(e, roles).collect()}
    for p in "ab":
        mine = [d for q, d in ends if q == p]
        assert got[p][0] == len(mine) and abs(got[p][1] - sum(mine) / len(mine)) < 1e-12
    assert set(got) == {"a", "b"}


def test_blocks_of_pairs_are_shuffled_once(spark):
    """A block of people is one row on each side of the product, however many other blocks it meets, and each pair comes once."""
    ped = spark.createDataFrame([(i, None, None) for i in range(5)] + [(i, i % 5, i // 2) for i in range(5, 600)], "id long, p1 long, p2 long")
    pairs = graphs.pedigree_values(ped, graphs.unrelated(ped), 0.5, people=20)
    assert pairs.count() == 600 * 601 // 2 == pairs.select("a", "b").distinct().count()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan  # no row for each two blocks
    assert graphs.DEALT ** 2 <= 10_000


def test_inbreeding_equals_kinship_of_parents(spark):
    r = random.Random(2)
    ped = [(i, None, None) for i in range(6)] + [(i, *r.sample(range(max(0, i - 9), i), 2)) for i in range(6, 60)]
    ped += [(60, 58, 58), (61, 60, 60)]  # selfing
    phi = {}
    for i, p, q in ped:
        for j, *_ in ped[:i]:
            phi[i, j] = phi[j, i] = 0.0 if p is None else (phi[p, j] + phi[q, j]) / 2
        phi[i, i] = 0.5 if p is None else 0.5 + phi[p, q] / 2
    df = spark.createDataFrame(ped, "id long, p1 long, p2 long")
    got = {r["id"]: r["inbreeding"] for r in graphs.inbreeding(df).collect()}
    assert len(got) == 62 and all(abs(got[i] - (0.0 if p is None else phi[p, q])) < 1e-9 for i, p, q in ped)
    assert max(got.values()) > 0.5 and graphs.inbreeding(df.limit(0)).isEmpty()



def test_values_of_pairs_are_not_stored(spark, monkeypatch):
    """All pairs against the recursion, and their means; no stage on the way has as many rows as there are pairs."""
    r = random.Random(7)
    ped = [(i, None, None) for i in range(5)] + [(i, r.randrange(5), i // 2) for i in range(5, 240)] + [(240, 239, 239), (241, 240, 3)]
    given = {(a, b): (a + b) % 3 / 4 for a in range(5) for b in range(5)}
    df = spark.createDataFrame(ped, "id long, p1 long, p2 long").repartition(3)
    founders = spark.createDataFrame([(a, b, v) for (a, b), v in given.items()], "a long, b long, value double")
    rows, stored = [], graphs.stored
    monkeypatch.setattr(graphs, "stored", lambda x: (y := stored(x), rows.append(y.count()))[0])
    for own, start in ((0.0, given), (0.5, {(a, a): 0.5 for a in range(5)})):
        v = dict(start)
        for i, p, q in ped:
            for j, *_ in ped[:i] if p is not None else ():
                v[i, j] = v[j, i] = (v.get((p, j), 0.0) + v.get((q, j), 0.0)) / 2
            if p is not None:
                v[i, i] = own + v.get((p, q), 0.0) / 2
        got = {(x["a"], x["b"]): x["value"] for x in (graphs.kinship(df) if own else graphs.pedigree_values(df, founders, own, people=50)).collect()}
        assert len(got) == 242 * 243 // 2 and all(a <= b and abs(x - v.get((a, b), 0.0)) < 1e-12 for (a, b), x in got.items())
    means = {x["id"]: x["mean"] for x in graphs.mean_kinship(df).collect()}
    assert len(means) == 242 and all(abs(means[i] - sum(v.get((i, j), 0.0) for j in range(242)) / 242) < 1e-12 for i in means)
    assert max(rows) < 242 * 243 // 8
    assert graphs.kinship(df.limit(0)).isEmpty() and graphs.mean_kinship(df.limit(0)).isEmpty()

def test_nested_bins(spark):
    r = random.Random(3)
    spans = [(k, k % 2, a, a + r.choice([0, 5, 63, 64, 700, 5000, 60_000, 1_000_000])) for k, a in enumerate(r.choices(range(300_000), k=120))] + [(500, 0, 10, 9), (501, 1, 0, 3_000_000)]
    sites = [(i, i % 2, p) for i, p in enumerate(r.choices(range(1_400_000), k=400))]
    s, p = spark.createDataFrame(spans, "name long, chrom long, start long, end long"), spark.createDataFrame(sites, "site long, chrom long, pos long")
    want = sorted((n, i) for i, c, x in sites for n, d, a, b in spans if c == d and a <= x <= b)
    for width in (1, 16, 4096):
        assert sorted((r["name"], r["site"]) for r in sequences.in_spans(p, s, width).collect()) == want, width
    bins = sequences.in_bins(s.where("start <= end"), 16)
    assert bins.groupBy("name", "level").count().agg(F.max("count")).first()[0] < 2 * sequences.FAN
    covered = bins.withColumn("size", F.lit(16) * F.pow(F.lit(16), "level")).groupBy("name", "start", "end").agg(F.sum("size").alias("covered"))
    assert covered.where("covered < end - start + 1 OR covered > end - start + 1 + 2 * 16").isEmpty()
    assert sequences.in_spans(p, s.limit(0)).isEmpty()


def test_cooccurrence_of_a_hot_gene(spark):
    r = random.Random(4)
    rows = [("hot", f"c{i}") for i in range(60)] + [("warm", f"c{i * 2}") for i in range(20)] + [(f"g{k}", f"c{r.randrange(60)}") for k in range(40) for _ in range(4)]
    by, want = {}, {}
    for g, c in rows:
        by.setdefault(g, set()).add(c)
    for cats in by.values():
        for x in cats:
            for y in cats:
                if x < y:
                    want[x, y] = want.get((x, y), 0) + 1
    df = spark.createDataFrame(rows, "gene string, cat string")
    for block in (3, 19, 256):
        assert {(x["c1"], x["c2"]): x["weight"] for x in enrichment.cooccurrence(df, block).collect()} == want


def test_cooccurrence_counts_sets_of_genes(spark, monkeypatch):
    """Genes that share most categories are counted 64 at a time; the pairs that are made are far fewer than the genes' own."""
    r = random.Random(8)
    rows = [(g, f"c{c}") for g in range(200) for c in r.sample(range(30), 24)] + [(g, f"d{g}-{i}") for g in range(200, 330) for i in range(3)]
    want = {}
    for g in range(330):
        cats = sorted(c for h, c in rows if h == g)
        for i, x in enumerate(cats):
            for y in cats[i + 1 :]:
                want[x, y] = want.get((x, y), 0) + 1
    one, made = enrichment.gene_pairs, []
    monkeypatch.setattr(enrichment, "gene_pairs", lambda *a: (y := one(*a), made.append(y.count()))[0])
    got = enrichment.cooccurrence(spark.createDataFrame(rows, "gene long, cat string")).collect()
    assert {(x["c1"], x["c2"]): x["weight"] for x in got} == want
    assert made[0] < 200 * 24 * 23 // 2 // 4
    assert enrichment.cooccurrence(spark.createDataFrame([], "gene long, cat string")).isEmpty()
