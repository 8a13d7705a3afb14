"""Operators in chunks give what one walk along the chromosome gives, whatever the chunks."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.operators import admixture, ordered, prefix, sites


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def scored(spark):
    r = random.Random(1)
    rows = [(c, p, r.choice([-9, -3, -1, 0, 1, 2, 8])) for c in range(3) for p in sorted(r.sample(range(1000 * (c + 1)), 150))] + [(7, 5, -1), (8, 1000, 4)]
    return rows, spark.createDataFrame(rows, "chrom long, pos long, score long")


@pytest.mark.parametrize("width", [1, 7, 60, 1 << 20])
def test_runs(scored, width):
    rows, df = scored
    best, maximal = [], []
    for c in {c for c, _, _ in rows}:
        mine = [(p, s) for x, p, s in rows if x == c]
        top = max(((sum(s for _, s in mine[i : j + 1]), -mine[j][0], -mine[i][0]) for i in range(len(mine)) for j in range(i, len(mine))))
        best += [(c, -top[2], 1 - top[1], top[0])] if top[0] > 0 else []
        maximal += [(c, mine[a][0], mine[b][0] + 1, s) for a, b, s in ordered.maximal_segments(np.array([s for _, s in mine]))]
    assert found(ordered.best_run(df, 0, width)) == sorted(best, key=repr)
    assert found(ordered.max_runs(df, 0, width)) == sorted(maximal, key=repr)


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_shuffled_threshold(scored, digits):
    rows, df = scored
    want = []
    for k in (1, 2, 3):
        most = 0
        for c in {c for c, _, _ in rows}:
            mine = sorted((hashlib.md5(f"1:{k}:{c}:{p}".encode()).hexdigest(), p, s) for x, p, s in rows if x == c)
            total = 0
            for *_, s in mine:
                total = max(0, total + s)
                most = max(most, total)
        want.append((k, most))
    assert found(ordered.shuffled_threshold(df, 0, 3, digits=digits)) == want
    bound = max(m for _, m in want)
    assert found(ordered.significant_runs(df, 0, 3)) == [x for x in found(ordered.max_runs(df, 0)) if x[3] > bound]


@pytest.mark.parametrize("width", [3, 50, 1 << 20])
def test_spacing_and_sampling(spark, width):
    r = random.Random(2)
    rows = [(i, c, p) for i, (c, p) in enumerate((c, p) for c in (1, 2, 5) for p in sorted(r.choices(range(700), k=120)) + ([4000, 4001] if c == 2 else []))]
    df = spark.createDataFrame(rows, "site long, chrom long, pos long")
    for spacing in (0, 1, 13, 90, 2000):
        want, last = [], {}
        for i, c, p in rows:
            if c not in last or p - last[c] >= spacing:
                want.append((i, c, p))
                last[c] = p
        assert found(sites.filter_spacing(df, spacing, width)) == sorted(want, key=repr), spacing
    for length, wanted in ((2000, 30), (2000, 500), (100, 5)):
        space, want = max(1, length // wanted), []
        for c in (1, 2, 5):
            mark = 0
            for i, x, p in rows:
                if x == c and p >= mark:
                    want.append((i, c, p))
                    mark += space
        assert found(ordered.uniform_sample(df, length, wanted, width)) == sorted(want, key=repr), (length, wanted)


@pytest.mark.parametrize("width", [4, 37, 1 << 20])
def test_admixture_path(spark, width):
    r = random.Random(3)
    rows, want = [], []
    spans = [(1, 40, 95), (2, 0, 30), (3, 0, 1000)]
    for c in (1, 2, 3, 4):
        for ind in (4, 5):
            lean, mine = 0, []
            for p in sorted(r.sample(range(220), 90)):
                lean = r.randrange(3) if r.random() < 0.1 else lean
                mine.append((p, [float(r.choice([-3, -2, -1, 0]) + 2 * (k == lean)) for k in range(3)]))
            rows += [(c, p, ind, *s) for p, s in mine]
            dark = [any(x == c and a <= p <= b for x, a, b in spans) for p, _ in mine]
            light = [s for (_, s), d in zip(mine, dark, strict=True) if not d]
            states = iter(admixture.best_path(np.array(light), 2.0).tolist() if light else [])
            told = [0 if d else next(states) + 1 for d in dark]
            at = [i for i in range(len(told)) if not i or told[i] != told[i - 1]]
            want += [(c, ind, mine[i][0], mine[j - 1][0] + 1, told[i]) for i, j in zip(at, [*at[1:], len(told)], strict=True)]
    df = spark.createDataFrame(rows, "chrom long, pos long, ind long, s1 double, s2 double, s3 double")
    dark = spark.createDataFrame(spans, "chrom long, start long, end long")
    assert found(admixture.admixture_path(df, 2.0, dark, width)) == sorted(want, key=repr)
    assert admixture.admixture_path(df.limit(0), 2.0).isEmpty()



def test_admixture_path_of_tying_states(spark):
    """Sums of tenths tie but for their last digits; these must be those of adding site by site, wherever chunks begin."""
    r = random.Random(5)
    rows, want = [], []
    for c in range(12):
        scores = np.array([[-r.randrange(1, 12) / 10 for _ in range(3)] for _ in range(150)])
        path = (admixture.best_path(scores, 0.5) + 1).tolist()
        rows += [(c, p, 4, *s) for p, s in enumerate(scores.tolist())]
        at = [i for i in range(150) if not i or path[i] != path[i - 1]]
        want += [(c, 4, i, j, path[i]) for i, j in zip(at, [*at[1:], 150], strict=True)]
    df = spark.createDataFrame(rows, "chrom long, pos long, ind long, s1 double, s2 double, s3 double")
    assert found(admixture.admixture_path(df, 0.5, width=7)) == sorted(want, key=repr)

def test_ranks_and_numbers(spark):
    r = random.Random(4)
    values = [r.choice([None, 5, 5, 5, 1, 2, 9]) for _ in range(300)] + [7] * 300
    df = spark.createDataFrame(list(enumerate(values)), "k long, v long")
    falling = sorted({v for v in values if v is not None}, reverse=True)
    dense = {v: i + 1 for i, v in enumerate(falling)} | {None: len(falling) + 1}
    standard = {v: 1 + sum(x is not None and (v is None or x > v) for x in values) for v in set(values)}
    for method, want in (("dense", dense), ("standard", standard)):
        assert found(ordered.ranked(df, F.col("v"), method).select("k", "rank")) == sorted([(k, want[v]) for k, v in enumerate(values)], key=repr)
    rising = sorted(range(600), key=lambda k: (values[k] is not None, values[k] or 0, -k))
    got = prefix.numbered(df, "n", F.asc("v"), F.desc("k"))
    assert [k for _, k in sorted((x["n"], x["k"]) for x in got.collect())] == rising
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString().split("Window")[0]
    kept = sorted(x["k"] for x in ordered.thin(df, ["k"], 7).collect())
    assert kept == sorted({int(np.ceil(i * 600 / 7 + 600 / 14)) - 1 for i in range(7)})
    assert ordered.ranked(df.limit(0), F.col("v")).isEmpty() and prefix.numbered(df.limit(0), "n", F.asc("k")).isEmpty()


def test_a_planted_run_is_significant(spark):
    rows = [(c, p, 6 if c == 1 and 200 <= p < 240 else (-7, -2, 1, 3)[(p * 7919 + c) % 4]) for c in (0, 1) for p in range(400)]
    df = spark.createDataFrame(rows, "chrom long, pos long, score long")
    got = found(ordered.significant_runs(df, 0, 3))
    bound = max(m for _, m in found(ordered.shuffled_threshold(df, 0, 3)))
    assert len(got) == 1 and got[0][0] == 1 and got[0][1] <= 200 and got[0][2] >= 240 and got[0][3] > bound > 0
    assert len(found(ordered.max_runs(df, 0))) > 1
