"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from helpers import TEXTS, clashing, documents

from lociframe.llm import registry, variants

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    forms, links = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        links[w] = len(others)
        forms[w] = best if best and n[best] >= 2 * n[w] else None
    found = []
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        found.append((w, forms[w], root, n[w], links[w], n[forms[w]] if forms[w] else None))
    return sorted(found)


def told(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_random_texts(spark):
    r = random.Random(3)
    letters = "aabÀéÿx"
    vocabulary = ["".join(r.choices(letters, k=r.randint(4, 7))) for _ in range(250)] + ["aaaaa", "aaaaaa", "aaaaaaa", "baaaa", "abaaa", "Straße", "STRASSE"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(None if k % 50 == 9 else k % 170, r.choice([" ", "-", "7", "\n"]).join(x.upper() if r.random() < 0.1 else x for x in r.choices(vocabulary, weights, k=60))) for k in range(200)]
    want = brute(docs)
    assert len(want) > 100 and any(f for _, f, *_ in want) and any(f and f != root for _, f, root, *_ in want)
    assert told(variants.variants(clashing(documents(spark, docs)))) == want


def test_odd_rows_and_long_words(spark):
    long = "ab" * 20_000
    docs = [*TEXTS, *[(100 + k, f"{long} {long}x {long[1:]} planets planet planéts x" * 2) for k in range(4)], (200, ("hottest " * 500 + "hotest ") * 30)]
    assert told(variants.variants(documents(spark, docs))) == brute(docs)
    assert told(variants.variants(documents(spark, []))) == [] == told(variants.variants(documents(spark, [(1, None), (2, "")])))


def test_collisions_part_on_strings(spark):
    """Where all rows collide, strings alone decide."""
    r = random.Random(4)
    docs = [(k, " ".join("".join(r.choices("abc", k=5)) for _ in range(40))) for k in range(40)]
    words = variants.word_counts(documents(spark, docs))
    everything = words.selectExpr("wid", "explode(sequence(-1, length(word) - 1)) AS place")
    rows = lambda df: sorted(tuple(x) for x in df.select("word", "n_near", "form", "form_n").collect())
    assert rows(variants.near_words(words, everything)) == rows(variants.near_words(words, variants.candidates(words))) != []
    for bits in (0, 1, 5):
        assert variants.candidates(words, bits).count() == variants.candidates(words).count()


def test_keys_are_polynomials_of_what_is_left():
    words = ["planet", "planes", "aaaaaa", "ÀÿzÀÿz"]
    keys = variants.deletion_keys(words)
    shorter = {w: variants.deletion_keys([w])[0, -1] for x in words for i in range(6) for w in [x[:i] + x[i + 1 :]]}
    for row, w in zip(keys, words, strict=True):
        assert [shorter[w[:i] + w[i + 1 :]] for i in range(6)] == row[:6].tolist()
    r = random.Random(8)
    made = list({"".join(r.choices("abcdefgh", k=9)) for _ in range(20_000)})
    assert len(np.unique(variants.deletion_keys(made)[:, -1])) == len(made)


def test_batches_keep_groups_whole():
    import pyarrow as pa

    keys = [1, 2, 2, 2, 2, 3, 4, 4, 5]
    for size in (1, 2, 3, 9):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size], pa.int64()), pa.array(list(range(i, min(i + size, 9))))], ["key", "at"]) for i in range(0, 9, size)]
        assert [x for b in variants._beside_equal(iter(batches)) for x in b.column(1).to_pylist()] == [1, 2, 3, 4, 6, 7]


def test_query_and_sql(spark, small):
    got = told(registry.QUERIES["op11_spelling_variants"](spark, small))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    found = con.sql(registry.SQL["op11_spelling_variants"])
    at = [found.columns.index(c) for c in COLUMNS]
    assert sorted(tuple(r[i] for i in at) for r in found.fetchall()) == got
    assert got == brute([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()])
