"""Source divergence against brute force."""

import random
import re
from collections import Counter

import duckdb
from helpers import TEXTS, clashing, documents
from pyspark.sql import functions as F

from lociframe.llm import divergence, registry

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def brute(rows, top=200):
    """rows: (text, lang, source)."""
    groups, docs = {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        groups.setdefault((lang, source), Counter()).update(terms)
        docs.setdefault(lang, Counter()).update(set(terms))
    found = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        mine = {s: c for (x, s), c in groups.items() if x == lang}

        def p(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        whole = p(sum(mine.values(), Counter()))
        ps = {s: p(c) for s, c in mine.items()}
        for s in mine:
            pairs = [(-sum((ps[s][t] - ps[o][t]) ** 2 // ps[o][t] for t in kept), o.encode()) for o in mine if o != s]
            terms = [(-((ps[s][t] - whole[t]) ** 2 // whole[t]), t.encode()) for t in kept if mine[s][t] > 0 and ps[s][t] > whole[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(found)


def told(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_random_tables(spark):
    r = random.Random(2)
    words = [f"{a}{b}" for a in ("the", "Of", "ñá", "漢", "x", " ") for b in ("", "ab", "É", "q", "z")]
    rows = []
    for _ in range(300):
        lang = r.choice(["en", "en", "en", "de", None, ""])
        source = r.choice(["hot", "hot", "hot", "a", "b", "é", None, "c"])
        rows.append((None if r.random() < 0.1 else r.choice([" ", "-", "1", "\t"]).join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=r.randint(0, 30))), lang, source))
    rows += [("lonely words here", "xx", "one"), ("other words", "xx", "two"), ("same same same", "yy", "only")] + [("", "zz", s) for s in "abc"]
    docs = spark.createDataFrame([(k % 90, *x, 0) for k, x in enumerate(rows)], documents(spark).schema.fieldNames() and "doc_id long, text string, lang string, source string, n_chars long")
    want = brute(rows)
    assert {x[0] for x in want if x[2] == "pair" and x[4] == 0} >= {"xx", "zz"}
    assert told(divergence.audit(clashing(docs))) == want
    assert told(divergence.audit(docs, top=3)) == brute(rows, 3)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert told(divergence.audit(docs)) == brute(rows)
    assert told(divergence.audit(docs.union(docs).union(docs))) == brute(rows * 3)
    assert told(divergence.audit(documents(spark, []))) == []


def test_counts_pass_flushes(spark, monkeypatch):
    """Counts of tasks that emit often, and of texts cut into windows, are the same."""
    import pyarrow as pa

    texts = ["a b c d e f g", "a a a b", None and "", "c c x y z"]
    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for t in texts]), pa.array(["l"] * 4), pa.array(["s", "s", "t", "t"])], ["text", "lang", "source"])

    def totals():
        found = {}
        for b in divergence._counted(iter([batch, batch])):
            for *key, n, docs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                a = found.setdefault(tuple(key), [0, 0])
                a[0] += n
                a[1] += docs
        return found

    want = totals()
    assert want["l", "s", b"a".decode()] == [8, 4]
    monkeypatch.setattr(divergence, "HELD", 2)
    monkeypatch.setattr(divergence, "windows", lambda t: __import__("lociframe.llm.windows", fromlist=["windows"]).windows(t, 2))
    assert totals() == want


def test_large_counts_stay_exact(spark):
    rows = spark.createDataFrame([(9 * 10**18, 9 * 10**18, 7), (10**11, 3 * 10**11, 1000)], "n long, total long, v long")
    got = [r[0] for r in rows.select(divergence._p(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 1) // (t + v) for n, t, v in [(9 * 10**18, 9 * 10**18, 7), (10**11, 3 * 10**11, 1000)]]


def test_query_and_sql(spark, small):
    got = told(registry.QUERIES["op12_source_divergence"](spark, small))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    found = con.sql(registry.SQL["op12_source_divergence"])
    at = [found.columns.index(c) for c in COLUMNS]
    assert sorted(tuple(r[i] for i in at) for r in found.fetchall()) == got
    assert got == brute([(r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()])
