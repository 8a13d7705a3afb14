"""Mixing, sharding, toxicity, quality and personal data, and the pipeline."""

import itertools
import math
import os
import random
import re
import zlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse

import numpy as np
import pytest
import xxhash
from helpers import clashing, documents, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

import corpus_pipeline
from lociframe.llm import mixing, pii, quality, sharding, toxicity


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, capped = dict(sizes), {}
    while True:
        rest = sum(sizes.values()) - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        above = [s for s in share if share[s] > most * left[s]]
        if not above:
            return capped | share
        capped |= {s: most * left[s] for s in above}


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1, "c": 500, None: 40, "d": 3}, {"a": 7}, {"a": 5, "b": 5, "c": 5, "d": 900}):
        table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(0)
    for seats in (1, 7, 100, 12345):
        votes = {i: rng.choice([0, 1, 5, 1000, rng.random() * 50]) for i in range(12)}
        got = {r["i"]: r["quota"] for r in mixing.apportion(spark.createDataFrame([(i, float(v)) for i, v in votes.items()], "i long, v double"), [], ["i"], "v", F.lit(seats)).collect()}
        won = dict.fromkeys(votes, 0)
        for _ in range(seats):
            best = max(votes, key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
            won[best] += 1
        assert got == won


def test_mix(spark):
    docs = clashing(documents(spark))
    got = rows(mixing.mix(mixing.sizes(docs)), "doc_id", "source", "size", "source_size", "target", "taken")
    assert got == rows(mixing.mix(mixing.sizes(docs)), "doc_id", "source", "size", "source_size", "target", "taken") and len(got) == docs.count()
    assert all(0 <= taken <= 3 * size for _, _, size, _, _, taken in got)
    for source in {r[1] for r in got}:
        mine = [r for r in got if r[1] == source]
        assert abs(sum(r[5] for r in mine) - mine[0][4]) <= 16 + 48 * 16
        assert sum(r[2] for r in mine) == mine[0][3]
    assert mixing.mix(mixing.sizes(docs.limit(0))).isEmpty() and mixing.mixed_documents(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_mixed_documents_are_whole(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", broadcast)
    odd = mixing.mixed_documents(clashing(documents(spark)))
    assert odd.columns == clashing(documents(spark)).columns and odd.where("text IS NULL OR text = ''").isEmpty()
    rng = random.Random(3)
    table = {i: " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 60))) for i in range(3000)}
    docs = documents(spark, list(table.items()))
    targets = {r["source"]: (r["target"], r["source_size"]) for r in mixing.mix(mixing.sizes(docs)).collect()}
    mixed = mixing.mixed_documents(docs).collect()
    assert all(r["text"] == table[r["doc_id"]] for r in mixed)
    times, words = {}, dict.fromkeys(targets, 0)
    for r in mixed:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        words[r["source"]] += len(r["text"].split())
    assert max(times.values()) <= 3
    for source, (target, _) in targets.items():
        assert abs(words[source] - target) <= 0.03 * target


def brute_runs(shards, target, fan):
    """The runs that are merged, of (name, bytes)."""
    tiers = {}
    for name, n in sorted(shards):
        if n < target / 2:
            tiers.setdefault(math.floor(math.log(max(n, sharding.BASE_BYTES) / sharding.BASE_BYTES, fan)), []).append((name, n))
    out = []
    for rows in tiers.values():
        runs, at = {}, 0
        for name, n in rows:
            runs.setdefault(at // target, []).append((name, n))
            at += n
        out += [sorted(x for x, _ in r) for r in runs.values() if len(r) >= fan or sum(n for _, n in r) >= target]
    return sorted(out)


def test_shards(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/store", target_bytes=40_000, fan=3)
    rng = random.Random(0)
    docs = clashing(documents(spark, [(i, None if i % 50 == 0 else "".join(rng.choices("abcdefgh é", k=i % 97 if i % 500 else 20_000))) for i in range(1200)] + [(None, "nameless"), (7, "again")]))
    for part in range(4):
        version = store.append(docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(4)) == part).coalesce(2))
        plan, shards = store.plan().collect(), store.manifest().collect()
        runs = {}
        for r in plan:
            runs.setdefault(r["merged"], []).append(r["shard"])
        assert sorted(sorted(r) for r in runs.values()) == brute_runs([(r["shard"], r["bytes"]) for r in shards], 40_000, 3)
        assert sorted(runs) == list(range(len(runs)))
        store.compact()
    found = store.read()
    assert rows(found, *docs.columns) == rows(docs, *docs.columns)
    shards = store.manifest().collect()
    held = {r["shard"]: r["count"] for r in found.groupBy("shard").agg(F.count("*").alias("count")).collect()}
    assert held == {r["shard"]: r["rows"] for r in shards}
    assert all(os.path.getsize(urlparse(r["shard"]).path) == r["bytes"] for r in shards)
    assert not brute_runs([(r["shard"], r["bytes"]) for r in shards], 40_000, 3)
    assert store.manifest(1).count() == 2 and store.read(1).count() == store.manifest(1).agg(F.sum("rows")).first()[0]  # after merges
    with pytest.raises(ValueError, match="columns"):
        store.append(docs.withColumn("Shard", F.lit(1)))
    with pytest.raises(ValueError, match="type"):
        store.append(docs.withColumn("lang", F.lit(1)))
    store.vacuum(retain=2, grace_seconds=0)
    assert rows(store.read(), "doc_id", "text") == rows(docs, "doc_id", "text") and store.read(version).count() > 0


def test_two_writers_lose_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    sharding.ShardStore(spark, root).append(documents(spark, [(0, "first")]))

    def write(k):
        store = sharding.ShardStore(spark, root, fan=2)
        for i in range(3):
            store.append(documents(spark, [(100 * k + i, "x")]))
            store.compact()
            store.vacuum()

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, (1, 2, 3)))
    store = sharding.ShardStore(spark, root)
    assert sorted(r["doc_id"] for r in store.read().collect()) == [0, *(100 * k + i for k in (1, 2, 3) for i in range(3))]
    assert store.versions() == list(range(1, store.versions()[-1] + 1))
    assert not store._publish(store.versions()[-1], "{}")


def test_an_uncommitted_arrival_outlives_compaction(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    store, docs = sharding.ShardStore(spark, root, fan=2), documents(spark, [(i, "x") for i in range(5)])
    docs.write.parquet(f"{root}/data/pending")
    for _ in range(3):
        store.append(docs)
    store.compact()
    store.vacuum()
    assert store.commit(lambda live, version: live.union(store._listed("pending", version))) and store.read().count() == 20


def test_an_empty_store(spark, tmp_path, small):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/store")
    empty = documents(spark, [])
    store.append(empty)
    store.compact()
    assert store.read().isEmpty() and set(empty.columns) <= set(store.read().columns)
    empty.write.parquet(f"{tmp_path}/t/documents.parquet")
    assert sharding.op5_sharding(spark, f"{tmp_path}/t").isEmpty()
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = sharding.op5_sharding(spark, small)
    want = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    assert rows(got, "doc_id", "text_sha256") == rows(want, "doc_id", "text_sha256")


def brute_cosines(vectors, weight, query):
    """Of {term: count} dicts."""
    weigh = lambda v: {t: (1 + math.log(n)) * weight[t] for t, n in v.items()}
    norm = lambda w: math.sqrt(sum(x * x for x in w.values()))
    q = weigh(query)
    rows = [weigh(v) for v in vectors]
    return [sum(x * q.get(t, 0) for t, x in w.items()) / (norm(w) * norm(q)) if w and q else 0.0 for w in rows]


@pytest.mark.parametrize("block", [4, 64])
def test_block_max_search_is_exact(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = random.Random(1)
    terms = np.arange(10, 30, dtype="uint64")
    vectors = [{t: rng.randint(1, 4) for t in sorted(rng.sample(range(20), rng.randint(1, 4)))} for _ in range(400)]
    pairs = [(terms[list(v)], np.array(list(v.values()))) for v in vectors]
    weight, ids = np.linspace(1, 5, 20), np.arange(400)
    index = toxicity.Index.of(pairs, np.array([i % 2 for i in range(400)]), ids, [1, 1], terms, weight)
    for skip in [None] * 60 + list(range(20)):
        query = vectors[skip] if skip is not None else {t: rng.randint(1, 4) for t in sorted(rng.sample(range(20), rng.randint(1, 5)))}
        got = index.nearest(np.array(list(query)), np.array(list(query.values())), 10, skip)
        cosines = {i: c for i, c in enumerate(brute_cosines(vectors, weight, query)) if i != skip and c > 0}
        assert [round(s, 9) for s, _ in got] == [round(c, 9) for c in sorted(cosines.values(), reverse=True)[:10]]
        assert all(abs(cosines[int(index.ids[at])] - s) < 1e-9 and index.labels[at] == index.ids[at] % 2 for s, at in got)


def test_vocabulary_finds_the_terms_of_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choices(["ab", "C", "é", " ", "-", "'", "1", "\n", "Σ", "\x85", "_", ", "], k=40)) for _ in range(500)] + [""]
    terms = np.unique(np.concatenate([toxicity.term_counts(t)[0] for t in texts[:200]]))
    for x, (place, n) in zip(texts, toxicity.Vocabulary(terms).places(texts), strict=True):
        h, c = toxicity.term_counts(x)
        known = np.isin(h, terms)
        assert terms[place].tolist() == h[known].tolist() and n.tolist() == c[known].tolist()


def test_vocabulary_lowers_words_as_texts():
    """Letters whose lower case hangs on what stands around them, marks that stay in words, and white space of all kinds."""
    rng = random.Random(2)
    odd = "aΣςİIıẞßǅΑ'.:·_1²½Ⅷ\u0301\u0345\u00ad\u200b\ufeff \t\x0b\x1c\x85\xa0\u2028\u3000\x00,-中😀"
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 30))) for _ in range(3000)]
    terms = np.unique(np.concatenate([toxicity.term_counts(t)[0] for t in texts[::2]]))
    for x, (place, n) in zip(texts, toxicity.Vocabulary(terms).places(texts), strict=True):
        h, c = toxicity.term_counts(x)
        known = np.isin(h, terms)
        assert terms[place].tolist() == h[known].tolist() and n.tolist() == c[known].tolist()


def test_vocabulary_looks_up_each_word_of_a_slice_once(monkeypatch):
    """However many texts hold it, in whatever case and between whatever marks; slices are bounded, and long words leave nothing behind."""
    looked_up, place = [], toxicity.Vocabulary.place
    monkeypatch.setattr(toxicity.Vocabulary, "place", lambda self, terms: looked_up.append(len(terms)) or place(self, terms))
    words = [f"{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    terms = np.unique(np.concatenate([toxicity.term_counts(w)[0] for w in words[::2]]))
    texts = [" ".join(f"({w}," if i % 2 else w.upper() for w in words) for i in range(2 * toxicity.TEXTS)]
    vocabulary = toxicity.Vocabulary(terms)
    assert [(len(p), n.tolist()) for p, n in vocabulary.places(texts)] == [(50, [1] * 50)] * len(texts)
    assert looked_up == [100, 100]
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 5000)
    assert len(vocabulary.places(["x" * 4000] * 3 + ["y" * 9000, "", "ab aa"])) == 6 and looked_up[2:] == [1, 1, 1, 1, 2]
    assert list(vars(vocabulary)) == ["hashes"]


def test_emphasis_leaves_chance_alone():
    rng = np.random.default_rng(0)
    toxic, other = rng.binomial(1500, 0.01, 100_000), rng.binomial(1500, 0.01, 100_000)
    assert (toxicity.emphasis(toxic, other, 1500, 1500) > 1).mean() < 1e-4
    assert toxicity.emphasis(np.array([0, 100, 0]), np.array([0, 0, 100]), 1500, 1500).round().tolist() == [1, 34, 1]


def test_toxicity_query_equals_brute_force(spark, small):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small}/labels.parquet").where("toxic IS NOT NULL").collect()}
    counts = {i: dict(Counter(re.findall(r"[^\W\d_]+", t.lower()))) for i, t in docs.items()}
    train = sorted(i for i in labels if i in docs and i not in held)
    y = {i: labels[i] for i in train}
    vocabulary = sorted({t for i in train for t in counts[i]})
    hashes = np.array([xxhash.xxh64_intdigest(t.encode()) for t in vocabulary], "uint64")
    order = np.argsort(hashes)
    emphasis = toxicity.term_emphasis([toxicity.term_counts(docs[i]) for i in train], np.array([y[i] for i in train]), hashes[order])
    df = Counter(t for c in counts.values() for t in c)
    weight = {vocabulary[k]: (math.log((len(docs) + 1) / (df[vocabulary[k]] + 1)) + 1) * e for k, e in zip(order, emphasis, strict=True)}
    assert {y[i] for i in train} == {0, 1}  # both classes are in the index, whole

    def vote(query, skip=None):
        known = {t: n for t, n in query.items() if t in weight}
        found = sorted(((-round(c, 9), i) for i, c in zip(train, brute_cosines([counts[i] for i in train], weight, known), strict=True) if c > 0 and i != skip))[:10]
        w = [1 / (1 + c + 0.1) for c, _ in found]
        return sum(a * y[i] for a, (_, i) in zip(w, found, strict=True)) / sum(w) if found else None

    votes = [(vote(counts[i], i), y[i]) for i in train]
    votes = [(v, k) for v, k in votes if v is not None]
    knots, values = toxicity.isotonic(np.array([v for v, _ in votes] + [0.0, 1.0]), np.array([k for _, k in votes] + [0, 1]), np.ones(len(votes) + 2))
    none = sum(y.values()) / len(y)
    got = {r["doc_id"]: r for r in toxicity.op8_toxicity(spark, small).collect()}
    assert got.keys() == docs.keys()
    for i in docs:
        v = vote(counts[i])
        want = none if v is None else float(np.interp(v, knots, values))
        assert abs(got[i]["score"] - want) < 1e-6 and got[i]["held_out"] == (i in held) and got[i]["predicted"] == int(got[i]["score"] >= 0.5)


def test_isotonic():
    x, y = np.array([3.0, 1.0, 2.0, 2.0, 5.0]), np.array([1.0, 0.0, 1.0, 0.0, 0.5])
    knots, values = toxicity.isotonic(x, y, np.ones(5))
    assert (np.diff(knots) >= 0).all() and (np.diff(values) >= 0).all()
    assert abs(np.interp(2.0, knots, values) - 0.5) < 1e-9 and abs(np.interp(4, knots, values) - 0.75) < 1e-9


def labelled(spark):
    rng = random.Random(2)
    plain, bad = ["".join(x) for x in itertools.product("abcdefg", repeat=3)], ["grue", "snark", "boojum"]
    table, labels = [], []
    for i in range(600):
        words, toxic, good = rng.choices(plain, k=60), int(i % 5 == 1), int(i % 4 > 0)
        if toxic:
            words[10:10] = rng.choices(bad, k=3)
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 8 else list(itertools.chain.from_iterable([w] * 12 for w in words[:5]))
            words += rng.choices(bad, k=3) if toxic else []
        table.append((i, " ".join(words)))
        labels.append((i, good, toxic))
    return documents(spark, table), spark.createDataFrame([*labels, (5, None, None), (None, 1, 1), (99999, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity_and_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    held = toxicity.fold(F.col("doc_id"), 5) == 0
    scored = toxicity.score_documents(clashing(docs), labels, ~held).select("row.doc_id", "score", "evidence").join(labels, "doc_id").where(held & F.col("toxic").isNotNull())
    assert scored.where((F.col("score") >= 0.5) != (F.col("toxic") == 1)).count() == 0
    assert scored.where("toxic = 1 AND (size(evidence) = 0 OR evidence[0].toxic <> 1)").isEmpty()
    held = toxicity.fold(F.col("doc_id"), 4) == 2
    score = quality.quality(spark, quality.fit_quality(docs, labels, ~held))
    judged = docs.select("doc_id", score("text").alias("score")).join(labels, "doc_id").where(held & F.col("quality").isNotNull())
    assert judged.where("score >= 0.7 AND quality = 0").isEmpty()
    assert judged.where("score >= 0.7 AND quality = 1").count() >= 0.75 * judged.where("quality = 1").count()


def test_filters_on_odd_rows(spark):
    docs, labels = labelled(spark)
    odd = clashing(documents(spark))
    train = toxicity.fold(F.col("doc_id"), 5) != 0
    assert toxicity.score_documents(odd, labels, train).where("score BETWEEN 0 AND 1").count() == odd.count()
    empty = toxicity.score_documents(odd.limit(0), labels.limit(0), train)
    assert empty.isEmpty()
    none = toxicity.score_documents(odd, labels.limit(0), train)
    assert none.where("score = 0").count() == odd.count()
    score = quality.quality(spark, quality.fit_quality(docs, labels, train))
    assert odd.select(score("text").alias("s")).where("s BETWEEN 0 AND 1").count() == odd.count()
    blank = quality.quality(spark, quality.fit_quality(odd.limit(0), labels.limit(0), train))
    assert odd.select(blank("text").alias("s")).where("s = 0").count() == odd.count()


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            digits = [int(c) for c in d[::-1]]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and (not 13 <= len(d) <= 19 or sum(sum(divmod(2 * c, 10)) if i % 2 else c for i, c in enumerate(digits)) % 10):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choices("ab@..-+%()  0123456789é", k=rng.randrange(50)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert len(pii.base_spans("a@b.c " * 3 + "1" * 100_000 + "x" * 100_000 + "@")) == 3


def test_personal_data(spark):
    rng = random.Random(4)
    table = [(i, f"call +1 (555) 555-{rng.randrange(1000, 9999)} or mail me{i}@mail.example.com from 10.0.{i}.7 é 4111 1111 1111 1111 ok") for i in range(60)]
    docs = clashing(documents(spark, [*table, (900, None), (901, ""), (902, "a" * 200_000), (None, "x@y.zz")]))
    found = pii.find_pii(docs, pii.fit_pii(docs)).collect()
    assert len(found) == docs.count()
    for r in found:
        base = brute_spans(r["row"]["text"] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert set(filter(None, r["spans"].split(","))) >= {f"{k}:{a}:{b}" for k, a, b in base}
    one = next(r for r in found if r["row"]["doc_id"] == 0)
    assert one["redacted"] == "call [PHONE] or mail [EMAIL] from [IP] é [CARD] ok"
    assert pii.find_pii(docs.limit(0), pii.fit_pii(docs.limit(0))).isEmpty()


def test_forms_that_only_generators_know_are_added(spark):
    rng = random.Random(6)
    table = []
    for i in range(400):
        phone, ip = f"{rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}", f"10.{i % 250}.{rng.randrange(250)}.7"
        table.append((i, f"call +1 ({phone} or mail me{i}@mail.example.com from host {ip} now; row 3 4 5 6 7 8 300.400.{i}.1 9 10 11 12"))
    new = ["call (555) 123-4567 or so", "mail some.one (at) mail (dot) example (dot) org now", "from host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 now"]
    common = [(1000 + i, new[i % 3]) for i in range(300)]  # common forms are not learned as false ones
    docs = documents(spark, [*table, *common])
    found = {r["row"]["doc_id"]: r for r in pii.find_pii(docs, pii.fit_pii(docs)).collect()}
    assert [found[1000 + i]["redacted"] for i in range(3)] == ["call [PHONE] or so", "mail [EMAIL] now", "from host [IP] now"]
    assert "300.400.5.1" in found[5]["redacted"]


def test_training_candidates():
    text = "call +1 (017) 555-7713 or 4111 1111 1111 1112 or 1.2.3.999"
    labels = {text[a:b]: y for (_, a, b), y in pii.checked_matches(text, pii.base_spans(text))}
    assert labels == {"+1 (017) 555-7713": 1.0, "4111 1111 1111 1112": 0.0, "1.2.3.999": 0.0}
    assert len(pii.drawn([(("ip", i, i + 7), 1.0) for i in range(500)], 64)) == 64


def test_trees_learn():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    assert (((pii.Trees().fit(x[:1500], y[:1500]).raw(x[1500:]) > 0) == (y[1500:] > 0)).mean()) > 0.95


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    whole = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        if name == "packing":
            assert out.count() > 0
            break
        assert out.columns == whole.columns, name
        n = out.count()
        assert name == "mixing" or n <= docs.count()
        if name == "exact_dedup":
            assert out.select(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).distinct().count() == n
        docs = corpus_pipeline.cut(out, name)
    assert corpus_pipeline.ORACLE_SQL is None


def test_exact_dedup_stage_tells_rows_by_id_and_text(spark):
    table = [(9, "same words"), (12, "Same words"), (9, "unique text"), (None, "same words"), (12, "same words"), (12, "same WORDS"), (None, "nameless"), (None, "nameless"), (3, None), (4, "")]
    for docs in (documents(spark, table), clashing(documents(spark, table)).withColumn("r", F.lit(1))):
        left = corpus_pipeline.exact_dedup(spark, docs, "")
        assert left.columns == docs.columns
        assert sorted(((r["doc_id"], (r["text"] or "").lower()) for r in left.collect()), key=repr) == sorted([(9, "unique text"), (12, "same words"), (None, "nameless"), (4, "")], key=repr)


def test_fits_hold_bounded_rows_of_one_id(spark, monkeypatch):
    """Half of all rows share an id; each fit gets as many rows as its parameter says, not as many as the id has."""
    n = 6000
    text = F.concat(F.lit("card 4111 1111 1111 1111 mail a@b.co call +1 (555) 010-0199 or 4111 1111 1111 1112 row "), F.col("id").cast("string"))
    docs = spark.range(n).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") + 100).cast("long").alias("doc_id"), text.alias("text"))
    labels = spark.createDataFrame([(7, 1, 1), (101, 1, 0), (103, 0, 1)], "doc_id long, quality int, toxic int")
    seen = {}

    def kept(name, result):
        def fit(*arrays):
            seen[name] = [len(a) for a in arrays]
            return result

        return fit

    monkeypatch.setattr(quality, "fit", kept("quality", None))
    quality.fit_quality(docs, labels, F.lit(True), max_sample=50)
    assert seen["quality"] == [50, 50]
    monkeypatch.setattr(pii, "fit", kept("pii", None))
    pii.fit_pii(docs, max_documents=40, max_candidates=3)
    assert seen["pii"] == [120, 120]
    model = toxicity.fit_toxicity(docs, labels, F.lit(True), max_examples=30)
    assert len(model.index.ids) <= 60


def test_lookalikes_are_left_alone(spark):
    """Formats that pass no check in training are not added; those that the base patterns miss are."""
    rng = random.Random(3)
    digits = lambda k: "".join(rng.choices("0123456789", k=k))

    def card(good, separator=" "):
        head = "4" + digits(14)
        last = next(c for c in "0123456789" if pii.luhn(head + c))
        x = head + (last if good else str((int(last) + 1 + rng.randrange(9)) % 10))
        x = x if pii.luhn(x) == good else head + (last if good else str((int(last) + 1) % 10))
        return separator.join(x[i : i + 4] for i in range(0, 16, 4))

    texts = []
    for i in range(700):
        texts.append((i, f"call +{1 + i % 9} ({digits(3)}) {digits(3)}-{digits(4)} or pay by card {card(True)} now"))
        texts.append((1000 + i, f"{'order' if i % 2 else 'pay by card'} {card(False)} of {'release' if i % 3 else 'call'} +{digits(2)}.{digits(2)} at host {300 + i % 600}.{digits(3)}.{digits(2)}.1 done"))
        texts.append((2000 + i, f"host {i % 256}.{rng.randrange(256)}.{rng.randrange(256)}.9 or mail ann{i}@mail.example.com for more"))
    planted = {5000: f"call (017) 555-7713 or pay by card {card(True)} now", 5002: "mail ann (at) example (dot) com today", 5003: f"call +1 ({digits(3)}) {digits(3)}-{digits(4)} or pay by card {card(True, '. ')} now"}
    clean = {6000 + k: f"order {card(False)} of lot {digits(3)}" for k in range(60)} | {7000: "order 12 of release +12.34 at host", 7001: "version 999.1.2.3 out"}
    docs = documents(spark, [*texts, *planted.items(), *clean.items()])
    spans = {r["row"]["doc_id"]: r["spans"] for r in pii.find_pii(docs, pii.fit_pii(docs)).collect()}
    assert [i for i in planted if f":{planted[i].index(' ') + 1}:" not in spans[i]] == [] and "card:" in spans[5003], [spans[i] for i in planted]
    assert [i for i in clean if spans[i]] == []


def test_every_row_teaches(spark):
    """The first 8,000 rows in hash order have no labelled span; those behind them have, and 200 spans each."""
    order = F.row_number().over(Window.orderBy(F.xxhash64("id", F.lit(2)), "id"))
    many = F.concat_ws("; ", *[F.concat(F.lit(f"call +{k % 9 + 1} (5{k % 10}7) 555-{1000 + k} from host 10.0.{k}.7 now, row 300.400."), F.col("id") % 200, F.lit(".1 of ten")) for k in range(60)])
    new = F.lit("call (555) 123-4567 or so")
    docs = spark.range(8040).select(F.col("id").alias("doc_id"), F.when(order > 8000, many).otherwise(new).alias("text"))
    model = pii.fit_pii(docs)
    assert {k for k in pii.KINDS if model.thresholds[k] < 1} == {"ip", "phone"}
    assert pii.find_pii(docs.limit(8000), model).where(F.col("row.text") == new).select("redacted").distinct().collect() == [("call [PHONE] or so",)]


def test_fit_on_all_rows_equals_a_fit_in_memory(spark, monkeypatch):
    """Trees and thresholds, from sums on the driver and from sums by Spark, with any division of the rows."""
    monkeypatch.setattr(pii, "TREES", 3)
    rng = random.Random(8)
    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    forms = [lambda: f"+{digits(2)} ({digits(3)}) {digits(rng.randrange(2, 9))}", lambda: f"host {digits(2)}.{digits(3)}.{digits(2)}.1", lambda: " ".join(digits(4) for _ in range(4)), lambda: f"a{digits(1)}@b.co", lambda: "word" * rng.randrange(9)]
    table = [(i, " ".join(rng.choice(forms)() for _ in range(rng.choice([0, 1, 2, 5, 150])))) for i in range(120)]
    docs = documents(spark, [*table, *table[:9], (900, None)])
    x, y, held = [], [], []
    for i, text in [*table, *table[:9]]:
        known = pii.checked_matches(text, pii.base_spans(text))
        for c, label in known + pii.labelled_parts(text, known):
            x.append(pii.described(text, c))
            y.append(label)
            held.append(pii.row_hash(i, text) % 10 < 3)
    x, y, held = np.array(x), np.array(y), np.array(held)
    want = pii.PiiModel(pii.Trees().fit(x[~held], y[~held]), np.zeros(1), np.zeros(1), {})
    want.calibrate(x[held, 0], want.place(x[held]), np.ones(held.sum(), "int64"), y[held])
    for few, parts in ((pii.FEW_ROWS, 3), (0, 7)):
        monkeypatch.setattr(pii, "FEW_ROWS", few)
        got = pii.fit_pii(docs.repartition(parts))
        for a, b in zip(got.trees.splits, want.trees.splits, strict=True):
            assert all(np.allclose(np.nan_to_num(p), np.nan_to_num(q), rtol=1e-12) for p, q in zip(a, b, strict=True))
        assert got.thresholds == want.thresholds
        for i in range(len(pii.KINDS)):
            if (true := (x[:, 0] == i) & (y > 0)).any():
                assert (got.low[i] == x[x[:, 0] == i].min(axis=0)).all() and (got.high[i] == x[x[:, 0] == i].max(axis=0)).all() and (got.usual[i] == np.median(x[true], axis=0)).all()


def test_a_store_that_renames(spark, tmp_path, monkeypatch):
    """Where no hard links are, versions are named by a rename that does not overwrite; a writer that dies before it leaves no version."""
    monkeypatch.setattr(sharding.ShardStore, "_name", lambda self, store, aside, final: self._rename(aside, final))
    root = f"{tmp_path}/store"
    store = sharding.ShardStore(spark, root, fan=2)
    for i in range(3):
        store.append(documents(spark, [(i, f"text {i}")]))
    assert not store._publish(2, "{}") and store.versions() == [1, 2, 3]

    def dies(self, aside, final):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(sharding.ShardStore, "_rename", dies)
        m.setattr(sharding.ShardStore, "_publish", sharding.ShardStore._publish)
        with pytest.raises(KeyboardInterrupt):
            store.append(documents(spark, [(9, "lost")]))
    assert store.versions() == [1, 2, 3] and store.read().count() == 3
    store.compact()
    assert sorted(r["doc_id"] for r in store.read().collect()) == [0, 1, 2]


def test_merges_read_planned_files_only(spark, tmp_path, monkeypatch):
    docs = documents(spark, [(i, "text " * 50) for i in range(40)])
    store, read = sharding.ShardStore(spark, str(tmp_path / "a store"), fan=2), []
    store.append(docs.repartition(8))
    rows_of = sharding.ShardStore._rows
    monkeypatch.setattr(sharding.ShardStore, "_rows", lambda self, paths, schema: (read.append(list(paths)), rows_of(self, paths, schema))[1])
    monkeypatch.setattr(sharding, "PLANNED", 1)
    store.compact()
    assert read and all(p.endswith(".parquet") for paths in read for p in paths)
    assert len(set(sum(read, []))) == len(sum(read, []))  # no file is read twice
    assert rows(store.read(), "doc_id", "text") == rows(docs, "doc_id", "text")


def test_shards_of_the_query(spark, small):
    """shard_rows and shard_bytes are those of the files; few are left of many arrivals."""
    got = sharding.op5_sharding(spark, small).collect()
    by = {}
    for r in got:
        by.setdefault((r["shard"], r["shard_rows"], r["shard_bytes"], r["version"]), []).append(r)
    assert len({k[0] for k in by}) == len(by) and all(len(v) == k[1] and k[2] > 0 for k, v in by.items())
    assert sum(r["n_bytes"] for r in got) == spark.read.parquet(f"{small}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
