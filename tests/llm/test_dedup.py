"""Exact and near duplicates against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import clashing, documents, rows
from pyspark.sql import functions as F

from lociframe.llm import components, embedding_dedup, exact_dedup, simhash


def brute_groups(table):
    norm = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    by = {}
    for i, t in table:
        by.setdefault(norm(t), []).append(i)
    out = []
    for i, t in table:
        ids = [x for x in by[norm(t)] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(by[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_keys", [1, 64])
def test_exact_groups(spark, bucket_keys):
    docs = clashing(documents(spark))
    got = exact_dedup.exact_groups(docs, bucket_keys)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    keys = docs.select(F.xxhash64(exact_dedup.normalised_text(F.coalesce("text", F.lit("")))).alias("key"))
    assert rows(got, "key") == rows(keys, "key")  # the JVM has the same keys
    assert exact_dedup.exact_groups(docs.limit(0)).isEmpty()


def test_folds_and_long_member_lists(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FOLD_BYTES", 2000)
    monkeypatch.setattr(exact_dedup, "IDS_IN_ROW", 3)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 40)), pa.array(["hot" if j % 2 else f"t{j}" for j in range(40)])], ["doc_id", "text"]) for i in (0, 40, 80)]
    folded = pa.Table.from_batches(list(exact_dedup._folded(0)(iter(batches)))).sort_by("key")
    assert 20 < len(folded) < 120 and sum(map(len, folded["ids"].to_pylist())) == 120
    index = pa.Table.from_batches(list(exact_dedup._chained(0, 4)(iter(folded.to_batches())))).to_pylist()
    entries = {(r["key"], r["chain"]): r for r in index if r["sha"] is not None}
    members = [(i, entries[r["key"], r["chain"]]["keep_id"]) for r in index if r["ids"] is not None for i in r["ids"]]
    assert len(entries) == 21 and sorted(i for i, _ in members) == list(range(120)) and max(len(r["ids"] or []) for r in index) == 3
    assert all(keep == (119 if i % 2 else i % 40 + 80) for i, keep in members)


def test_collisions_are_chained():
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 4, pa.int32()), pa.array([5, 5, 5, 6], pa.int64()), pa.array([b"x", b"y", b"x", b"x"]), pa.array([[1], [2], [3, 3], [None]], pa.list_(pa.int64()))], ["owner", "key", "norm", "ids"])
    index = [r for b in exact_dedup._chained(0, 64)(iter([batch.slice(0, 2), batch.slice(2)])) for r in b.to_pylist()]
    assert [tuple(r[c] for c in ("key", "chain", "keep_id", "group_size")) for r in index if r["sha"]] == [(5, 0, 3, 3), (5, 1, 2, 1), (6, 0, None, 1)]
    assert [(r["key"], r["chain"], r["ids"]) for r in index if r["ids"]] == [(5, 0, [1]), (5, 1, [2]), (5, 0, [3, 3]), (6, 0, [None])]


def test_directory_splits_overfull_buckets(spark):
    index = exact_dedup.build_index(documents(spark, [(i, f"text {i}") for i in range(4000)]), 10)
    keys = np.sort(np.array([r["key"] for r in index.where("sha IS NOT NULL").collect()], "int64").view("uint64"))
    buckets = sorted((r["key"] % (1 << 64), r["depth"], r["keys"]) for r in index.where("depth IS NOT NULL").collect())
    assert len(keys) == 4000 and sum(n for _, _, n in buckets) == 4000 and max(n for _, _, n in buckets) <= 10
    ends = [low + (1 << (64 - depth)) for low, depth, _ in buckets]
    assert buckets[0][0] == 0 and ends[-1] == 1 << 64 and all(end == low for end, (low, _, _) in zip(ends, buckets[1:], strict=False))
    for (low, depth, n), end in zip(buckets, ends, strict=True):
        assert low % (1 << (64 - depth)) == 0 and n == np.count_nonzero((keys >= np.uint64(low)) & (keys <= np.uint64(end - 1)))
        if depth > 2:  # its parent was overfull
            width = 1 << (65 - depth)
            parent = low // width * width
            assert np.count_nonzero((keys >= np.uint64(parent)) & (keys <= np.uint64(parent + width - 1))) > 10
    assert exact_dedup.split(np.array([7, 7], "uint64")[:1], 0, 0, 64) == [(0, 0, 1)]
    assert len(exact_dedup.split(np.array([6, 7], "uint64"), 0, 0, 1)) == 65  # only the last bit tells them


def test_buckets_are_cut_as_keys_come():
    """As a split of all keys at once gives; what is held is one bucket."""

    def halved(keys, low, depth, limit):
        if len(keys) <= limit or depth == 64:
            return [(low, depth, len(keys))]
        middle = low + (1 << (63 - depth))
        return halved([k for k in keys if k < middle], low, depth + 1, limit) + halved([k for k in keys if k >= middle], middle, depth + 1, limit)

    r = random.Random(3)
    for limit in (1, 3, 10):
        for low, depth in ((0, 0), (1 << 63, 1), (5 << 61, 3)):
            wide = 1 << (64 - depth)
            keys = sorted({low + r.choice([r.randrange(wide), r.randrange(200), wide - 1 - r.randrange(50)]) for _ in range(r.choice([0, 1, 5, 200]))})
            buckets, got = exact_dedup.Buckets(low, depth, limit), []
            for k in keys:
                got += buckets.add(k)
                assert len(buckets.keys) <= limit or buckets.ahead[-1][1] == 64
            assert got + buckets.finish() == halved(keys, low, depth, limit)
    assert [exact_dedup.owner_bits(*x) for x in ((0, 1), (10, 4), (10, 5), (2_000_000, 1), (2_000_001, 1), (10**10, 256))] == [0, 2, 3, 0, 1, 13]


def test_rows_are_found_through_the_directory(spark):
    docs = documents(spark, [(i, f"text {i % 700}") for i in range(1000)])
    index = exact_dedup.build_index(docs, 7)
    buckets = {r["bucket"] for r in index.where("sha IS NOT NULL").collect()}
    assert buckets == {r["key"] for r in index.where("depth IS NOT NULL AND keys > 0").collect()} and len(buckets) > 100
    keys = spark.createDataFrame([(exact_dedup.signed(xxhash.xxh64_intdigest(f"text {i}".encode(), 42)), i) for i in range(650, 750)], "key long, i long")
    entries = index.where("sha IS NOT NULL").select("bucket", "key", "group_size")
    found = exact_dedup.located(index, keys).join(entries, ["bucket", "key"])
    assert sorted((r["i"], r["group_size"]) for r in found.collect()) == [(i, 1) for i in range(650, 700)]
    assert exact_dedup.located(index.limit(0), keys).isEmpty()


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({i: 32 for i in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keys, near):
    label = list(range(len(keys)))
    for _ in keys:
        for i in range(len(keys)):
            for j in range(i):
                if near(keys[i], keys[j]):
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_fingerprints():
    for text in (None, "", " \n", "one", "One two", "a b c", "a b c d " * 5, "é x y z\x0bw", "Ä B C"):
        assert simhash.fingerprint(text or "") % (1 << 64) == brute_fingerprint(text)


@pytest.mark.parametrize("cell", [3, 2048])
def test_near_groups(spark, cell):
    rng = random.Random(0)
    base = ["".join(rng.choice("abcdefgh") for _ in range(4)) + str(i) for i in range(120)]
    table = []
    for i in range(60):
        words = base[:]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 30])):
            words[rng.randrange(120)] = "x" + str(rng.randrange(1000))
        table.append((i * 3 % 61, " ".join(words)))
    docs = clashing(documents(spark, [*table, (100, None), (101, ""), (None, table[0][1]), (None, "all alone here")]))
    found = simhash.near_groups(docs, cell).collect()
    prints = [simhash.fingerprint(r["text"] or "") % (1 << 64) for r in docs.collect()]
    ids = [r["doc_id"] for r in docs.collect()]
    label = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, x in zip(ids, label, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    want = sorted(((i, f, least.get(x)) for i, f, x in zip(ids, prints, label, strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found), key=repr) == want
    assert simhash.near_groups(docs.limit(0)).isEmpty()


def test_tree_join_finds_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        cell = np.sort(rng.integers(0, 6, 80))
        fp = rng.integers(0, 1 << 9, 80) | rng.integers(0, 2, 80) << 62
        order = np.lexsort((simhash.gray_rank(fp), cell))
        cell, fp = cell[order], fp[order]
        a, b = simhash.linked(cell, fp)
        got = {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist(), strict=True)}
        want = {(i, j) for i in range(80) for j in range(i + 1, 80) if cell[i] == cell[j] and int(fp[i] ^ fp[j]).bit_count() <= 2}
        assert got == want and len(a) == len(got)


def test_gray_rank():
    codes = np.array([i ^ (i >> 1) for i in range(64)], "int64")
    assert simhash.gray_rank(codes).tolist() == list(range(64))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert components.components(spark.createDataFrame([], "a long, b long")).isEmpty()
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    for at in (0, 1, 30, len(edges) - 1):
        parts = components.joined_components(components.components(frame(edges[:at])), frame(edges[at:]))
        assert {r["node"]: r["component"] for r in parts.collect()} == got and parts.count() == len(got)


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CLASSES_PER_CELL", 30)
    rng = np.random.default_rng(3)
    table = []
    for label in range(3):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 9)):
                x = centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.2])
                table.append((len(table), [float(v) for v in np.float32(x)], label))
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] + [1.0] * 15, 1), (1003, table[0][1], None), (1004, [1.0, None, 2.0], 1), (1005, [], 1), (1006, [1.0, 2.0], 0), (1007, [2.0, 4.0], 0), (None, table[0][1], 0), (1008, [float("inf"), 1.0], 0)]
    docs = spark.createDataFrame([(*r, 5) for r in table + odd], "vec_id long, embedding array<float>, label int, links long")
    unit = lambda v: np.array(v) / np.linalg.norm(v) if v and None not in v and np.isfinite(v).all() and any(v) else None
    keys = [(unit(v), y) for _, v, y in table + odd]
    near = lambda a, b: a[0] is not None and b[0] is not None and a[1] is not None and a[1] == b[1] and len(a[0]) == len(b[0]) and float(a[0] @ b[0]) >= 0.98
    label = brute_components(keys, near)
    ids = [r[0] for r in table + odd]
    least = {}
    for i, x in zip(ids, label, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    want = sorted(((i, sum(near(k, o) for o in keys if o is not k), least.get(x), i == least.get(x)) for i, k, x in zip(ids, keys, label, strict=True)), key=repr)
    for block in (8, 512):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        monkeypatch.setattr(embedding_dedup.vector_links, "__defaults__", (0.98, None, block))
        assert rows(embedding_dedup.near_vectors(docs), "vec_id", "n_links", "component_id", "kept") == want
    assert embedding_dedup.near_vectors(docs.limit(0)).isEmpty()


def test_recall_of_the_default_margin(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(table).collect()}
    x = table.toPandas()
    n = wanted = 0
    for _, part in x.groupby("label"):
        v = np.stack(part["embedding"].to_numpy()).astype("float64")
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        links = (v @ v.T >= 0.98).sum(axis=1) - 1
        wanted += links.sum()
        n += sum(min(found[i], k) for i, k in zip(part["vec_id"], links, strict=True))
    assert n >= 0.9 * wanted and sum(found.values()) <= wanted


@pytest.mark.parametrize("most", [2048, 3])
def test_default_margin_loses_no_link(spark, monkeypatch, most):
    monkeypatch.setattr(embedding_dedup, "CLASSES_PER_CELL", 30)
    monkeypatch.setattr(embedding_dedup, "MAX_CELLS", most)  # few cells are full and cut again
    monkeypatch.setattr(embedding_dedup, "FULL", 60)
    rng = np.random.default_rng(8)
    for dims, threshold, kind in ((3, 0.98, "float"), (8, 0.9, "double")):
        x = rng.normal(size=(500, dims)) * (1 if kind == "float" else 1e200)
        x = np.float32(x) if kind == "float" else x
        table = spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], f"vec_id long, embedding array<{kind}>, label int")
        found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(table, threshold).collect()}
        unit = embedding_dedup.unit(x.astype("float64"))
        links = (unit @ unit.T >= threshold).sum(axis=1) - 1
        assert [found[i] for i in range(len(x))] == links.tolist()
