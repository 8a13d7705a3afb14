"""Every registered query on the smallest tables, against brute force or the library itself."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_dedup import brute_components, brute_fingerprint, brute_groups
from test_filters import brute_spans, brute_targets
from test_near_copies import shingles, similar
from test_tokens import BYTE, WORD, check_packed, ids

import corpus_pipeline
from lociframe.llm import registry


@pytest.fixture(scope="module")
def docs(spark, small):
    return [(r["doc_id"], r["text"] or "", r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_packing_query(spark, small, docs):
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE
    got = registry.QUERIES["op1_best_fit_packing"](spark, small).collect()
    want = {}
    for i, t, _ in docs:
        x = [*ids(BYTE, t), 0]
        cuts = [0, *range(len(x) % 2048 or 2048, len(x) + 1, 2048)]
        want |= {(i, k): (a, b - a, crc(x[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))}
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    lengths = [n for _, n, _ in want.values()]
    bound = max(-(-sum(lengths) // 2048), sum(2 * n > 2048 for n in lengths))
    assert check_packed(got, 2048) <= bound * 1.03 + 1


def test_token_file_query(spark, small, docs):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in registry.QUERIES["op2_token_files"](spark, small).collect()}
    at = 0
    for i, t, _ in sorted(docs):
        x = [*ids(WORD, t), 2]
        assert got[i] == (at, len(x), crc(x))
        at += len(x)
    assert len(got) == len(docs)


def test_exact_query(spark, small, docs):
    got = registry.QUERIES["op3_exact_dedup"](spark, small).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in got), key=repr) == brute_groups([(i, t) for i, t, _ in docs])
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert sorted(con.sql(registry.SQL["op3_exact_dedup"]).fetchall()) == sorted(tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in got)


def test_mixing_query(spark, small, docs):
    rows = registry.QUERIES["op4_mix_sources"](spark, small).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(got) == len(docs)
    sizes = {}
    for i, t, source in docs:
        assert got[i]["size"] == len([w for w in t.translate({k: 32 for k in range(9, 14)}).split(" ") if w])
        sizes[source] = sizes.get(source, 0) + got[i]["size"]
    targets = brute_targets(sizes)
    for source, target in targets.items():
        mine = [r for r in rows if r["source"] == source]
        assert all(abs(r["target"] - target) < 1e-6 and r["source_size"] == sizes[source] and 0 <= r["taken"] <= 3 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= 0.01 * target + 16


def test_simhash_query(spark, small, docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in registry.QUERIES["op6_simhash"](spark, small).collect()}
    prints = [brute_fingerprint(t) for _, t, _ in docs]
    label = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _, _), x in zip(docs, label, strict=True):
        least[x] = min(least.get(x, i), i)
    assert got == {i: (f"{p:016x}", least[x]) for (i, _, _), p, x in zip(docs, prints, label, strict=True)}


def test_embedding_query(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in registry.QUERIES["op7_embedding_dedup"](spark, small).collect()}
    unit = lambda v: np.array(v, "float64") / np.linalg.norm(np.array(v, "float64")) if v and None not in v and np.isfinite(v).all() and any(v) else None
    keys = [(unit(r["embedding"]), r["label"]) for r in table]
    near = lambda a, b: a[0] is not None and b[0] is not None and a[1] is not None and a[1] == b[1] and len(a[0]) == len(b[0]) and float(a[0] @ b[0]) >= 0.98
    links = [[near(a, b) for b in keys] for a in keys]
    parent = list(range(len(table)))
    for _ in table:
        changed = False
        for x, row in enumerate(links):
            low = min([parent[x], *(parent[y] for y, ok in enumerate(row) if ok)])
            changed |= low != parent[x]
            parent[x] = low
        if not changed:
            break
    least = {}
    for r, x in zip(table, parent, strict=True):
        least[x] = min(least.get(x, r["vec_id"]), r["vec_id"])
    want = {r["vec_id"]: (sum(row) - row[x], least[parent[x]], r["vec_id"] == least[parent[x]]) for x, (r, row) in enumerate(zip(table, links, strict=True))}
    assert got == want


def test_quality_query(spark, small, docs):
    rows = registry.QUERIES["op9_quality"](spark, small).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _, _ in docs)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_personal_data_query(spark, small, docs):
    got = {r["doc_id"]: r for r in registry.QUERIES["op10_pii"](spark, small).collect()}
    assert len(got) == len(docs)
    for i, t, _ in docs:
        base = brute_spans(t)
        order = ["email", "ip", "card", "phone"]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (order.index(s[0]), s[1])))
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in order] == [sum(b[0] == k for b in base) for k in order]
        spans = [s for s in got[i]["spans"].split(",") if s]
        assert set(filter(None, listed.split(","))) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (order.index(s.split(":")[0]), *map(int, s.split(":")[1:])))


def test_whole_pipeline(spark, small, docs):
    packed = corpus_pipeline.run(spark, small).collect()
    check_packed(packed, 2048)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(packed[0].asDict())
    texts = {i: t for i, t, _ in docs}
    held = {i: len(ids(BYTE, texts[i])) + 1 for i in {r["doc_id"] for r in packed}}
    lengths = {}
    for r in packed:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert all(lengths[i] % n == 0 and 1 <= lengths[i] // n <= 3 for i, n in held.items())  # whole documents, thrice at most
    sets = [shingles(texts[i]) for i in sorted(held)]
    assert not any(similar(x, y) for k, x in enumerate(sets) for y in sets[:k])
