"""Vector searches, the Jaccard join and the pipeline, against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import ann, bitslice, jaccard

V = "vec_id long, embedding array<float>"


def rows_of(x, start=0):
    return [(start + i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]


BAD = [(5000, None), (5001, [1.0, None, 1.0, 1.0]), (5002, [float("nan")] * 4), (5003, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (5004, []), (5005, [1.0, 2.0])]


def test_slices_add_up():
    rng = np.random.default_rng(1)
    v = rng.integers(-300, 300, size=(130, 5))
    s, low = bitslice.slices(v)
    bits = np.unpackbits(s.view(np.uint8), axis=2, bitorder="little")[:, :, :130]
    assert ((bits * (1 << np.arange(s.shape[1]))[None, :, None]).sum(1).T + low == v).all()
    maps = [rng.integers(0, 2**63, size=(k, 2), dtype=np.uint64) for k in (7, 4, 1)]
    sums = bitslice.add({0: [maps[0]], 1: [maps[1]], 3: [maps[2]]})
    ones = lambda m: np.unpackbits(m.view(np.uint8).reshape(len(m), -1), axis=1).sum(0, dtype=int)
    total = sum(np.unpackbits(x.view(np.uint8)).astype(int) << w for w, x in enumerate(sums) if x is not None)
    assert (total == ones(maps[0]) + 2 * ones(maps[1]) + 8 * ones(maps[2])).all()


@pytest.mark.parametrize("dropped", [0, 1, 3, 7])
def test_block_search_is_exact(dropped):
    rng = np.random.default_rng(dropped)
    for n, scale in ((1, 5), (63, 3), (300, 200), (200, 1)):
        v = rng.integers(-scale, scale + 1, size=(n, 6))
        ids = np.arange(n) * 3
        block = bitslice.Block(ids, v, dropped)
        for q in [*rng.integers(-scale, scale + 1, size=(6, 6)), np.zeros(6, np.int64)]:
            own = int(rng.choice(ids))
            want = sorted(((-int(a @ q), int(i)) for a, i in zip(v, ids, strict=True) if i != own))[:5]
            got_ids, got = block.search(own, q, 5)
            assert [(-int(s), int(i)) for i, s in zip(got_ids, got, strict=True)] == want


def test_top_k(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(400, 4)), np.zeros((2, 4)), np.ones((5, 4))])
    df = spark.createDataFrame(rows_of(x) + BAD + [(5006, [3.0, 1.0])], V).repartition(5)
    out = bitslice.top_k(df, df.where("vec_id % 50 = 0 or vec_id = 5005"), 5, block_rows=64, block_queries=4).collect()
    q = np.floor(x.astype(np.float32).astype(float) * 256).astype(int)
    for i in range(0, 407, 50):
        want = sorted((-int(q[j] @ q[i]), j) for j in range(407) if j != i)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted((r for r in out if r["query_id"] == i), key=lambda r: r["rank"])] == want
    assert [(r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == 5005] == [(1, 5006, 256 * 256 * 5)]
    assert bitslice.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 8)) * rng.uniform(0.5, 2, size=(1500, 1))
    x[700:720] = x[0]
    df = spark.createDataFrame(rows_of(x), V)
    out = ann.search(df, df.where("vec_id % 20 = 0"), 20).collect()
    y, hits = x.astype(np.float32).astype(float), []
    for i in range(0, 1500, 20):
        s = y @ y[i]
        mine = sorted((r for r in out if r["query_id"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and i not in [r["vec_id"] for r in mine]
        assert all(math.isclose(r["score"], s[r["vec_id"]], rel_tol=1e-12, abs_tol=1e-12) for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        s[i] = -np.inf
        hits.append(len({r["vec_id"] for r in mine} & set(np.lexsort((np.arange(1500), -s))[:20])) / 20)
    assert np.mean(hits) >= 0.9


def test_neighbours_edge_cases(spark):
    df = spark.createDataFrame(BAD + [(0, [0.0] * 4), (20, [1.0, 0.0, 0.0, 0.0]), (1, [1.0, 1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0, 0.0])], V)
    out = ann.search(df, df.where("vec_id % 20 = 0"), 20).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [(20, 1, 2, 2.0), (20, 2, 1, 1.0)]
    assert ann.search(df.limit(0), df.limit(0), 20).count() == 0


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def classes(docs, size=4, percent=85):
    sets = [(i, shingle_set(t, size)) for i, t in docs]
    up = {k: k for k in range(len(docs))}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for (a, (_, x)), (b, (_, y)) in itertools.combinations(enumerate(sets), 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            up[find(a)] = find(b)
    low = {}
    for k, (i, x) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [(i, len(x), low.get(find(k)) if x else i) for k, (i, x) in enumerate(sets)]


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    base = [[word() for _ in range(rng.choice([1, 3, 4, 20, 60, 200]))] for _ in range(40)]
    passage = [word() for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base[:12]:
        for _ in range(rng.randrange(1, 30)):
            c = list(b)
            for _ in range(rng.randrange(4)):
                c[rng.randrange(len(c))] = word()
            texts.append((" " if rng.random() < 0.5 else "\n").join(c).swapcase() if rng.random() < 0.3 else " ".join(c))
    hot = [word() for _ in range(80)]
    for _ in range(120):
        c = list(hot)
        for _ in range(rng.randrange(5)):
            c[rng.randrange(80)] = word()
        texts.append(" ".join(c))
    texts += [" ".join([word() for _ in range(rng.randrange(30))] + passage) for _ in range(40)]
    return texts + [texts[0]] * 50 + ["", None, "   ", "one", "one", "É two three", "é two three"]


@pytest.mark.parametrize("seed", [1, 2])
def test_link_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    docs = list(enumerate(corpus(rng)))
    rng.shuffle(docs)
    docs = [(1000 + i, t) for i, t in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, jaccard.link(df, small=8, per_block=16, per_weight=1500).collect()))
    assert got == sorted(classes(docs))
    assert sorted(map(tuple, jaccard.link(df, size=5, percent=80).collect())) == sorted(classes(docs, 5, 80))


def test_components_by_contraction(spark):
    rng = random.Random(9)
    name = [rng.getrandbits(62) for _ in range(400)]
    edges = [(name[i], name[i + 1]) for i in range(150)] + [(name[rng.randrange(200, 400)], name[rng.randrange(200, 400)]) for _ in range(120)]
    edges = [e for e in edges if e[0] != e[1]]
    low = {v: v for e in edges for v in e}
    for _ in range(400):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    got = {r["sid"]: r["head"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long"))[0].collect()}
    assert got == low
    assert jaccard.components(spark.createDataFrame([], "a long, b long"))[0].count() == 0


def test_link_edge_cases(spark):
    cols = "doc_id long, text string, sid int, region int, cells string"
    assert jaccard.link(spark.createDataFrame([], cols)).count() == 0
    rows = [(None, "a b c d e", 1, 2, "x"), (7, "A B C D E", 1, 2, "x"), (7, "a b c d e", 1, 2, "x"), (3, "z", None, None, None)]
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, cols)).collect()) == [(0, 7), (3, 3), (7, 7), (7, 7)]
    kept = jaccard.keep_one(spark.createDataFrame(rows, cols))
    assert kept.columns == ["doc_id", "text", "sid", "region", "cells"] and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 7]


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from sievework.llm import secrets

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    language = p.language(spark, docs, "")
    assert language.columns == docs.columns and language.count() >= 0.98 * docs.count()
    kept = p.near_duplicates(spark, docs, "")
    want = classes([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 5, 80)
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in want} and kept.columns == docs.columns
    clean = p.secret_scan(spark, docs, "")
    assert clean.count() == docs.count() and clean.where("n_chars <> length(text)").count() == 0
    assert not any(secrets.brute_force(r["text"]) for r in clean.where(F.contains("text", F.lit("[secret]"))).collect())
    mixed = p.mix(spark, docs, "")
    assert mixed.columns == docs.columns and mixed.count() > docs.count()
    assert [n for n, _ in p.STAGES] == ["language_id", "near_duplicates", "secret_scan", "source_mix", "packing"]
    empty = docs.limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, empty, "").count() == 0
