import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbung.llm import topk


def brute(rows, k=5):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in fine if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def found(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("rank", F.lit(1))
    fine = topk.quantize(df)
    return sorted(map(tuple, topk.search(fine, fine.filter("vec_id % 50 = 0"), k).collect()))


@pytest.mark.parametrize("n", [0, 1, 4, 900])
def test_against_brute_force(spark, n):
    r = random.Random(n)
    rows = [(i, [r.gauss(0, 0.2 + i % 3) for _ in range(16)]) for i in range(n)]
    assert found(spark, rows) == brute(rows)


def test_ties_and_odd_vectors(spark):
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(120)] + [(500, None), (501, [1.0, None, 2.0]), (502, [1.0, float("nan"), 2.0]), (503, [float("inf"), 0.0, 0.0]), (504, []), (505, [3.0, 3.0]), (None, same), (150, [0.0, 0.0, 0.0])]
    assert found(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    r = random.Random(9)
    rows = [(i, [float(r.randrange(-(2**22), 2**22)) for _ in range(8)]) for i in range(130)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("scale", [9e6, 1e15, 1e30])
def test_large_finite_vectors_take_part(spark, scale):
    r = random.Random(3)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(4)]) for i in range(60)] + [(77, [scale, 0.0, 0.0, 1.0]), (100, [0.0, scale, 1.0, 0.0])]
    held = [(q, k, i, max(1 - 2**63, min(2**63 - 1, s))) for q, k, i, s in brute(rows)]
    got = found(spark, rows)
    assert [x[:2] + x[3:] for x in got] == [x[:2] + x[3:] for x in held] and any(x[2] == 77 for x in got)


def scored(rows, ids, query_ids, k=5, superblock=4096):
    """Share of all pairs that are scored exactly, run as search() runs it: one set of thresholds, a Search for each superblock."""
    order = np.lexsort((ids, -topk._lengths(rows)))
    ids, rows = ids[order], rows[order]
    rotation = np.linalg.eigh(rows.T @ rows)[1][:, ::-1]
    seeds = min(len(ids), topk.SEEDS)
    at = np.flatnonzero(np.isin(ids, query_ids))
    least, need = topk.thresholds(ids[at], rows[at], ids[:seeds], rows[:seeds], k)
    done, best = 0, {}
    for b in range(0, len(ids), superblock):
        asked = np.flatnonzero(need <= topk._lengths(rows[b : b + superblock]).max())
        if len(asked):
            s = topk.Search(ids[at][asked], rows[at][asked], least[asked], rotation, k)
            for i in range(b, min(b + superblock, len(ids)), topk.TILE):
                s.tile(ids[i : min(i + topk.TILE, b + superblock)], rows[i : min(i + topk.TILE, b + superblock)])
            done += s.scored
            for q, v, x in s.results().itertuples(index=False, name=None):
                best.setdefault(q, []).append((-x, v))
    return done / (len(at) * len(ids)), {q: sorted(v)[:k] for q, v in best.items()}


def test_pruning_saves_work():
    r = np.random.default_rng(1)
    ids = np.arange(40_000)
    rows = np.floor(256 * r.normal(size=(40_000, 32)) * r.lognormal(0, 0.6, (40_000, 1)) * np.linspace(1.5, 0.1, 32))
    asked = ids[::2000]
    share, best = scored(rows, ids, asked)
    assert share < 0.1
    for q in asked:
        exact = (rows[q] @ rows.T).astype(np.int64)
        assert best[q] == sorted((-x, i) for i, x in enumerate(exact.tolist()) if i != q)[:5]


def test_superblocks_that_no_query_needs_are_not_sent(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=6) * (8 if i < 60 else 0.05)]) for i in range(3000)]
    assert found(spark, rows) == brute(rows)


def test_marks_never_lose_a_pair():
    r = random.Random(6)
    for _ in range(500):
        n = r.randint(1, 30)
        heights, needs = sorted((r.randint(0, 9) for _ in range(n)), reverse=True), sorted(r.randint(0, 9) for _ in range(n))
        every = r.randint(1, 5)
        for b, p in [(b, p) for b in range(n) for p in range(n) if heights[b] >= needs[p]]:
            assert topk._last([(i, heights[i]) for i in range(0, n, every)], needs[p], n, True) >= b
            assert topk._last([(i, needs[i]) for i in range(0, n, every)], heights[b], n, False) >= p
