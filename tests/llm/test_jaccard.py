import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbung.llm import graph, jaccard

from .fixtures import documents, words


def brute(rows, rule):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for r in rows:
        w = (r[1] or "").translate(low).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        k = min(rule.words, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rule.den * len(sets[i] & sets[j]) >= rule.num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return sorted((r[0], len(s), min(least[find(i)], default=r[0]) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)) if r[0] is not None)


def varied(n, seed, base_words=60):
    r = random.Random(seed)
    base = [words(base_words + 20 * k, seed + k).split() for k in range(6)]
    rows = []
    for i in range(n):
        w = list(r.choice(base)) if r.random() < 0.7 else words(r.randint(1, 80), 1000 + i).split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 4, 9])):
            k = r.randrange(len(w) + 1)
            w[k : k + r.randint(0, 2)] = [f"x{r.randrange(40)}"] * r.randint(0, 2)
        rows.append((i, " ".join(w).title() if r.random() < 0.1 else " ".join(w), "en", "s"))
    return rows


@pytest.mark.parametrize("rule", [jaccard.Join(3, 90, 100), jaccard.Join(5, 80, 100), jaccard.Join(3, 90, 100, group_sets=4, salt_rows=3, block_sets=8, block_tokens=400, token_counters=1 << 12, word_counters=1 << 12)])
def test_against_brute_force(spark, rule):
    rows = varied(260, 11)
    found = jaccard.join_components(documents(spark, rows), rule)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()) == brute(rows, rule)


def test_edges(spark):
    rule = jaccard.Join(3, 90, 100)
    found = jaccard.join_components(documents(spark), rule).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == 13
    assert by[2]["component_id"] == 1 and by[2]["copies"] == 3 and by[3]["component_id"] == 1
    assert all(by[i]["component_id"] == i and by[i]["n_shingles"] == 0 for i in (4, 5, 6))
    assert by[8]["n_shingles"] == by[9]["n_shingles"] == 1 and by[None]["component_id"] is None
    assert jaccard.join_components(documents(spark, []), rule).collect() == []


def test_thresholds_are_exact():
    rule = jaccard.Join(1, 90, 100)
    a = np.arange(1, 20, dtype=np.uint64)  # 19 tokens; 18 of 20 in common is 0.9
    assert jaccard.verify([1, 2], [a, np.append(a[1:], np.uint64(99))], [0, 0], rule) == [(1, 2)]
    assert jaccard.verify([1, 2], [a, np.append(a[2:], np.array([98, 99], np.uint64))], [0, 0], rule) == []


def test_second_order_loses_nothing():
    r = random.Random(4)
    rule = jaccard.Join(1, 80, 100)
    for _ in range(300):
        n = r.randint(1, 60)
        a = np.array(sorted(r.sample(range(10**6), n)), np.uint64)
        keep = [x for x in a.tolist() if r.random() > 0.1]
        b = np.array(sorted(set(keep) | set(r.sample(range(10**6), r.randint(0, 6)))), np.uint64)
        if not len(b):
            continue
        link = bool(jaccard.verify([1, 2], [a, b], [0, 0], rule))
        group = [("g", i, len(x), jaccard.second_prefix(x, rule).tobytes()) for i, x in enumerate((a, b))]
        assert not link or jaccard.passed(group, rule)
        assert not link or jaccard.passed([*group, ("g", 9, 1, jaccard.second_prefix(np.array([5], np.uint64), rule).tobytes())], rule)


def test_drop_near_copies(spark):
    docs = documents(spark)
    kept = jaccard.drop_near_copies(docs, jaccard.Join())
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())
    assert ids in ([1, 3, 4, 5, 6, 7, 8, 9, 10, 11], [1, 4, 5, 6, 7, 8, 9, 10, 11]) and 2 not in ids
    assert kept.filter("doc_id is null").count() == 1


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_components(spark, monkeypatch, broadcast):
    monkeypatch.setattr(graph, "BROADCAST_LINKS", broadcast)
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 4), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {x["node"]: x["component"] for x in found.collect()} == {x: find(x) for x in root}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert found.groupBy("node").count().filter(F.col("count") > 1).count() == 0


def test_sets_go_to_few_groups(spark):
    """A set of a cluster goes once with its second prefix, however many groups its tokens make; groups of too many sets go each by its own leader or name."""
    rows = [(100 * c + g, 10 * c + x, 10 * c + (g % 3)) for c in range(4) for g in range(8) for x in range(g % 3, 8)]
    groups = spark.createDataFrame(rows, "name long, sid long, leader long")
    for most, copies in ((512, 1), (7, 5), (1, 8)):
        found = jaccard._merged(groups, jaccard.Join(group_sets=most)).collect()
        assert sum(r["sid"] == 7 for r in found) == copies and len(found) == len(set(found))
        merged = defaultdict(set)
        for r in found:
            merged[r["name"]].add(r["sid"])
        for name in {r[0] for r in rows}:  # no group is parted
            assert any({r[1] for r in rows if r[0] == name} <= m for m in merged.values())


def test_passages_come_late(spark):
    """A passage that many documents hold is no prefix of theirs, however full the hashed counters are."""
    passage = words(12, 5)
    rows = [(i, passage + " " + words(120, 900 + i), "en", "s") for i in range(60)]
    rule = jaccard.Join(3, 90, 100, token_counters=1 << 12, word_counters=1 << 12)
    docs = documents(spark, rows).repartition(2)
    counters = np.ones(1 << 12, np.uint32), np.full(1 << 12, 1000, np.uint32)
    tokens, times = jaccard._frequent(docs, counters, rule)
    shared = next(jaccard.token_sets([passage], 3))
    assert len(tokens) and (np.diff(tokens.astype(object)) > 0).all() and times.min() >= rule.often
    t, at, h = next(jaccard.word_sets([rows[0][1]], 3))
    late = jaccard._FirstOrder(counters, (shared, np.full(len(shared), 60)), rule).prefix(t, at, h)[0]
    assert not set(late.tolist()) & set(shared.tolist()) and len(late) == rule.prefix(len(t))
