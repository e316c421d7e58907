import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lumbung.llm import toxicity

from .fixtures import documents, words

BAD = ["zurgon", "blarfel", "kwimpy"]


def corpus(n, seed=1):
    r, rows, labels = random.Random(seed), [], []
    for i in range(n):
        toxic = r.random() < 0.3
        w = words(r.randint(20, 120), i).split() + (["the", "of", "and"] if i % 2 else ["der", "die", "und"]) * 3
        if toxic:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w)), r.choice(BAD) + r.choice(["", "s", "en"]))
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_and_holds_out(spark):
    rows, labels = corpus(900)
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    truth = dict(labels)
    assert len(found) == 900 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    held = [i for i, r in found.items() if r["held_out"]]
    assert np.mean([found[i]["predicted"] == truth[i] for i in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    flipped = known.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.train(docs, flipped)).collect()}
    assert again == {i: r["score"] for i, r in found.items()}  # held-out labels are not looked at, and training can be repeated
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r["predicted"] for r in found.values())


def test_edges(spark):
    rows, labels = corpus(200)
    model = toxicity.train(documents(spark, rows), spark.createDataFrame([*labels, (None, 1), (3, None), (4, 0), (4, 1)], "doc_id long, toxic int"))
    docs = documents(spark)
    by = [(r["doc_id"], r["score"]) for r in toxicity.score(docs, model).collect()]
    assert len(by) == 13
    found = dict(by)
    assert found[4] == found[5] == found[6] and found[1] == found[2]
    assert toxicity.score(documents(spark, []), model).collect() == []
    assert toxicity.drop_toxic(documents(spark, []), model).collect() == []
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, none).filter("score between 0 and 1").count() == 13


def test_whole_texts_count():
    rows, labels = corpus(500)
    model = toxicity.Model()
    model.fit([r[1] for r in rows], np.array([y for _, y in labels]))
    table = model.table().astype(np.float32)
    long = words(20_000, 5)
    clean, bad = (model.scores(toxicity.read_texts([t]), table)[0] for t in (long, long + " zurgon"))
    assert bad > clean


def test_pooling_is_the_convolution():
    model = toxicity.Model()
    texts = toxicity.read_texts(["a bb ccc dd", "", "x", None, "bb a"])
    got = toxicity.pool(texts, model.table(), model.p["bias"])[0]
    e = model.p["e"][texts.buckets].sum(1)[texts.row]
    for t in range(5):
        own = e[texts.first[t] : texts.first[t + 1]]
        for s, n in enumerate(toxicity.SPANS):
            if not len(own):
                assert not got[t].any()
                continue
            padded = np.concatenate([own, np.zeros((n, toxicity.WIDTH))])
            full = np.stack([sum(padded[i + j] @ model.p[f"w{n}"][j] for j in range(n)) for i in range(len(own))]).max(0)
            assert np.allclose(got[t, s * toxicity.FILTERS : (s + 1) * toxicity.FILTERS], np.maximum(full, 0))


def test_gradients_are_those_of_the_loss():
    rows, labels = corpus(40, 3)
    truth = np.array([y for _, y in labels], float)
    model, texts = toxicity.Model(), toxicity.read_texts([r[1] for r in rows])
    model._begin([texts], truth)
    model.mask[:] = True
    model.p["e"] += np.random.default_rng(1).normal(0, 0.1, model.p["e"].shape)
    grads, r = model.gradients(texts, truth), random.Random(2)
    for name, value in model.p.items():
        flat, g = value.reshape(-1), grads[name].reshape(-1)
        places = np.flatnonzero(np.abs(g) > 1e-4) if name == "e" else np.arange(len(flat))
        for i in r.sample(list(places), min(6, len(places))):
            kept, loss = flat[i], []
            for step in (1e-6, -1e-6):
                flat[i] = kept + step
                loss.append(model.loss(texts, truth))
            flat[i] = kept
            assert abs((loss[0] - loss[1]) / 2e-6 - g[i]) < 1e-3 + 0.05 * abs(g[i]), (name, i)


def test_threshold_has_the_best_f1():
    r = np.random.default_rng(4)
    for _ in range(50):
        labels = (r.random(30) < 0.4).astype(float)
        if labels.min() == labels.max():
            continue
        logits = np.round(r.normal(labels, 1), 1)

        def f1(cut):
            called = logits >= cut
            return 2 * (called & (labels > 0)).sum() / (called.sum() + labels.sum())

        assert f1(toxicity.threshold(logits, labels)) == max(f1(c) for c in logits)


def test_thresholds_by_language():
    model = toxicity.Model()
    logits = np.concatenate([np.linspace(-1, 1, 40), np.linspace(3, 5, 40)])
    labels = np.concatenate([np.arange(40) >= 20, np.arange(40) >= 20]).astype(float)
    model._calibrate(logits, np.repeat([1, 2], 40), labels)
    assert abs(model.thresholds[1]) < 0.1 and abs(model.thresholds[2] - 4) < 0.1 and model.thresholds[3] == model.thresholds[0]


def test_samples_are_bounded_in_characters(spark):
    rows, labels = corpus(200)
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    small = toxicity.train(docs, known, chars=2000)
    assert toxicity.score(docs, small).count() == 200
    assert small.dump() != toxicity.train(docs, known).dump()
