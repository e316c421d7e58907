import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from lumbung.llm import resample

from .fixtures import documents, texts, words


def features(text, longest=2):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return found, [" ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def brute(docs, target, percent=25, least=20):
    """What resample() gives, with dictionaries."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(bucket(f) for _, x in docs for f in features(x)[1]), Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t, rows = sum(s.values()), sum(t.values()), []
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    for doc_id, text in docs:
        found, runs = features(text)
        weight = sum(gain(bucket(f)) for f in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(found)])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for place, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def plain(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=str)


def target(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "item_id long, text string, part string")


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_CHARS", 2000)  # many blocks
    r = random.Random(3)
    vocabulary = [words(1, i) for i in range(300)]
    rows = [(i, " ".join(["the", "THE"][i % 2] if r.random() < 0.3 else r.choice(vocabulary) for _ in range(r.randint(0, 90)))) for i in range(400)]
    wanted = [" ".join(r.choice(vocabulary[:30]) for _ in range(40)) for _ in range(20)] + [None, ""]
    found = resample.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), target(spark, wanted))
    assert plain(found) == brute(rows, wanted)
    drawn = [x for x in plain(found) if x[4]]
    assert len(drawn) == 25 * sum(len(features(t)[0]) >= 20 for _, t in rows) // 100


def test_odd_rows_and_clashing_names(spark):
    rows, wanted = [(r[0], r[1]) for r in texts()], [texts()[0][1]]
    assert plain(resample.resample(documents(spark), target(spark, wanted), percent=60)) == brute(rows, wanted, 60)
    assert resample.resample(documents(spark, []), target(spark, wanted)).collect() == []
    assert plain(resample.resample(documents(spark), target(spark, []))) == brute(rows, [])


def test_one_share_and_slices_of_hot_parts(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_CHARS", 50)
    monkeypatch.setattr(resample, "SLICE_BLOCKS", 3)
    rows = [(i, "same words everywhere " * (i % 9)) for i in range(120)]
    assert plain(resample.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), target(spark, ["same words"]))) == brute(rows, ["same words"])


def test_checksums():
    r = random.Random(1)
    strings = [bytes(r.randrange(256) for _ in range(r.choice([0, 1, 3, 40, 48, 49, 5000]))) for _ in range(200)]
    data = np.frombuffer(b"".join(strings) + b" ", np.uint8)
    lengths = np.array([len(s) for s in strings])
    starts = np.cumsum(lengths) - lengths
    crcs = resample.crc32_spans(data, starts, lengths)
    assert crcs.tolist() == [zlib.crc32(s) for s in strings]
    joined = resample.crc32_join(crcs[:-1], crcs[1:], lengths[1:])
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in zip(strings, strings[1:], strict=False)]
    three = resample.Features(longest=3, buckets=997)
    text = words(200, 5) + " " + "y" * 3000 + " É é"
    buckets, _, n = resample.hashed([text, None, "one"], three)
    assert n.tolist() == [203, 0, 1]
    assert sorted(buckets.tolist()) == sorted(zlib.crc32(f.encode()) % 997 for t in (text, "one") for f in features(t, 3)[1])


def test_postings():
    r = np.random.default_rng(1)
    keys, counts = np.unique(r.integers(0, 20_000_000, 5000)), None
    counts = r.integers(1, 70_000, len(keys))
    again = resample.decode(resample.encode(keys, counts))
    assert (again[0] == keys).all() and (again[1] == counts).all()


def test_batches_of_large_rows_are_bounded_by_bytes(spark):
    """Postings of a part of a block are hundreds of KB: 2,000 of them in a batch would not fit a task."""
    import pyarrow as pa

    from lumbung.llm import common

    common.prepare(spark)
    sizes = spark.range(0, 60, 1, 1).selectExpr("cast(repeat('x', 500000) as binary) as x").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
    found = [r["n"] for r in sizes.collect()]
    assert sum(found) >= 30_000_000 and max(found) <= common.BATCH_BYTES + 1_000_000
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    common.prepare(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
