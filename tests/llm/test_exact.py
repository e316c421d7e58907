import hashlib
import random
from collections import defaultdict

from lumbung.llm import exact

from .fixtures import documents, texts, words


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """What groups() gives, with dictionaries."""
    same = defaultdict(list)
    for doc_id, text in rows:
        same[lowered(text)].append(doc_id)
    out = []
    for content, ids in same.items():
        ids = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        out += [(i, ids[0], len(ids), place == 0, hashlib.sha256(content.encode()).hexdigest()) for place, i in enumerate(ids)]
    return sorted(out, key=str)


def plain(df):
    return sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()), key=str)


def copies(n, seed):
    """Rows of which a third have one text, others a few copies, some in other cases."""
    r = random.Random(seed)
    made = [words(r.randint(1, 60), i) for i in range(n // 4)]
    rows = [(i, "Hot Text" if r.random() < 0.33 else r.choice(made)) for i in range(n)]
    return [(i, t.upper() if r.random() < 0.2 else t) for i, t in rows]


def frame(spark, rows, parts=6):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def test_against_brute_force(spark):
    rows = copies(3000, 1)
    assert plain(exact.groups(frame(spark, rows))) == brute(rows)


def test_buckets_that_do_not_fit_are_partitioned_again(spark):
    rows = copies(1200, 2)
    small = exact.groups(frame(spark, rows), table_bytes=2000, bucket_bytes=1 << 20, flush_bytes=3000, flush_rows=40)
    assert plain(small) == brute(rows)


def test_odd_rows_and_clashing_names(spark):
    rows = [(r[0], r[1]) for r in texts()]
    assert plain(exact.groups(documents(spark))) == brute(rows)
    assert exact.groups(documents(spark, [])).collect() == []
    odd = [(None, "x"), (None, "X"), (2**53 + 1, "y"), (2**53, "y"), (None, "y"), (5, None), (5, ""), (-1, "É"), (-2, "é"), (0, "É")]
    assert plain(exact.groups(frame(spark, odd, 3))) == brute(odd)


def test_equal_hashes_are_not_enough():
    table = exact.Table()
    assert [table.find(7, c) for c in (b"a", b"b", b"a", b"", b"b")] == [0, 1, 0, 2, 1]
    for i in range(1000):
        assert table.find(i % 3, b"%d" % i) == 3 + i
    full = exact.Table(4)
    assert [full.find(1, c) for c in (b"longer than it may be", b"x", b"longer than it may be")] == [0, -1, 0]


def test_drop_copies(spark):
    docs = documents(spark, [*texts(), (20, "ONE", "en", "x")])
    kept = exact.drop_copies(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns and sorted((r["doc_id"] or -1) for r in rows) == [-1, 2, 3, 5, 6, 7, 9, 10, 11, 20]
    assert [r["text"] for r in rows if r["doc_id"] == 20] == ["ONE"]
