"""Exact dedup as Grace hash dedup: records are partitioned to spill files until each bucket fits an open-addressing table that compares whole contents.

1. Each task puts its rows through a table of bounded size first, so a text that many rows share leaves it as one record with its number of rows, its largest id
   and its list of ids. Records are written as Parquet to the shared folder: the spill.
2. Records, without their ids, are dealt to buckets by hash. A task goes through its buckets one after the other, in the order of the shuffle, with a table for each. A bucket with
   more distinct content than a table may hold resolves what its table has; the other records are written as the next spill and partitioned again, by another hash, until
   none is left. Repeated contents fill no table, so a hot text ends no bucket.
3. What buckets say of records is joined back to the records' ids, a key that no two records share, and ids are listed again.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, frugal, land, partitions, prepare
from .hashing import LOWER

#: Bytes of distinct content that a bucket's table holds, and that buckets are planned for: the first is larger, so that chance alone overfills none.
TABLE_BYTES, BUCKET_BYTES = 64 << 20, 24 << 20
#: Bytes of distinct content and rows after which a task writes its records.
FLUSH_BYTES, FLUSH_ROWS = 8 << 20, 20_000

_RECORD = "rid long, hash long, size long, digest string, rows long, max_id long, ids array<long>, content binary"
_RESULT = "rid long, open boolean, keep_id long, group_size long, wins boolean, hash long, size long, rows long, max_id long, content binary"


class Table:
    """Open addressing with linear probing over contents: equal hashes are not enough, the whole content is compared. Up to `most` bytes of content."""

    def __init__(self, most: int | None = None) -> None:
        self.most, self.bytes, self.hashes, self.contents, self.slots = most, 0, [], [], [-1] * 64

    def find(self, key: int, content: bytes) -> int:
        """The entry of the content, a new one if it has none; -1 if there is no room for it. The first content always has."""
        slots, mask = self.slots, len(self.slots) - 1
        at = key & mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == key and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        if self.most is not None and self.contents and self.bytes + len(content) > self.most:
            return -1
        slots[at] = len(self.contents)
        self.hashes.append(key)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        size = 4 * len(self.slots)
        self.slots = [-1] * size
        for entry, key in enumerate(self.hashes):
            at = key & (size - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slots[at] = entry


def _larger(a: int | None, b: int | None) -> bool:
    """Whether a is above b; nulls are below all."""
    return a is not None and (b is None or a > b)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _records(flush_bytes: int, flush_rows: int):  # noqa: ANN202
    """Rows (doc_id, text) to records of distinct normalised content; the first of a record's ids is the largest, nulls come last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count((TaskContext.get().partitionId() if TaskContext.get() else 0) << 33)
        schema = pa.schema([("rid", pa.int64()), ("hash", pa.int64()), ("size", pa.int64()), ("digest", pa.string()), ("rows", pa.int64()), ("max_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("content", pa.binary())])
        table, digests, ids, held = Table(), [], [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for some in itertools.batched(range(len(ids)), 2000):
                listed = [sorted(ids[e], key=lambda i: (i is None, -(i or 0))) for e in some]
                columns = [[next(number) for _ in some], [_signed(table.hashes[e]) for e in some], [len(table.contents[e]) for e in some], [digests[e] for e in some], [len(x) for x in listed], [x[0] for x in listed], listed, [table.contents[e] for e in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                content = (text or "").encode().translate(LOWER)
                digest = hashlib.sha256(content)
                entry = table.find(int.from_bytes(digest.digest()[:8], "little"), content)
                if entry == len(ids):
                    ids.append([])
                    digests.append(digest.hexdigest())
                ids[entry].append(doc_id)
                held += 1
                if table.bytes >= flush_bytes or held >= flush_rows:
                    yield from flushed()
                    table, digests, ids, held = Table(), [], [], 0
        yield from flushed()

    return run


class _Bucket:
    """A bucket's table and what its records say of each content."""

    def __init__(self, number: int | None, most: int) -> None:
        self.number, self.table, self.groups = number, Table(most), []

    def take(self, key: int, rid: int, rows: int, max_id: int | None, content: bytes) -> bool:
        """Whether the record could be resolved here."""
        entry = self.table.find(key, content)
        if entry < 0:
            return False
        if entry == len(self.groups):
            self.groups.append([[rid], rows, max_id, rid])
            return True
        group = self.groups[entry]
        group[0].append(rid)
        group[1] += rows
        if _larger(max_id, group[2]) or (max_id == group[2] and rid < group[3]):
            group[2], group[3] = max_id, rid
        return True

    def done(self) -> Iterator[tuple]:
        """rid, keep_id, group_size and whether it has the row that stays, of each record that was resolved."""
        for rids, rows, max_id, winner in self.groups:
            for rid in rids:
                yield rid, max_id, rows, rid == winner


def _resolved(most: int):  # noqa: ANN202
    """Records sorted by bucket to results, and the records that did not fit as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rid", pa.int64()), ("open", pa.bool_()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("wins", pa.bool_()), ("hash", pa.int64()), ("size", pa.int64()), ("rows", pa.int64()), ("max_id", pa.int64()), ("content", pa.binary())])
        batched = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        bucket = _Bucket(None, most)
        for batch in batches:
            left = []
            for number, rid, key, size, rows, max_id, content in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if number != bucket.number:
                    for some in itertools.batched(bucket.done(), 10_000):
                        yield batched([(rid_, False, keep, total, wins, None, None, None, None, None) for rid_, keep, total, wins in some])
                    bucket = _Bucket(number, most)
                if not bucket.take(key & 0xFFFFFFFFFFFFFFFF, rid, rows, max_id, content):
                    left.append((rid, True, None, None, None, key, size, rows, max_id, content))
            if left:
                yield batched(left)
        for some in itertools.batched(bucket.done(), 10_000):
            yield batched([(rid, False, keep, total, wins, None, None, None, None, None) for rid, keep, total, wins in some])

    return run


def _partitioned(spark: SparkSession, spill: DataFrame, level: int, most: int, bucket_bytes: int) -> DataFrame:
    """A level's results: its records are dealt to as many buckets as their bytes take, each gone through by one task with a table."""
    n = partitions(spark)
    planned = (spill.agg(F.sum("size")).first()[0] or 0) // bucket_bytes
    buckets = max(n, planned + 1)
    rows = spill.select(F.pmod(F.xxhash64("hash", F.lit(level)), F.lit(buckets)).alias("bucket"), "rid", "hash", "size", "rows", "max_id", "content")
    dealt = rows.repartition(max(n, min(buckets, planned // 4 + 1)), "bucket").sortWithinPartitions("bucket")
    return land(dealt.mapInArrow(frugal(_resolved(most)), _RESULT), f"buckets-{level}")


def groups(docs: DataFrame, *, table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES, flush_bytes: int = FLUSH_BYTES, flush_rows: int = FLUSH_ROWS) -> DataFrame:
    """A row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    docs: doc_id, text; other columns, whatever their names, are allowed and not kept. Texts are equal that are identical, in every character, after A-Z is lower-cased; null
    counts as empty, and both are equal. Of equal texts the row with the largest id stays; null ids are below all others, so keep_id is null
    only where all are. Where rows share the largest id, exactly one of them is kept. Texts of any length are compared whole; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spill = land(slim.mapInArrow(frugal(_records(flush_bytes, flush_rows)), _RECORD), "records")
    known, waiting = None, spill
    for level in itertools.count():
        results = _partitioned(spark, waiting, level, table_bytes, bucket_bytes)
        done = results.filter(~F.col("open")).select("rid", "keep_id", "group_size", "wins")
        known = done if known is None else known.union(done)
        waiting = results.filter("open")
        if waiting.isEmpty():
            break
    listed = spill.select("rid", "digest", "ids").join(known, "rid").select("keep_id", "group_size", "wins", "digest", F.posexplode("ids").alias("place", "doc_id"))
    return listed.select("doc_id", "keep_id", "group_size", (F.col("wins") & (F.col("place") == 0)).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts, that with the largest id; all columns stay as they are.

    Of rows that share that id and the text, one stays. Otherwise as groups().
    """
    a, b = free_name(docs, "__kept_id"), free_name(docs, "__kept_digest")
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)
    stays = groups(docs).filter("kept").select(F.col("doc_id").alias(a), F.col("text_sha256").alias(b))
    marked = docs.withColumn(b + "_", digest)
    found = marked.join(stays, marked["doc_id"].cast("long").eqNullSafe(stays[a]) & (marked[b + "_"] == stays[b]), "left_semi")
    return found.dropDuplicates(["doc_id", b + "_"]).select(docs.columns)


ORACLE_SQL = """
with rows as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as content from documents),
ranked as (
  select doc_id, content, row_number() over (partition by content order by doc_id desc nulls last) as place,
    max(doc_id) over (partition by content) as keep_id, count(*) over (partition by content) as group_size from rows)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(content) as text_sha256 from ranked
"""
