"""Resampling by importance towards a target distribution, over inverted postings that are partitioned by bucket.

Features are runs of words, hashed to buckets. How much likelier a bucket is in the target corpus than in the documents is its gain; the gains of a document's features,
averaged, and Gumbel noise of its id are its score, and the highest scores are a weighted sample without replacement.

1. Documents are cut into blocks of up to BLOCK_DOCS. A block's postings (bucket, document, count), sorted, are written by part, a range of buckets: differences of sorted
   keys and counts, byte by byte, a few bytes a posting. Beside them stand each block's totals by bucket. The target corpus gives totals only.
2. Postings are shuffled by part; the totals of both corpora, added up before, go with them, and each part's gains are made where its postings are. A part's blocks are
   dealt to as many tasks as it takes, each of at most SLICE_BLOCKS, and pass one by one, so a word of all documents is no hot spot.
3. Each block leaves a part as one vector, what its documents gain there; a block's vectors, one a part, are added up beside its ids.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, land, partitions, prepare
from .hashing import PLAIN, SPACE, chunks

#: Documents of a block and characters of its texts about; ranges of buckets; blocks that a task of the second step has at most.
BLOCK_DOCS, BLOCK_CHARS, PARTS, SLICE_BLOCKS = 2000, 1 << 22, 48, 512

#: kind 0: a block's documents; 1: its totals of a part; 2: its postings of a part.
_MADE = "kind int, block long, part int, ids array<long>, lengths array<long>, n_features array<long>, buckets array<int>, totals array<long>, postings binary"


@dataclass(frozen=True)
class Features:
    """Runs of 1 to `longest` words, hashed to `buckets`."""

    longest: int = 2
    buckets: int = 10_000


# --- CRC-32 of many byte strings at once


@cache
def _table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


@cache
def _after(bit: int) -> np.ndarray:
    """What 2**bit zero bytes after it make of each byte of a checksum: four tables, one for each place."""
    if bit == 0:
        place = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]).astype(np.uint32)
        return (place >> np.uint32(8)) ^ _table()[place & np.uint32(255)]
    half = _after(bit - 1)
    return _through(half, half)


def _through(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    return tables[0][values & low] ^ tables[1][(values >> np.uint32(8)) & low] ^ tables[2][(values >> np.uint32(16)) & low] ^ tables[3][values >> np.uint32(24)]


def crc32_join(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of strings put together, of the checksums of both parts and the right one's lengths."""
    moved = left.copy()
    for bit in range(int(lengths.max(initial=0)).bit_length()):
        some = np.flatnonzero((lengths >> bit) & 1)
        moved[some] = _through(_after(bit), moved[some])
    return moved ^ right


def crc32_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, *, long: int = 48) -> np.ndarray:
    """CRC-32 of parts of data: byte by byte over all parts at once, for those of up to `long` bytes."""
    found = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    sized, table = lengths[order], _table()
    short = order[: np.searchsorted(sized, long, "right")]
    sized, begins, state = sized[: len(short)], starts[short], np.full(len(short), 0xFFFFFFFF, np.uint32)
    for k in range(int(sized[-1]) if len(sized) else 0):
        first = np.searchsorted(sized, k, "right")
        now = state[first:]
        state[first:] = table[(now ^ data[begins[first:] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    found[short] = ~state
    for i in order[len(short) :]:
        found[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]])
    return found


def hashed(texts: Sequence[str | None], features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each feature with the place of its text, and the number of words of each text."""
    raw = [(t or "").encode().translate(PLAIN) for t in texts]
    base = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=base[1:])
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], SPACE[data], [True])).astype(np.int8)))
    starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
    first = np.searchsorted(starts, base)
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(raw)), n_words)
    word = crc32_spans(data, starts, lengths)
    spaced = crc32_join(word, np.full(len(word), zlib.crc32(b" "), np.uint32), np.ones(len(word), np.int64))  # a word and the blank after it
    crcs, owners, run = [word], [text], word
    for n in range(2, features.longest + 1):
        # a run of n words is a word and its blank before the run of n - 1 words that begins at the next
        tail = lengths[n - 1 :] + (n - 2)
        for k in range(1, n - 1):
            tail = tail + lengths[k : len(lengths) - (n - 1 - k)]
        run = crc32_join(spaced[: max(len(word) - n + 1, 0)], run[1:], tail)
        inside = text[: len(run)] == text[n - 1 :]
        crcs.append(run[inside])
        owners.append(text[: len(run)][inside])
    return np.concatenate(crcs) % np.uint32(features.buckets), np.concatenate(owners), n_words


# --- postings


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers, all lowest bytes first: most others are zero and vanish when blocks are compressed."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def encode(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Postings of a block and a part: differences of the sorted keys (bucket * BLOCK_DOCS + document), then counts."""
    return _packed(np.concatenate((np.diff(keys, prepend=0), counts)))


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = _unpacked(data)
    return np.cumsum(both[: len(both) // 2], dtype=np.int64), both[len(both) // 2 :].astype(np.int64)


def edges(features: Features) -> np.ndarray:
    """The buckets at which parts begin, and the end."""
    return np.linspace(0, features.buckets, PARTS + 1).astype(np.int64)


_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_features", pa.list_(pa.int64())), ("buckets", pa.list_(pa.int32())), ("totals", pa.list_(pa.int64())), ("postings", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _blocks(features: Features, postings: bool):  # noqa: ANN202
    """Rows (doc_id, text) to rows of _MADE; without postings, totals alone."""

    def block(number: int, ids: list, texts: list) -> pa.RecordBatch:
        found = [hashed(texts[a:b], features) for a, b in chunks(texts)]
        bases = np.cumsum([0, *[len(f[2]) for f in found]])
        keys = np.concatenate([f[0].astype(np.uint32) * np.uint32(BLOCK_DOCS) + (f[1] + base).astype(np.uint32) for f, base in zip(found, bases, strict=False)])
        keys.sort()
        new = np.flatnonzero(np.diff(keys, prepend=np.uint32(0xFFFFFFFF)) != 0)
        keys, counts = keys[new].astype(np.int64), np.diff(np.append(new, len(keys)))
        n_words = np.concatenate([f[2] for f in found])
        n_features = sum(np.maximum(n_words - n, 0) for n in range(features.longest))
        rows = [(0, number, -1, ids, n_words.tolist(), n_features.tolist(), None, None, None)] if postings else []
        bounds, buckets = edges(features), keys // BLOCK_DOCS
        for part, (a, b) in enumerate(zip(np.searchsorted(buckets, bounds[:-1]), np.searchsorted(buckets, bounds[1:]), strict=True)):
            if a < b:
                own, at = np.unique(buckets[a:b], return_index=True)
                rows.append((1, number, part, None, None, None, own, np.add.reduceat(counts[a:b], at), None))
                if postings:
                    rows.append((2, number, part, None, None, None, None, None, encode(keys[a:b], counts[a:b])))
        return _batch(rows, _SCHEMA) if rows else pa.RecordBatch.from_pylist([], _SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "")
                if len(ids) == BLOCK_DOCS or held >= BLOCK_CHARS:
                    yield block(number, ids, texts)
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield block(number, ids, texts)

    return run


def _totals(made: DataFrame, name: str) -> DataFrame:
    """part, bucket and a corpus' features in it: a row a bucket, added up before it is shuffled."""
    each = made.filter("kind = 1").select("part", F.explode(F.arrays_zip("buckets", "totals")).alias("x"))
    return each.groupBy("part", F.col("x.buckets").alias("bucket")).agg(F.sum("x.totals").alias(name))


def gain(s: int, t: int, all_s: int, all_t: int, buckets: int) -> int:
    """1000 times the logarithm of how much likelier a bucket is in the target, both smoothed by one, floored."""
    return math.floor(1000 * math.log(((t + 1) * (all_s + buckets)) / ((s + 1) * (all_t + buckets))))


def _contributions(features: Features, all_s: int, all_t: int):  # noqa: ANN202
    """Rows kind, block, part, buckets, s, t, postings, sorted by part and kind, to a block's vector of what its documents gain in a part."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("gains", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bounds, gains = None, edges(features), None
        for batch in batches:
            out = []
            for kind, number, at, buckets, s, t, postings in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if at != part:
                    part, gains = at, np.zeros(int(bounds[at + 1] - bounds[at]), np.int64)
                if kind == 1:
                    for bucket, x, y in zip(buckets, s, t, strict=True):
                        gains[bucket - bounds[at]] = gain(x, y, all_s, all_t, features.buckets)
                else:
                    keys, counts = decode(postings)
                    buckets_, docs = np.divmod(keys, BLOCK_DOCS)
                    sums = np.zeros(BLOCK_DOCS, np.int64)
                    np.add.at(sums, docs, counts * gains[buckets_ - bounds[at]])
                    out.append((number, at, sums[: docs.max() + 1].tobytes()))
            if out:
                yield _batch(out, schema)

    return run


_EACH = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows block, part, ids, lengths, n_features, gains, sorted by block and part, whose documents come first, to a row for each document."""

    def done(block: tuple) -> pa.RecordBatch:
        ids, lengths, n_features, sums = block
        n = np.array(n_features, np.int64)
        weight = np.where(n > 0, sums[: len(ids)] // np.maximum(n, 1), 0)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, lengths, n, weight)], schema=_EACH)

    current, held = None, None
    for batch in batches:
        for number, part, ids, lengths, n_features, gains in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if number != current:
                if held:
                    yield done(held)
                current, held = number, (ids, lengths, n_features, np.zeros(BLOCK_DOCS, np.int64))
            if part >= 0:
                vector = np.frombuffer(gains, np.int64)
                held[3][: len(vector)] += vector
    if held:
        yield done(held)


def weights(docs: DataFrame, target: DataFrame, features: Features = Features()) -> DataFrame:  # noqa: B008  it is frozen
    """A row for each row of docs: doc_id, n_words, n_features and weight, the floored mean of its features' gains (0 without any).

    docs: doc_id, text; target: text; other columns, whatever their names, are allowed and not kept. Null texts have no words, texts of any length are read whole, null and
    repeated ids are rows of their own. Without documents there are no rows; without a target, or one without words, every gain is as the smoothing has it.
    """
    spark = prepare(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = land(slim.mapInArrow(frugal(_blocks(features, True)), _MADE), "postings")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text").mapInArrow(frugal(_blocks(features, False)), _MADE)
    both = land(_totals(made, "s").join(_totals(wanted, "t"), ["part", "bucket"], "full"), "totals").na.fill(0)  # a row a bucket at most
    all_s, all_t, blocks = *both.agg(F.sum("s"), F.sum("t")).first(), made.filter("kind = 0").count()
    slices = max(1, -(-blocks // SLICE_BLOCKS), -(-partitions(spark) // PARTS))
    n = max(partitions(spark), min(PARTS * slices, 10 * partitions(spark)))
    each = F.struct("bucket", "s", "t")
    counts = both.groupBy("part").agg(F.collect_list(each).alias("x")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))  # a part has buckets / PARTS of them
    counts = counts.select(F.lit(1).alias("kind"), F.lit(None).cast("long").alias("block"), "part", "slice", F.col("x.bucket").alias("buckets"), F.col("x.s").alias("s"), F.col("x.t").alias("t"), F.lit(None).cast("binary").alias("postings"))
    nothing = F.lit(None).cast("array<bigint>")
    dealt = F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int")
    posted = made.filter("kind = 2").select("kind", "block", "part", dealt.alias("slice"), F.lit(None).cast("array<int>").alias("buckets"), nothing.alias("s"), nothing.alias("t"), "postings")
    met = counts.union(posted).repartition(n, "part", "slice").sortWithinPartitions("part", "slice", "kind").select("kind", "block", "part", "buckets", "s", "t", "postings")
    gained = met.mapInArrow(frugal(_contributions(features, all_s or 0, all_t or 0)), "block long, part int, gains binary")
    sides = gained.select("block", "part", nothing.alias("ids"), nothing.alias("lengths"), nothing.alias("n_features"), "gains")
    docs_of = made.filter("kind = 0").select("block", "part", "ids", "lengths", "n_features", F.lit(None).cast("binary").alias("gains"))
    placed = docs_of.union(sides).repartition(partitions(spark), "block").sortWithinPartitions("block", "part")
    return placed.mapInArrow(frugal(_reduced), "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, salt: int = 7) -> Column:
    """Gumbel noise of an id, times 1000, floored: always the same for the same id and salt."""
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """rows with rank, 1 to `drawn` in the order of score (highest first) and doc_id, null after that. Ranges of the order are numbered each, and their counts, a row each, added up."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    dealt = land(rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "scores")
    part = F.shiftright("__at", 33)
    counts = dealt.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("__part", before.alias("__start"))
    placed = dealt.withColumn("__part", part).join(F.broadcast(starts), "__part")
    rank = (F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")
    return placed.withColumn("rank", F.when(rank <= drawn, rank)).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 25, least_words: int = 20, features: Features = Features(), salt: int = 7) -> DataFrame:  # noqa: B008
    """A row for each row of docs: doc_id, n_features, weight, score and rank, its place among those that are drawn, or null.

    `percent` of the documents with at least `least_words` words are drawn, rounded down: those with the highest scores, ties to the smaller id. Null ids come last
    among ties and share the noise of an empty id; rows that share an id share its noise. Otherwise as weights().
    """
    scored = land(weights(docs, target, features).withColumn("score", F.col("weight") + noise(F.col("doc_id"), salt)), "weights")
    fit = scored.filter(F.col("n_words") >= least_words)
    ranked = _ranked(fit.drop("n_words"), percent * fit.count() // 100)
    rest = scored.filter(F.col("n_words") < least_words).drop("n_words").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


_FEATURES_SQL = """
  select {key}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as feature
  from (select {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from {table})"""

ORACLE_SQL = f"""
with docs as (select row_number() over () as rid, doc_id, text from documents),
table_ as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as crcs),
doc_features as ({_FEATURES_SQL.format(key="rid", table="docs")}),
target_features as ({_FEATURES_SQL.format(key="item_id", table="benchmark")}),
known as (select distinct feature from (select feature from doc_features union all select feature from target_features)),
bytes as (
  select feature, list_transform(range(len(h) // 2), lambda i: 16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) as b
  from (select feature, hex(encode(feature)) as h from known)),
hashed as (
  select feature, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(b, lambda x: x::bigint)), lambda c, x: xor(c // 256, crcs[xor(c % 256, x) + 1])), 4294967295) % 10000 as bucket
  from bytes, table_),
s as (select bucket, count(*) as s from doc_features join hashed using (feature) group by 1),
t as (select bucket, count(*) as t from target_features join hashed using (feature) group by 1),
sums as (select (select count(*) from doc_features) as all_s, (select count(*) from target_features) as all_t),
gains as (
  select bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::double * (all_s + 10000)::double) / ((coalesce(s, 0) + 1)::double * (all_t + 10000)::double)))::bigint as gain
  from (s full join t using (bucket)), sums),
weighed as (select rid, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight from doc_features join hashed using (feature) join gains using (bucket) group by 1),
hexed as (
  select rid, doc_id, substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8) as h,
    len(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as n_words from docs),
scored as (
  select doc_id, n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((list_reduce(list_prepend(0::bigint, list_transform(range(1, 9), lambda i: instr('0123456789abcdef', h[i]) - 1)), lambda a, x: 16 * a + x) + 0.5::double) / 4294967296::double)))::bigint as score
  from hexed left join weighed using (rid)),
fit as (select *, row_number() over (order by score desc, doc_id nulls last, weight desc, n_features desc) as place, count(*) over () as n from scored where n_words >= 20)
select doc_id, n_features, weight, score, case when place <= 25 * n // 100 then place end as rank from fit
union all select doc_id, n_features, weight, score, null from scored where n_words < 20
"""
