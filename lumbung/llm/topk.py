"""Exact top-k inner products of a query set against all vectors, over vectors sorted by their length.

1. One pass gives the second moments of all vectors: their singular vectors are the rotation, which puts most of a product in the first coordinates.
2. The longest vectors (SEEDS, of a bounded size) go to every task. A query's k-th best score with them is its threshold from the start, everywhere.
3. Vectors are dealt to superblocks by range of length, in descending order; queries to parts by the length that a vector must have to reach their threshold.
   A part needs only the superblocks up to that length, and a superblock only the parts down to it: other pairs are never sent.
4. A task takes a superblock and a part, and keeps the k best scores of each query so far, which raise its threshold. Rows come in tiles, longest first:

   * a query whose length times the tile's longest vector is below its threshold is done with the superblock;
   * the product of the first rotated coordinates, plus the product of the lengths of what is left (Cauchy-Schwarz), bounds the score; what stays
     below the threshold is pruned, step by step with more coordinates;
   * the rest is scored exactly, in integers.

Bounds are floats with a margin for rounding, so pruning never loses a result; it saves work only.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, frugal, partitions, prepare

#: Rows of a tile, rows of a superblock, queries of a part.
TILE, SUPERBLOCK, QUERIES = 512, 4096, 2048
#: The most vectors, and the most numbers in them, that give the first thresholds.
SEEDS, SEED_NUMBERS = 2048, 1 << 21
#: Shares of the coordinates after which products are bounded.
STEPS = (0.25, 0.5, 0.75)
#: Lengths of superblocks, and needs of parts, that the driver looks at: every so many-th of them.
MARKS = 1024
#: Share of a tile's pairs below which they are scored one by one, not as a matrix.
SPARSE = 0.05
_NONE = np.iinfo(np.int64).min
_TYPES = ("<i2", "<i4", "<f8")


def quantize(vectors: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and v, floor(scale * x) of each component as double, which holds it exactly; without vectors that are null or have null or non-finite components.

    Empty vectors stay: their products are 0. Null ids are left out.
    """
    infinite = float("inf")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < infinite))
    rows = vectors.select("vec_id", F.when(fine, F.col(vector)).alias("x")).filter("vec_id is not null and x is not null")

    def whole(x):  # noqa: ANN001, ANN202  doubles from 2**53 on are whole, and floor() would make them longs
        y = x.cast("double") * scale
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    return rows.select("vec_id", F.transform("x", whole).alias("v"))


def _matrix(values: list, width: int) -> np.ndarray:
    """Rows of `width` numbers; shorter vectors are filled up with 0."""
    if values and len({len(v) for v in values}) == 1 and len(values[0]) == width:
        return np.stack(values).astype(float)
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def _measure(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows there are, and the right singular vectors of all, from their second moments: width squared numbers of each task."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros((0, 0)), 0
        for b in batches:
            values = b["v"].tolist()
            width = max(map(len, values), default=0)
            if width > len(total):
                total = np.pad(total, (0, width - len(total)))
            x = _matrix(values, len(total))
            with np.errstate(over="ignore", invalid="ignore"):
                total += x.T @ x
            count += len(values)
        yield pd.DataFrame({"i": [-1, *range(len(total))], "row": [[float(count)], *total.tolist()]})

    sums = rows.select("v").mapInPandas(moments, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    found = sums.groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    width = max((r["i"] for r in found), default=-1) + 1
    count, total = 0, np.zeros((max(1, width), max(1, width)))
    for r in found:
        if r["i"] < 0:
            count = int(r["x"])
        else:
            total[r["i"], r["j"]] = r["x"]
    if not np.isfinite(total).all():  # lengths beyond doubles: any rotation is right
        return count, np.eye(len(total))
    return count, np.linalg.eigh(total)[1][:, ::-1].copy()


def products(queries: np.ndarray, rows: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """Exact inner products of whole numbers, held at the ends of a long. wanted: pairs that are needed; others may be anything."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if bound < 2**53:  # doubles hold these integers exactly
        if wanted is None or wanted.mean() > SPARSE:
            return (queries @ rows.T).astype(np.int64)
        out = np.zeros(wanted.shape, np.int64)
        i, j = np.nonzero(wanted)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            out[a, b] = np.einsum("ij,ij->i", queries[a], rows[b]).astype(np.int64)
        return out
    if bound < 2**63:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    out = np.zeros((len(queries), len(rows)), np.int64)
    whole = [[[int(x) for x in row] for row in m.tolist()] for m in (queries, rows)]
    for i, j in zip(*np.nonzero(np.ones(out.shape, bool) if wanted is None else wanted), strict=True):
        out[i, j] = min(2**63 - 1, max(1 - 2**63, sum(x * y for x, y in zip(whole[0][i], whole[1][j], strict=True))))
    return out


class Search:
    """The k best of each of some queries, over tiles of descending length. least: scores below it are of no use."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, least: np.ndarray, rotation: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.least, self.rotation, self.k = ids, queries, least, rotation, k
        self.turned = queries @ rotation
        self.steps = sorted({max(1, int(s * rotation.shape[0])) for s in STEPS} - {rotation.shape[0]})
        self.lengths = _lengths(queries)
        self.rests = [_lengths(self.turned[:, s:]) for s in self.steps]
        self.score = np.full((len(ids), k), _NONE)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.scored = 0  # pairs that were scored exactly

    def tile(self, ids: np.ndarray, rows: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            self._tile(ids, rows)

    def _tile(self, ids: np.ndarray, rows: np.ndarray) -> None:
        # comparisons are such that what is no number is kept
        longest = _lengths(rows).max(initial=0)
        least = np.maximum(self.score[:, -1], self.least).astype(float)
        margin = slack(self.lengths, longest)
        open_ = np.flatnonzero(~(self.lengths * longest + margin < least))
        if not len(open_):
            return
        turned = rows @ self.rotation
        alive = np.ones((len(open_), len(ids)), bool)
        done, partial = 0, np.zeros((len(open_), len(ids)))
        for step, rest in zip(self.steps, self.rests, strict=True):
            partial += self.turned[open_, done:step] @ turned[:, done:step].T
            done = step
            alive &= ~(partial + np.outer(rest[open_], _lengths(turned[:, step:])) + margin[open_, None] < least[open_, None])
            keep = alive.any(1)
            open_, partial, alive = open_[keep], partial[keep], alive[keep]
            if not len(open_):
                return
        some = np.flatnonzero(alive.any(0))
        self._exact(open_, alive[:, some], ids[some], rows[some])

    def _exact(self, open_: np.ndarray, alive: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.scored += int(alive.sum())
        alive = alive & (ids[None, :] != self.ids[open_, None])
        score = np.where(alive, products(self.queries[open_], rows, alive), _NONE)
        least = np.maximum(self.score[open_, -1], self.least[open_])
        if len(ids) > self.k:  # all that are at least as good as the k-th best of the tile
            least = np.maximum(least, np.partition(score, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        good = alive & (score >= least[:, None])
        for q in np.flatnonzero(good.any(1)):
            at = np.flatnonzero(good[q])
            place = open_[q]
            scores = np.concatenate([self.score[place], score[q, at]])
            found = np.concatenate([self.found[place], ids[at]])
            best = np.lexsort((found, ~scores))[: self.k]  # ~x falls as x grows, and never overflows
            self.score[place], self.found[place] = scores[best], found[best]

    def results(self) -> pd.DataFrame:
        query, place = np.nonzero(self.found != np.iinfo(np.int64).max)
        return pd.DataFrame({"query_id": self.ids[query], "vec_id": self.found[query, place], "score": self.score[query, place]})


def slack(lengths: np.ndarray, longest: float) -> np.ndarray:
    """More than rounding can take from a bound of products with vectors of that length."""
    return 1e-6 * (1 + lengths * longest)


def thresholds(ids: np.ndarray, queries: np.ndarray, seed_ids: np.ndarray, seeds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each query the k-th best score with the seeds, which no result is below, and the length that a vector needs to reach it. seeds: the longest vectors."""
    least = np.full(len(ids), _NONE)
    with np.errstate(all="ignore"):
        lengths, longest = _lengths(queries), _lengths(seeds).max(initial=0)
        if len(seeds) > k:
            score = np.where(ids[:, None] != seed_ids[None, :], products(queries, seeds), _NONE)
            least = np.partition(score, len(seeds) - k, axis=1)[:, len(seeds) - k]
        need = (least.astype(float) - 2 * slack(lengths, longest)) / lengths
    return least, np.where(np.isfinite(need) & (least > _NONE) & (lengths > 0), need, -np.inf)


def _pack(ids: np.ndarray, rows: np.ndarray, least: np.ndarray | None = None) -> bytes:
    """Ids, rows in the smallest type that holds them, and thresholds."""
    most = np.abs(rows).max(initial=0)
    kind = 0 if most < 2**15 else 1 if most < 2**31 else 2
    last = b"" if least is None else least.astype("<i8").tobytes()
    return struct.pack("<qqq", kind, *rows.shape) + ids.astype("<i8").tobytes() + rows.astype(_TYPES[kind]).tobytes() + last


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind, n, width = struct.unpack_from("<qqq", data)
    rows = np.frombuffer(data, _TYPES[kind], n * width, 24 + 8 * n)
    return np.frombuffer(data, "<i8", n, 24), rows.reshape(n, width).astype(float), np.frombuffer(data, "<i8", -1, 24 + 8 * n + rows.nbytes)


def _marks(rows: DataFrame, place: str, value: str, count: int) -> list[tuple[int, float]]:
    """(place, value) of every so many-th place, MARKS at most."""
    every = -(-count // MARKS)
    return sorted((r[0], r[1]) for r in rows.filter(f"{place} % {every} = 0").select(place, value).distinct().collect())


def _last(marks: list[tuple[int, float]], value: float, count: int, falling: bool) -> int:
    """The last place that may be needed: before the first mark that is past the value."""
    return next((at - 1 for at, x in marks if (x < value if falling else x > value)), count - 1)


def search(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with the rows of other ids; ties to the smaller vec_id.

    Both have vec_id and v, an array of whole numbers (as of quantize()). Vectors of different lengths are filled up with zeros. A query with
    fewer than k other rows gets them all. Of queries that share an id the smallest vector counts; rows that share one are each a
    candidate. Scores beyond a long count as its ends. Empty tables give no rows.
    """
    spark = prepare(rows.sparkSession)
    count, rotation = _measure(rows.select("v").union(queries.select("v")))
    width = rotation.shape[0]
    shared = spark.sparkContext.broadcast(rotation)  # width squared numbers
    blocks = max(1, min(-(-count // SUPERBLOCK), 1 << 20))
    blocks = max(blocks, min(partitions(spark), -(-count // TILE)))
    many = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    parts = max(1, -(-many.count() // QUERIES))

    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    ordered = rows.select("vec_id", "v", length.alias("length"))
    longest = ordered.orderBy(F.col("length").desc(), "vec_id").limit(max(k + 1, min(SEEDS, SEED_NUMBERS // width))).collect()
    seeds = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in longest], np.int64), _matrix([np.array(r["v"]) for r in longest], width)))  # at most SEED_NUMBERS numbers

    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a range of lengths, in order, to packed tiles."""
        ids, rows_ = np.zeros(0, np.int64), np.zeros((0, width))
        number = 0

        def packed(tile_ids: np.ndarray, tile: np.ndarray) -> tuple[int, bytes, float]:
            with np.errstate(over="ignore"):
                return number, _pack(tile_ids, tile), float(_lengths(tile).max())

        for b in batches:
            ids, rows_ = np.concatenate([ids, b["vec_id"].to_numpy(np.int64)]), np.concatenate([rows_, _matrix(b["v"].tolist(), width)])
            out = []
            while len(ids) >= TILE:
                out.append(packed(ids[:TILE], rows_[:TILE]))
                ids, rows_, number = ids[TILE:], rows_[TILE:], number + 1
            yield pd.DataFrame(out, columns=["number", "data", "longest"])
        if len(ids):
            yield pd.DataFrame([packed(ids, rows_)], columns=["number", "data", "longest"])

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries with their thresholds."""
        for b in batches:
            least, need = thresholds(b["vec_id"].to_numpy(np.int64), _matrix(b["v"].tolist(), width), *seeds.value, k)
            yield b.assign(least=least, need=need)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A part's queries, packed by batch."""
        for number, b in enumerate(batches):
            if len(b):
                data = _pack(b["vec_id"].to_numpy(np.int64), _matrix(b["v"].tolist(), width), b["least"].to_numpy(np.int64))
                yield pd.DataFrame({"number": [-1 - number], "data": [data], "need": [b["need"].min()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Over rows sorted by superblock and part: first the queries of both, then the tiles in order."""
        key, now = None, None
        for b in batches:
            out = []
            for superblock, part, number, data in b[["superblock", "part", "number", "data"]].itertuples(index=False, name=None):
                if (superblock, part) != key:
                    out += [now.results()] if isinstance(now, Search) else []
                    key, now = (superblock, part), []
                ids, matrix, least = _unpack(data)
                if number < 0:
                    now.append((ids, matrix, least))
                    continue
                if isinstance(now, list):
                    now = Search(*(np.concatenate(x) for x in zip(*now, strict=True)), shared.value, k) if now else None
                if now is not None:
                    now.tile(ids, matrix)
            yield pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if isinstance(now, Search):
            yield now.results()

    ranged = ordered.repartitionByRange(blocks, F.col("length").desc(), "vec_id").sortWithinPartitions(F.col("length").desc(), "vec_id")
    data = ranged.select("vec_id", "v").mapInPandas(frugal(tiles), "number int, data binary, longest double").withColumn("superblock", F.spark_partition_id())
    data = cut(data)  # which rows a superblock has is fixed from here on
    asked = many.mapInPandas(begin, "vec_id long, v array<double>, least long, need double").repartitionByRange(parts, "need", "vec_id")
    asked = cut(asked.mapInPandas(gather, "number int, data binary, need double").withColumn("part", F.spark_partition_id()))
    heights = _marks(data.groupBy("superblock").agg(F.max("longest").alias("longest")), "superblock", "longest", blocks)
    needs = _marks(asked.groupBy("part").agg(F.min("need").alias("need")), "part", "need", parts)
    last_block = F.udf(lambda need: _last(heights, need, blocks, True), "int")  # a few rows: one for each batch of queries, and each tile
    last_part = F.udf(lambda high: _last(needs, high, parts, False), "int")
    left = asked.withColumn("last", last_block("need")).filter("last >= 0").withColumn("superblock", F.explode(F.expr("sequence(0, last)"))).select("superblock", "part", "number", "data")
    right = data.withColumn("last", last_part("longest")).filter("last >= 0").withColumn("part", F.explode(F.expr("sequence(0, last)"))).select("superblock", "part", "number", "data")
    met = left.union(right).repartition(max(partitions(spark), min(blocks * parts, 4 * partitions(spark))), "superblock", "part").sortWithinPartitions("superblock", "part", "number")
    found = met.mapInPandas(frugal(run), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
with fine as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
  from fine q join fine c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 5
"""
