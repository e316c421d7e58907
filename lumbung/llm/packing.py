"""Best-fit packing of tokenized documents into sequences by a grouping genetic algorithm on islands.

Documents are cut into pieces of a sequence's length at most. Pieces that fill a sequence are one; the others are dealt by
their row number to cells of about CELL pieces. A cell is packed on several islands, each of which is a row that holds a population of packings:

* an island begins with pieces put best-fit, longest first, and in orders near that one;
* crossover injects whole well-filled bins of one packing into another, takes out the bins that hold a duplicate, and puts the displaced
  pieces back best-fit, longest first;
* mutation dissolves some of the emptiest bins in the same way;
* after each epoch an island's best packing goes to the next island of its cell.

An island evolves until it has as few bins as its tokens need. Of all cells the best filled bins stay, those with half of the pieces or more: full ones at first. The others are opened again and
their pieces dealt to new cells; when what is left is one task's worth it is packed as a single cell. So what cells lose at their ends is lost once, not once a cell.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import cut, frugal, map_texts, partitions, prepare
from .tokens import CHUNK, Encoder

#: Pieces of a cell; islands, epochs, generations an epoch, packings of an island.
CELL, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3000, 3, 2, 4, 5
#: Pieces up to which the rest of all cells is packed as one cell, by one task an island.
LAST = 20_000

_ENCODERS: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut_pieces(docs: DataFrame, length: int = 2048, tokenizer: str | None = None, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of each row of docs (doc_id, text), whose ids end with `end`.

    Null and empty texts have the one id `end`. tokenizer: a path that exists on every executor.
    """
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = tokenizer or default_tokenizer()
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder = _ENCODERS[path]
        for b in batches:
            rows, ids, texts = [], b["doc_id"].tolist(), b["text"].tolist()
            for begin, end in hashing.chunks(texts, CHUNK):
                for doc_id, found in zip(ids[begin:end], encoder.many(texts[begin:end]), strict=True):
                    data = found.tobytes() + tail
                    for i, at in enumerate(range(0, len(data), 4 * length)):
                        part = data[at : at + 4 * length]
                        rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_texts(docs, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(items: list[int], sizes: list[int], capacity: int, bins: list[list[int]], free: list[int]) -> None:
    """Puts items, in order, each into the bin that it fills best, or a new one. free: what is left in each bin."""
    open_ = sorted((f << 24) | i for i, f in enumerate(free) if f > 0)
    for item in items:
        size = sizes[item]
        at = bisect_left(open_, size << 24)
        if at == len(open_):
            i = len(bins)
            bins.append([item])
            free.append(capacity - size)
        else:
            i = open_.pop(at) & 0xFFFFFF
            bins[i].append(item)
            free[i] -= size
        if free[i] > 0:
            insort(open_, (free[i] << 24) | i)


def fitness(free: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins that are either full or empty."""
    return -len(free), sum((capacity - f) ** 2 for f in free) / capacity**2


class Island:
    """A population of packings, best first; each is (fitness, bins, free)."""

    def __init__(self, sizes: list[int], capacity: int, seed: int) -> None:
        self.sizes, self.capacity, self.random = sizes, capacity, random.Random(seed)
        self.least = max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))
        self.packings: list[tuple] = []

    def add(self, bins: list[list[int]], free: list[int] | None = None) -> None:
        free = free or [self.capacity - sum(self.sizes[i] for i in b) for b in bins]
        self.packings.append((fitness(free, self.capacity), bins, free))
        self.packings.sort(key=lambda p: p[0], reverse=True)
        del self.packings[POPULATION:]

    @property
    def done(self) -> bool:
        return bool(self.packings) and len(self.packings[0][1]) <= self.least

    def begin(self) -> None:
        """Best-fit, longest first; and, unless that is as good as can be, in orders of which each is farther from that one."""
        for number in range(POPULATION):
            noise = 0.15 * number
            order = sorted(range(len(self.sizes)), key=lambda i: -self.sizes[i] * (1 + noise * (self.random.random() - 0.5)))  # noqa: B023  used at once
            bins: list[list[int]] = []
            free: list[int] = []
            best_fit(order, self.sizes, self.capacity, bins, free)
            self.add(bins, free)
            if self.done:
                return

    def _refill(self, bins: list[list[int]], free: list[int], displaced: list[int]) -> None:
        displaced.sort(key=lambda i: -self.sizes[i])
        best_fit(displaced, self.sizes, self.capacity, bins, free)
        self.add(bins, free)

    def cross(self, one: tuple, two: tuple) -> None:
        """Some of the well-filled bins of two go whole into one; bins of one that hold any of their pieces are opened."""
        order = sorted(range(len(two[1])), key=lambda i: two[2][i])
        chosen = [i for i in islice(order, max(1, len(order) // 2)) if self.random.random() < 0.5] or order[:1]
        taken = {x for i in chosen for x in two[1][i]}
        bins, free, displaced = [list(two[1][i]) for i in chosen], [two[2][i] for i in chosen], []
        for b, f in zip(one[1], one[2], strict=True):
            if taken.isdisjoint(b):
                bins.append(list(b))
                free.append(f)
            else:
                displaced += [x for x in b if x not in taken]
        self._refill(bins, free, displaced)

    def mutate(self, one: tuple) -> None:
        """Opens some of the emptiest bins and a few others."""
        order = sorted(range(len(one[1])), key=lambda i: -one[2][i])
        opened = {i for i in order[: max(2, len(order) // 10)] if self.random.random() < 0.7} | {self.random.randrange(len(order)) for _ in range(1 + len(order) // 20)}
        displaced = [x for i in opened for x in one[1][i]]
        kept = [i for i in range(len(order)) if i not in opened]
        self._refill([list(one[1][i]) for i in kept], [one[2][i] for i in kept], displaced)

    def evolve(self, generations: int = GENERATIONS) -> None:
        """Two different parents cross, and the best packing mutates, in each generation. A packing that is as good as can be ends it."""
        for _ in range(generations):
            one, two = self.random.sample(self.packings, 2) if len(self.packings) > 1 else self.packings * 2
            self.cross(one, two)
            self.mutate(self.packings[0])
            if self.done:
                return


def _dump(bins: list[list[int]], n: int) -> bytes:
    """A packing as the bin of each item."""
    out = np.zeros(n, np.uint32)
    for i, b in enumerate(bins):
        out[b] = i
    return out.tobytes()


def _load(data: bytes) -> list[list[int]]:
    of = np.frombuffer(data, np.uint32)
    bins: list[list[int]] = [[] for _ in range(int(of.max(initial=0)) + 1)]
    for i, b in enumerate(of.tolist()):
        bins[b].append(i)
    return [b for b in bins if b]


_STATE = "cell long, island int, packings array<binary>"


def _epoch(islands: DataFrame, capacity: int, first: bool, seed: int) -> DataFrame:
    """An epoch on each row: cell, island, sizes, packings and, but for the first, guest, the best packing of the island before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                sizes = [int(x) for x in row.sizes]
                island = Island(sizes, capacity, (int(row.cell) * ISLANDS + int(row.island)) * 4096 + seed)
                if first:
                    island.begin()
                else:
                    for p in [*row.packings, *([row.guest] if row.guest is not None else [])]:
                        island.add(_load(p))
                if not island.done:
                    island.evolve()
                out.append((row.cell, row.island, [_dump(p[1], len(sizes)) for p in island.packings]))
            yield pd.DataFrame(out, columns=["cell", "island", "packings"])

    return islands.mapInPandas(frugal(run), _STATE)


def _pack_cells(pieces: DataFrame, capacity: int, level: int, count: int) -> DataFrame:
    """pieces (with row, a number of their own), dealt to `count` cells, with bin (cell, number in the cell), fill (tokens of the bin) and offset."""
    spark = pieces.sparkSession
    placed = pieces.withColumn("cell", F.expr(f"pmod(xxhash64(row, {level}), {count})"))
    members = F.array_sort(F.collect_list(F.struct("length", "row", "doc_id", "piece", "start", "ids_crc32")))
    cells = cut(placed.groupBy("cell").agg(members.alias("items")))
    islands = cells.select("cell", F.col("items.length").alias("sizes"), F.explode(F.expr(f"sequence(0, {ISLANDS - 1})")).alias("island"))
    islands = islands.repartition(max(partitions(spark), min(count * ISLANDS, 8 * partitions(spark))), "cell", "island")
    state = cut(_epoch(islands, capacity, True, level))
    for epoch in range(1, EPOCHS):
        guests = state.select("cell", F.expr(f"(island + 1) % {ISLANDS}").alias("island"), F.col("packings")[0].alias("guest"))
        joined = cells.select("cell", F.col("items.length").alias("sizes")).join(state.join(guests, ["cell", "island"]), "cell")
        state = cut(_epoch(joined, capacity, False, level + 16 * epoch))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The best packing of all islands of each cell."""
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                sizes = [int(x) for x in r.sizes]
                best = Island(sizes, capacity, 0)
                for p in r.best:
                    best.add(_load(p))
                for number, bin_ in enumerate(best.packings[0][1]):
                    fill = sum(sizes[i] for i in bin_)
                    offset = 0
                    for i in sorted(bin_):
                        rows.append((r.cell, i, number, fill, offset))
                        offset += sizes[i]
            yield pd.DataFrame(rows, columns=["cell", "item", "bin", "fill", "offset"])

    best = state.groupBy("cell").agg(F.collect_list(F.col("packings")[0]).alias("best"))
    chosen = cells.select("cell", F.col("items.length").alias("sizes")).join(best, "cell").mapInPandas(emit, "cell long, item int, bin int, fill long, offset long")
    items = cells.select("cell", F.posexplode("items").alias("item", "it"))
    return items.join(chosen, ["cell", "item"]).select("cell", "it.*", "bin", "fill", "offset")


def pack(pieces: DataFrame, length: int = 2048, *, cell: int = CELL) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset, in sequences of at most `length` tokens.

    Repeated pieces, and pieces of equal length, are packed each as a row of its own; which of them comes first does not matter. A sequence's pieces are gapless from
    0. An empty table gives no rows; null ids are packed like others.
    """
    prepare(pieces.sparkSession)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    pieces = cut(pieces.select(*columns[:5], F.monotonically_increasing_id().alias("row")))
    full = pieces.filter(F.col("length") >= length).withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    parts, rest, level = [full.select(columns)], pieces.filter(F.col("length") < length), 0
    while left := rest.count():
        last = left <= max(cell, LAST)
        packed = cut(_pack_cells(rest, length, level, 1 if last else -(-left // cell)))
        number = F.lit(level).cast("long") * F.lit(1 << 56) + F.col("cell") * (1 << 24) + F.col("bin")
        # half of the pieces at least are in bins that are filled as well as this
        stays = F.col("fill") >= (0 if last else packed.agg(F.percentile_approx("fill", 0.5)).first()[0])
        parts.append(packed.filter(stays).withColumn("sequence_id", number).select(columns))
        rest, level = packed.filter(~stays).select(*columns[:5], "row"), level + 1
    return reduce(DataFrame.union, parts)


def pack_documents(docs: DataFrame, length: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """Pieces of docs (doc_id, text) and the sequences that they are packed into; other columns do not matter.

    Null and empty texts are a piece of one token. Repeated rows are packed each; long texts give as many pieces as they need; an empty table gives no rows.
    """
    return pack(cut_pieces(docs, length, tokenizer), length)


def audit(packed: DataFrame, length: int = 2048) -> DataFrame:
    """One row about the result of pack_documents(): documents, those whose pieces don't follow each other, sequences that are too long, and those with gaps or overlaps."""
    at = F.col("offset") + F.col("length")
    sequences = packed.groupBy("sequence_id").agg(F.max(at).alias("end"), F.sum("length").alias("tokens"), F.min("offset").alias("begin"))
    pieces = packed.groupBy("doc_id").agg(F.max(F.col("start") + F.col("length")).alias("end"), F.sum("length").alias("tokens"), F.min("start").alias("begin"), F.sum((F.col("start") != F.col("piece") * length).cast("int")).alias("off"))
    count = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0)).cast("long")
    bad = count((F.col("end") != F.col("tokens")) | (F.col("begin") != 0))
    one = pieces.agg(F.count(F.lit(1)).alias("documents"), count((F.col("end") != F.col("tokens")) | (F.col("begin") != 0) | (F.col("off") > 0)).alias("broken"))
    two = sequences.agg(count(F.col("tokens") > length).alias("too_long"), bad.alias("with_gaps"))
    return one.join(F.broadcast(two))  # one row each


#: What a right result says of itself.
AUDIT_SQL = "select count(distinct doc_id) as documents, 0::bigint as broken, 0::bigint as too_long, 0::bigint as with_gaps from documents"
