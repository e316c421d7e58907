"""N-gram Jaccard self-join by filtering under several global token orders; returns components, not pairs.

A document's set is its distinct word n-grams. Two sets that link share a token among the first few tokens of each, whatever order all tokens
are sorted by (prefix filter). The plan:

1. One pass gives each document's set a size and a 128-bit digest, so that equal sets go on as one, and counts all words and all tokens in
   hashed counters.
2. Under the first order (tokens of rare words first; then those that many prefixes hold, which are counted in a pass of their own, since hashed
   counters fill up as texts grow; tokens that are frequent as a whole last, by those counters), the prefix tokens are dealt out by
   token, and sets that share one, with sizes that can link, make a group; equal groups are taken once. Groups whose leaders, the
   least sets in them, meet are filtered as one: a set goes there once with its second prefix, not once for each of its tokens.
3. Within a group, sets must also share enough of their prefixes under the second order (by a hash): two sets that link lack few tokens of
   each other, so of their prefixes up to the earlier end all but those few are common. Pairs that pass are only chained, not returned. Groups of
   frequent tokens are salted and chained as a whole, by the first set of each part.
4. Components of those chains are the clusters within which links can be. A cluster's sets meet in blocks that
   are bounded by number and tokens; every two blocks of a cluster meet in one task.
5. There, two sets are candidates only if they share prefix tokens under each of three orders (rare tokens of the blocks first; the
   second order; a third by another hash): the intersection of the filters. Candidates of fitting sizes that are not linked yet are verified on the whole sets.
6. Links that connect something new (at most one less than sets in a task) make the final components.

Any order gives right results as long as all sets use the same: the counters only make it fast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import cut, free_name, frugal, map_texts, partitions, prepare, within_bounds
from .graph import components

_ONE, _TWO, _THREE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
#: Counters are sent in parts of this many.
_PART = 1 << 12
#: Prefix tokens that are counted at once, in a task.
_HELD = 1 << 22


@dataclass(frozen=True)
class Join:
    """Sets of word n-grams of `words` words link when den * intersection >= num * union. word_counters, token_counters: hashed counters, powers of two.

    block_sets, block_tokens: bounds of a block. salt_rows: rows of a frequent token that go to one part. group_sets: sets
    of a group up to which its pairs are filtered by the second order; a larger one is chained as a whole. often: prefixes that hold a token, of those that
    meet in a task, from which it comes late in the first order. most_often: tokens of that kind at most, those of most prefixes.
    """

    words: int = 5
    num: int = 80
    den: int = 100
    word_counters: int = 1 << 18
    token_counters: int = 1 << 20
    block_sets: int = 256
    block_tokens: int = 1 << 20
    salt_rows: int = 1000
    group_sets: int = 512
    often: int = 16
    most_often: int = 1 << 18

    def needed(self, a: int | np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least intersection with which sets of sizes a and b link."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def prefix(self, n: int) -> int:
        """Tokens of a set of n among which a set that links has one, if both take their first."""
        return n - -(-self.num * n // self.den) + 1


def word_sets(texts: list[str | None], n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text: the sorted distinct tokens (hashes of its n-grams, of all its words if it has fewer, none without words), the first word of each, all words."""
    for begin, end in hashing.chunks(texts):
        found = hashing.words(texts[begin:end])
        for i in range(end - begin):
            h = found.hashes[found.first[i] : found.first[i + 1]]
            k = min(n, len(h))
            if not k:
                yield h, np.zeros(0, np.int64), h
                continue
            token = np.full(len(h) - k + 1, k, np.uint64)
            for j in range(k):
                token = hashing.mix(token * _ONE + h[j : j + len(token)])
            order = np.argsort(token, kind="stable")
            token = token[order]
            new = np.concatenate(([True], token[1:] != token[:-1]))
            yield token[new], order[new], h


def token_sets(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    return (t for t, _, _ in word_sets(texts, n))


def _slot(h: np.ndarray, counters: int) -> np.ndarray:
    return (h >> np.uint64(64 - (counters.bit_length() - 1))).astype(np.int64)


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    both = [hashing.mix(tokens ^ x).sum(dtype=np.uint64) for x in (_TWO, _THREE)]
    return tuple(np.array(both, np.uint64).view(np.int64).tolist())


def second_prefix(tokens: np.ndarray, rule: Join) -> np.ndarray:
    """The prefix under the second order, as its sorted distinct ranks: half of a hash. Tokens of the last rank all belong to it, so it is whole up to its end."""
    ranks = (hashing.mix(tokens ^ _TWO) >> np.uint64(32)).astype("<u4")
    k = rule.prefix(len(tokens)) if len(tokens) else 0
    return np.unique(ranks[ranks <= np.partition(ranks, k - 1)[k - 1]] if k < len(ranks) else ranks)


def _measure(docs: DataFrame, rule: Join) -> DataFrame:
    """Rows (doc_id, n, d1, d2) of documents, and rows (part, counts) with the task's counters, words before tokens; checkpointed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(rule.word_counters, np.int64), np.zeros(rule.token_counters, np.int64)]
        held: tuple[list, list] = ([], [])

        def count() -> None:
            for total, hashes in zip(counts, held, strict=True):
                np.add(total, np.bincount(_slot(np.concatenate(hashes), len(total)), minlength=len(total)), out=total)
                hashes.clear()

        for b in batches:
            rows, size = [], 0
            for tokens, _, words in word_sets(b["text"].tolist(), rule.words):
                rows.append((len(tokens), *set_digest(tokens), second_prefix(tokens, rule).tobytes()))
                held[0].append(words)
                held[1].append(tokens)
                size += len(words)
                if size > 1 << 18:
                    count()
                    size = 0
            if held[0]:
                count()
            out = pd.DataFrame(rows, columns=["n", "d1", "d2", "second"])
            out.insert(0, "doc_id", b["doc_id"])
            yield out.assign(part=None, counts=None)
        if counts[0].any():
            parts = np.concatenate(counts).astype("<u4").reshape(-1, _PART)
            yield pd.DataFrame({"doc_id": None, "n": 0, "d1": 0, "d2": 0, "second": None, "part": range(len(parts)), "counts": [zlib.compress(p.tobytes(), 1) for p in parts]})

    return cut(map_texts(docs, run, "doc_id long, n long, d1 long, d2 long, second binary, part int, counts binary"))


def _counters(measured: DataFrame, rule: Join) -> tuple[np.ndarray, np.ndarray]:
    """All tasks' counters of words and of tokens added up: a fixed number of them, whatever the input."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b["part"], b["counts"], strict=True):
                value = np.frombuffer(zlib.decompress(counts), "<u4").astype(np.int64)
                sums[part] = sums[part] + value if part in sums else value
        yield pd.DataFrame({"part": list(sums), "counts": [np.minimum(s, 2**32 - 1).astype("<u4").tobytes() for s in sums.values()]})

    rows = measured.filter("part is not null").select("part", "counts").repartition("part").mapInPandas(run, "part int, counts binary").collect()
    out = np.zeros(rule.word_counters + rule.token_counters, np.uint32)
    for r in rows:
        out[r["part"] * _PART : (r["part"] + 1) * _PART] = np.frombuffer(r["counts"], "<u4")
    return out[: rule.word_counters], out[rule.word_counters :]


class _FirstOrder:
    """The first order. frequent: sorted tokens and their numbers of prefixes, as _frequent() finds them."""

    def __init__(self, counters: tuple[np.ndarray, np.ndarray], frequent: tuple[np.ndarray, np.ndarray], rule: Join) -> None:
        words, often = counters
        usual = 2 * max(8.0, float(often.mean()))
        self.rule, self.tokens = rule, frequent[0]
        self.weight = np.log2(words + 1.0).astype(np.float32)
        self.late = np.round(np.where(often > usual, 1000 + 4 * np.log2(np.maximum(often / usual, 1)), 0)).astype(np.float32)
        self.later = np.round(700 + 4 * np.log2(np.maximum(frequent[1], 1))).astype(np.float32)
        self.parts = np.where(often > usual, often // rule.salt_rows, 0).astype(np.uint64)

    def prefix(self, t: np.ndarray, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The prefix of a set as word_sets() gives it, and in how many parts each of its tokens is dealt out."""
        sums = np.concatenate(([0], np.cumsum(self.weight[_slot(h, len(self.weight))], dtype=np.float64)))
        slot = _slot(t, len(self.late))
        # rounded, so that the sums of equal words are equal in all places
        rank = np.maximum(np.round(4 * (sums[np.minimum(at + self.rule.words, len(h))] - sums[at])), self.late[slot])
        if len(self.tokens):
            place = np.minimum(np.searchsorted(self.tokens, t), len(self.tokens) - 1)
            rank = np.where(self.tokens[place] == t, np.maximum(rank, self.later[place]), rank)
        order = np.argsort(rank, kind="stable")[: self.rule.prefix(len(t))]
        return t[order], self.parts[slot[order]]


def _frequent(docs: DataFrame, counters: tuple[np.ndarray, np.ndarray], rule: Join) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that many prefixes hold, sorted, and of how many it is known: all prefixes are counted, but a task tells only of tokens that it meets more than once."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seen, held, size = _FirstOrder(shared.value, none, rule), set(), [], 0

        def told() -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(held or [none[0]]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(token[times > 1].view(np.int64)), pa.array(times[times > 1])], ["token", "times"])

        for b in batches:
            for t, at, h in word_sets(b.column("text").to_pylist(), rule.words):
                sid = set_digest(t)[0]
                if len(t) and sid not in seen:
                    seen.add(sid)
                    held.append(first.prefix(t, at, h)[0])
                    size += len(held[-1])
            if size > _HELD:
                yield told()
                size = 0
        yield told()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"tokens": [b["token"].to_numpy(np.int64).tobytes()], "times": [b["times"].to_numpy(np.int64).tobytes()]})

    sums = docs.select("text").mapInArrow(frugal(run), "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    sums = cut(sums.filter(F.col("times") >= rule.often))
    if sums.count() > rule.most_often:
        sums = sums.orderBy(F.desc("times"), "token").limit(rule.most_often)
    rows = sums.mapInPandas(pack, "tokens binary, times binary").collect()
    tokens, times = (np.frombuffer(b"".join(bytes(r[c]) for r in rows), kind) for c, kind in (("tokens", np.uint64), ("times", np.int64)))
    order = np.argsort(tokens)
    return tokens[order], times[order]


def _chains(docs: DataFrame, counters: tuple[np.ndarray, np.ndarray], seconds: DataFrame, rule: Join) -> DataFrame:
    """Links (a, b) between the d1 of sets that share prefix tokens under the first and the second order. seconds: d1, n, second."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((counters, _frequent(docs, counters, rule)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows key, sid, n, token; token is 0 if it isn't dealt out in parts."""
        seen: set[int] = set()  # of the task's sets: copies go out once a task
        first = _FirstOrder(*shared.value, rule)
        for b in batches:
            tokens, sids, sizes, parts = [], [], [], []
            for t, at, h in word_sets(b.column("text").to_pylist(), rule.words):
                sid = set_digest(t)[0]
                if not len(t) or sid in seen:
                    continue
                seen.add(sid)
                prefix, part = first.prefix(t, at, h)
                tokens.append(prefix)
                sids.append(np.full(len(prefix), sid, np.int64))
                sizes.append(np.full(len(prefix), len(t), np.int64))
                parts.append(part)
            if not tokens:
                continue
            token, sid, salts = np.concatenate(tokens), np.concatenate(sids), np.concatenate(parts)
            salt = np.where(salts > 1, hashing.mix(sid.view(np.uint64)) % np.maximum(salts, 1), 0)
            key = hashing.mix(token + salt * _ONE)
            token = np.where(salts > 1, np.maximum(token, 1), 0)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(sid), pa.array(np.concatenate(sizes)), pa.array(token.view(np.int64))], ["key", "sid", "n", "token"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by key, n, sid. kind 0: (group, sid, leader) of groups to filter; 1: (first, sid) of groups to chain; 2: (token, first) of salted parts."""
        rest = [np.zeros(0, np.int64)] * 4
        leader = None  # of the group in rest, if it is being chained

        def batch(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            kinds = np.concatenate([np.full(len(r[1]), r[0], np.int32) for r in rows] or [np.zeros(0, np.int32)])
            a, b, leaders = (np.concatenate([r[i] for r in rows] or [np.zeros(0, np.int64)]) for i in (1, 2, -1))
            return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(a), pa.array(b), pa.array(leaders)], ["kind", "a", "b", "leader"])

        def take(key: np.ndarray, sid: np.ndarray, n: np.ndarray, token: np.ndarray, last: bool) -> pa.RecordBatch:
            nonlocal rest, leader
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            if not len(key):
                return batch(out)
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])))  # copies of other tasks go
            key, sid, n, token = key[new], sid[new], n[new], token[new]
            salted = token != 0
            # a group ends where sizes are too far apart for a link
            starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (rule.needed(n[:-1], n[1:]) > n[:-1]))))
            ends = np.append(starts[1:], len(key))
            if leader is not None:  # the first group goes on
                out.append((1, np.full(ends[0], leader, np.int64), sid[: ends[0]]))
                done = last or len(starts) > 1
                if not done:
                    rest = [x[-1:] for x in (key, sid, n, token)]
                    return batch(out)
                leader, starts, ends = None, starts[1:], ends[1:]
            if not last and len(starts):
                begin = starts[-1]
                rest = [x[begin:] for x in (key, sid, n, token)]
                if ends[-1] - begin > rule.group_sets:
                    leader = int(sid[begin])
                    out.append((1, np.full(ends[-1] - begin, leader, np.int64), sid[begin:]))
                    if salted[begin]:
                        out.append((2, token[begin : begin + 1], sid[begin : begin + 1]))
                    rest = [x[-1:] for x in rest]
                starts, ends = starts[:-1], ends[:-1]
            elif last:
                rest = [x[:0] for x in rest]
            sizes = ends - starts
            heads = starts[salted[starts]] if len(starts) else starts
            out.append((2, token[heads], sid[heads]))
            whole = (sizes > rule.group_sets) | salted[starts] if len(starts) else np.zeros(0, bool)
            for kind, chosen in ((0, ~whole & (sizes > 1)), (1, whole & (sizes > 1))):
                m, s = sizes[chosen], starts[chosen]
                if not len(m):
                    continue
                first = np.concatenate(([0], np.cumsum(m)[:-1]))
                members = sid[np.repeat(s - first, m) + np.arange(m.sum())]
                leaders = np.repeat(np.minimum.reduceat(members, first), m)
                if kind:
                    name = leaders
                else:  # a group's name follows from its members, so equal groups are one
                    sums = np.add.reduceat(hashing.mix(members.view(np.uint64)), first)
                    name = np.repeat(hashing.mix(sums + m.astype(np.uint64)).view(np.int64), m)
                rows = np.unique(np.stack([name, members, leaders], 1), axis=0)
                out.append((kind, *rows.T))
            return batch(out)

        for b in batches:
            new = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "sid", "n", "token")]
            yield take(*(np.concatenate(x) for x in zip(rest, new, strict=True)), last=False)
        yield take(*rest, last=True)

    n = partitions(spark)
    rows = docs.select("text").mapInArrow(frugal(prefixes), "key long, sid long, n long, token long")
    rows = rows.repartition(n, "key").sortWithinPartitions("key", "n", "sid")
    found = cut(rows.mapInArrow(frugal(group), "kind int, a long, b long, leader long"))
    heads = found.filter("kind = 2").select(F.col("a").alias("token"), F.col("b").alias("sid"))
    firsts = heads.groupBy("token").agg(F.min("sid").alias("a"))
    chained = found.filter("kind = 1").select("a", "b").union(heads.join(firsts, "token").select("a", F.col("sid").alias("b")))
    members = _merged(found.filter("kind = 0").select(F.col("a").alias("name"), F.col("b").alias("sid"), "leader"), rule)

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Over rows sorted by name: chains of the pairs of each group that pass the second order."""
        held: list[tuple] = []
        for b in batches:
            out = []
            for row in b[["name", "sid", "n", "second"]].itertuples(index=False, name=None):
                if held and held[0][0] != row[0]:
                    out += passed(held, rule)
                    held = []
                held.append(row)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(passed(held, rule), columns=["a", "b"], dtype="int64")

    rows = members.join(seconds.withColumnRenamed("d1", "sid"), "sid").select("name", "sid", "n", "second")
    rows = rows.repartition(n, "name").sortWithinPartitions("name", "sid")
    return chained.union(rows.mapInPandas(frugal(narrow), "a long, b long"))


def _merged(groups: DataFrame, rule: Join) -> DataFrame:
    """Rows (name, sid), from groups as rows (name, sid, leader), leader being a group's least set.

    A group goes with all groups of the least leader that its own leader meets in any group; if these have more than group_sets sets, with those of its own leader;
    if these have more too, alone. No group is parted.
    """
    rows = cut(groups.distinct())
    met = rows.groupBy("sid").agg(F.min("leader").alias("least"), F.max(F.col("sid") == F.col("leader")).alias("leads"))
    rows = rows.join(within_bounds(cut(met.filter("leads").select(F.col("sid").alias("leader"), "least"))), "leader")
    parts = []
    for by in ("least", "leader"):
        whole = cut(rows.select(by, "sid").distinct())
        large = within_bounds(cut(whole.groupBy(by).agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") > rule.group_sets).select(by)))
        parts.append(whole.join(large, by, "left_anti").select(F.xxhash64(F.lit(by), by).alias("name"), "sid"))
        rows = rows.join(large, by, "left_semi")
    return parts[0].union(parts[1]).union(rows.select("name", "sid").distinct())


def passed(group: list[tuple], rule: Join) -> list[tuple[int, int]]:
    """Chains (sid, sid) of the sets of a group, rows (name, sid, n, second prefix), that pass the second order.

    Up to the earlier end of two prefixes, each set has some ranks; of these the other lacks at most as many as the set has tokens beyond the intersection that
    a link needs, for a rank that it lacks is of a token that it lacks.
    """
    m = len(group)
    if m < 2:
        return []
    size = np.array([g[2] for g in group])
    second = [np.frombuffer(g[3], "<u4") for g in group]
    ends = np.array([x[-1] if rule.prefix(int(n)) < n else 2**32 - 1 for x, n in zip(second, size, strict=True)], "<u4")
    if m == 2:
        common = np.array([[0, len(np.intersect1d(*second, assume_unique=True))]])
    else:
        known, local = np.unique(np.concatenate(second), return_inverse=True)
        owner = np.repeat(np.arange(m), [len(x) for x in second])
        common = None
        if m * len(known) <= 1 << 22:
            table = np.zeros((m, len(known)), np.float32)
            table[owner, local] = 1
            common = table @ table.T
        else:
            order = np.argsort(local, kind="stable")
            starts = np.searchsorted(local[order], np.arange(len(known) + 1))
            owners, begins = owner[order], np.concatenate(([0], np.cumsum([len(x) for x in second])))
            common = np.stack([np.bincount(np.concatenate([owners[starts[t] : starts[t + 1]] for t in local[begins[i] : begins[i + 1]]]), minlength=m) for i in range(m)])
    until = np.stack([np.searchsorted(x, ends, side="right") for x in second])
    links, root = [], np.arange(m)
    for i in range(m - 1):
        other = np.arange(i + 1, m)
        need = rule.needed(int(size[i]), size[other])
        fits = (need <= size[i]) & (need <= size[other])
        fits &= (common[i, other] >= until[i, other] - (size[i] - need)) & (common[i, other] >= until[other, i] - (size[other] - need))
        for j in other[fits]:
            if root[i] != root[j]:
                links.append((group[i][1], group[j][1]))
                root[root == max(root[i], root[j])] = min(root[i], root[j])
    return links


def _prefix_tables(tokens: list[np.ndarray], order: np.ndarray, rule: Join) -> list[np.ndarray]:
    """The prefix of each set of local token numbers under an order, given as each token's place."""
    out = []
    for t in tokens:
        k = rule.prefix(len(t))
        place = order[t]
        out.append(t[np.argpartition(place, k - 1)[:k]] if k < len(t) else t)
    return out


def verify(ids: list[int], sets: list[np.ndarray], side: list[int], rule: Join) -> list[tuple[int, int]]:
    """Links that connect something new, between sets of side 0 and side 1 (within side 0 too if there is no side 1)."""
    n = len(ids)
    two = 1 in side
    flat = np.concatenate(sets)
    known, local = np.unique(flat, return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    begins = np.concatenate(([0], np.cumsum(sizes)))
    tokens = [local[begins[i] : begins[i + 1]] for i in range(n)]
    df = np.bincount(local, minlength=len(known))
    orders = [np.lexsort((hashing.mix(known ^ x), df if rare else np.zeros_like(df))) for x, rare in ((_ONE, True), (_TWO, False), (_THREE, False))]
    filters = []
    for by in orders:
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        prefix = _prefix_tables(tokens, place, rule)
        owner = np.repeat(np.arange(n), [len(p) for p in prefix])
        token = np.concatenate(prefix)
        sort = np.argsort(token, kind="stable")
        filters.append((prefix, owner[sort], np.searchsorted(token[sort], np.arange(len(known) + 1))))
    side_of = np.array(side)
    group = np.arange(n)  # of the sets linked so far, as the smallest place
    links, mark = [], np.zeros(len(known), bool)
    for i in np.argsort(sizes, kind="stable"):
        if two and side_of[i]:
            continue
        open_ = group != group[i]
        if two:
            open_ &= side_of == 1
        for prefix, owner, starts in filters:
            hit = np.zeros(n, bool)
            for t in prefix[i]:
                if starts[t + 1] - starts[t] > 1:
                    hit[owner[starts[t] : starts[t + 1]]] = True
            open_ &= hit
            if not open_.any():
                break
        cand = np.flatnonzero(open_)
        needed = rule.needed(int(sizes[i]), sizes[cand])
        cand = cand[(needed <= sizes[i]) & (needed <= sizes[cand])]
        if not len(cand):
            continue
        mark[tokens[i]] = True
        for part in np.array_split(cand, max(1, int(sizes[cand].sum()) >> 22)):
            hits = mark[np.concatenate([tokens[j] for j in part])]
            both = np.add.reduceat(hits, np.concatenate(([0], np.cumsum(sizes[part])[:-1])), dtype=np.int64)
            for j in part[both >= rule.needed(int(sizes[i]), sizes[part])]:
                if group[j] != group[i]:
                    links.append((ids[i], ids[j]))
                    group[group == max(group[i], group[j])] = min(group[i], group[j])
        mark[tokens[i]] = False
    return links


def _links(docs: DataFrame, candidates: DataFrame, rule: Join) -> DataFrame:
    """Links (a, b) between representatives. candidates: doc_id, d1, d2, cluster, blocks (of its cluster)."""
    spark = docs.sparkSession

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = list(token_sets(b["text"].tolist(), rule.words))
            right = [set_digest(t) == d for t, d in zip(found, zip(b["d1"], b["d2"], strict=True), strict=True)]
            yield b[["doc_id", "cluster", "blocks"]].assign(tokens=[t.tobytes() for t in found])[right]

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Over rows sorted by cluster and blocks: verify() of each group."""
        held: list[tuple] = []
        key = None

        def done() -> pd.DataFrame:
            found = verify([h[0] for h in held], [np.frombuffer(h[1], np.uint64) for h in held], [h[2] for h in held], rule) if len(held) > 1 else []
            return pd.DataFrame(found, columns=["a", "b"])

        for b in batches:
            out = []
            for doc_id, tokens, side, *k in b[["doc_id", "tokens", "side", "cluster", "low", "high"]].itertuples(index=False, name=None):
                if k != key:
                    out.append(done())
                    held, key = [], k
                held.append((doc_id, tokens, side))
            yield pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")
        yield done()

    rows = docs.select("doc_id", "text").join(within_bounds(candidates), "doc_id").select("doc_id", "d1", "d2", "cluster", "blocks", "text")
    rows = rows.mapInPandas(frugal(sets), "doc_id long, cluster long, blocks int, tokens binary")
    rows = rows.withColumn("block", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    # pairs of a cluster's blocks are dealt in turn, from a place of the cluster's own: by a hash of each, several would meet in one task by chance
    n = partitions(spark)
    spot = F.pmod(F.xxhash64("cluster") + (low * F.col("blocks") - F.floor(low * (low - 1) / 2) + high - low), F.lit(n)).cast("int")
    rows = rows.select("doc_id", "tokens", "cluster", low.alias("low"), high.alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side"), spot.alias("spot"))
    rows = rows.repartitionById(n, F.col("spot")).sortWithinPartitions("cluster", "low", "high", "side", "doc_id").drop("spot")
    return rows.mapInPandas(frugal(meet), "a long, b long")


def join_components(docs: DataFrame, rule: Join) -> DataFrame:
    """doc_id, n_shingles (size of its set), component_id (smallest doc_id that links reach) and copies (rows with its very set), a row for each row of docs.

    docs: doc_id and text; other columns do not matter. Null, empty and blank texts have an empty set: they link with
    nothing, component_id is their own id. Rows with equal sets are linked. Ids are taken as a key: rows that share one get the component of their own
    text, but if sets of both begin with that id they count as one. Null ids get the component of their text, null if nothing else
    has it. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    measured = _measure(docs, rule)
    rows = measured.filter("part is null").select("doc_id", "n", "d1", "d2")
    sets = measured.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.first("second").alias("second"))
    sets = cut(sets)
    classes = sets.drop("second")
    chains = _chains(docs, _counters(measured, rule), sets.select("d1", "n", "second"), rule)
    clusters = components(chains).withColumnRenamed("component", "cluster")
    inside = cut(classes.filter("rep is not null").join(clusters, F.col("d1") == F.col("node")).select(F.col("rep").alias("doc_id"), "d1", "d2", "n", "cluster"))
    sizes = inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens")).filter("sets > 1")
    # blocks of at least block_sets, and of more in large groups, so that a set isn't sent too often
    by_sets = F.ceil(F.col("sets") / F.greatest(F.lit(rule.block_sets), F.least(F.lit(16 * rule.block_sets), F.col("sets") / 12)))
    by_tokens = F.ceil(F.col("tokens") / rule.block_tokens)
    sizes = sizes.select("cluster", F.when(F.col("sets") <= 2 * rule.block_sets, by_tokens).otherwise(F.greatest(by_sets, by_tokens)).cast("int").alias("blocks"))
    links = _links(docs, cut(inside.drop("n").join(sizes, "cluster")), rule)
    joined = components(links).select(F.col("node").alias("rep"), "component")
    classes = classes.join(joined, "rep", "left").select("d1", "d2", "copies", F.coalesce("component", "rep").alias("least"))
    found = rows.filter("n > 0").join(classes, ["d1", "d2"], "left").select("doc_id", "n", F.coalesce("least", "doc_id").alias("component_id"), "copies")
    found = found.union(rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(1).cast("long")))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "copies")


def drop_near_copies(docs: DataFrame, rule: Join) -> DataFrame:
    """docs with one document of each component: that of the smallest id. Rows that share its id stay together; rows without words and rows of null id stay as they are."""
    name = free_name(docs, "__gone")
    gone = join_components(docs, rule).filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(within_bounds(cut(gone)), F.col("doc_id") == F.col(name), "left_anti")


#: The components of op8's rule: 3 words, 0.9. Documents are numbered, sets are met by their shingles, links are followed to their ends.
ORACLE_SQL = r"""
with recursive docs as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select rid, doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end)) as s from docs),
sized as (select rid, doc_id, len(s) as n, md5(array_to_string(s, chr(10))) as h, s from sets),
shingles as (select rid, n, unnest(s) as x from sized),
pairs as (
  select a.rid as a, b.rid as b, a.n as na, b.n as nb, count(*) as common from shingles a join shingles b on a.x = b.x and a.rid < b.rid
  where 90 * greatest(a.n, b.n) <= 100 * least(a.n, b.n) group by all),
links as (select a, b from pairs where 100 * common >= 90 * (na + nb - common)),
ways as (select a, b from links union select b, a from links),
reach as (select rid as a, rid as b from sized union select r.a, w.b from reach r join ways w on r.b = w.a),
least as (select a, min(d.doc_id) as id from reach join sized d on d.rid = reach.b group by a),
copies as (select h, count(*) as copies from sized where n > 0 group by h)
select s.doc_id, s.n::bigint as n_shingles, case when s.n = 0 then s.doc_id else l.id end as component_id, coalesce(c.copies, 1)::bigint as copies
from sized s join least l on l.a = s.rid left join copies c on s.n > 0 and c.h = s.h
"""
