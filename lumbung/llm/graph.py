"""Connected components of links in a table, by alternating large and small stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Links up to which the least neighbours, at most two rows for each, are broadcast: then a star's centre, which many links share, is no hot key.
BROADCAST_LINKS = 100_000


def _stars(both: DataFrame, large: bool, few: bool) -> DataFrame:
    """Links each larger (smaller) neighbour of u, and u itself, with the least of u and its (smaller) neighbours.

    both: links as rows (u, v); for a large star in both directions, for a small star with v < u. few: they are at most BROADCAST_LINKS.
    """
    least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    least = F.broadcast(least) if few else least
    joined = both.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """Columns node and component, the smallest id that links reach; a row for each id in links (a, b), two columns of longs.

    A link counts in both directions; repeated ones and loops do not matter, and links with a null are left out. Each round is written to the
    checkpoint folder. Links never become more than there were, rounds grow as the logarithm of the ids.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a is not null and b is not null and u <> v").distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        few = state[0] <= BROADCAST_LINKS
        large = _stars(both, True, few).filter("u <> v").distinct()
        edges = cut(_stars(large, False, few).filter("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
