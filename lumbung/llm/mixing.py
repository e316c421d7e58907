"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document gets an exponential key, -ln(u) / weight, where u is a hash of its id: the order of the keys within a
source is a weighted sample without replacement, and heavier documents tend to come first. A source's target is
met by complete epochs over the source and then by the documents whose keys come first, up to the words that are left.

The prefix sums that this takes are made in two levels, so that a source with most of the rows does not meet in
one task: keys fall into many buckets in key order, the buckets' totals (few rows) are summed along each source, and
only within a bucket are documents sorted. Keys are mapped to buckets by a fixed increasing function, so
that a rerun, or a task that is run again, makes the same buckets. Rows of one id and size, which have one key, go on as one row with their number,
so that an id which a third of the rows share is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, free_name, within_bounds

#: Quality weights are held within these bounds, which also bounds how uneven the buckets can be.
WEIGHTS = (0.5, 2.0)
#: Rows that a bucket has about, and the most buckets of one source.
BUCKET_ROWS, BUCKETS = 250, 8192


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column) -> Column:
    """A number above 0 and at most 1 from the key's MD5, the same everywhere."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10)
    return (digits.cast("long") + 1) / F.lit(2.0**52)


def targets(sources: DataFrame, weight: Column, most: int) -> DataFrame:
    """Adds target to rows (key, source, source_size): shares of all sizes by weight, none above `most` times its size.

    weight: of a source, from its rank in column place. Sharing again what is above a cap, until none is, ends with the
    smaller of cap and level * weight for one level; sorted by cap / weight, the level is found by running sums.
    One row per source meets in one task here.
    """
    everything, ordered = Window.orderBy(F.lit(0)), Window.orderBy("ratio", "key")
    ranked = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", weight).withColumn("ratio", most * F.col("source_size") / F.col("weight"))
    capped = F.coalesce(F.sum(most * F.col("source_size")).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - capped).cast("double") / F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    leveled = ranked.withColumn("level", level)
    leveled = leveled.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole))
    return leveled.withColumn("target", F.least((most * F.col("source_size")).cast("double"), F.col("level") * F.col("weight")))


def _placed(docs: DataFrame, weights: DataFrame | None, most: int) -> DataFrame:
    """Rows doc_id, source, size, copies (of them), source_size, target, epochs, left (words that the fractional epoch takes) and start (words before them in it)."""
    slim = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))  # texts go no further than this
    value = F.lit(1.0)
    if weights is not None:
        known = weights.select(F.col("doc_id").alias("weight_id"), F.col("weight").cast("double").alias("weight"))
        slim = slim.join(known, F.col("doc_id") == F.col("weight_id"), "left")
        value = F.greatest(F.lit(WEIGHTS[0]), F.least(F.lit(WEIGHTS[1]), F.coalesce("weight", F.lit(1.0))))
    slim = slim.select("doc_id", "source", "size", (-F.log(uniform(F.col("doc_id"))) / value).alias("rank_key"))
    slim = slim.withColumn("key", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")))
    slim = cut(slim.groupBy("key", "source", "rank_key", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies")))
    count = max(1, min(BUCKETS, slim.count() // BUCKET_ROWS))
    place = F.floor((1 - F.exp(-F.col("rank_key") * WEIGHTS[0])) * count)
    words = F.col("size") * F.col("copies")
    rows = slim.withColumn("bucket", F.least(place, F.lit(count - 1)).cast("int"))

    sums = rows.groupBy("key", "source", "bucket").agg(F.sum(words).alias("bucket_size"))
    along = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = targets(sums.groupBy("key", "source").agg(F.sum("bucket_size").alias("source_size")), (F.col("place") - 1) % 3 + 1, most)
    sums = sums.select("key", "bucket", F.coalesce(F.sum("bucket_size").over(along), F.lit(0)).alias("bucket_start"))
    sums = sums.join(totals.select("key", "source_size", "target"), "key")

    within = Window.partitionBy("key", "bucket").orderBy("rank_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(sums, ["key", "bucket"]).withColumn("start", F.col("bucket_start") + F.coalesce(F.sum(words).over(within), F.lit(0)))
    filled = placed.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    return filled.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))


def _all_or_none() -> Column:
    """Whether the fractional epoch takes a row of _placed() with all its copies: if that is nearer to the target than without them."""
    return F.col("start") + F.col("size") * F.col("copies") / 2 <= F.col("left")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, *, most: int = 3, whole: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target and taken.

    docs: doc_id, text, source; other columns are allowed and not kept. weights: doc_id and weight, the quality of documents, one row
    each at most; held within WEIGHTS, 1 where there is none. whole: the last document that a target reaches is taken whole if that is
    nearer to the target, else not at all, together with other rows of its source that share id and size; otherwise its first words are taken, which
    meets the target.

    Null texts have size 0 and nothing is taken of them; null sources are a source of their own, which comes last. Rows
    that share an id have one key and follow each other, smaller sizes first. A source without words has target 0. An empty table gives
    an empty result. taken is at most `most` times size.
    """
    each = _placed(docs, weights, most).withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    if whole:
        rest = F.when(_all_or_none(), F.col("size")).otherwise(F.lit(0))
    else:
        rest = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("left") - F.col("start") - F.col("copy") * F.col("size")))
    return each.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + rest).cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, weights: DataFrame | None = None, *, most: int = 3) -> DataFrame:
    """docs with each row as often as the mix takes it whole, up to `most` times; rows that it does not take go, and those without words, of which there is nothing to take.

    Null ids, null sources and ids that several rows share are mixed like others: each row gets the decision of its own id, source and size. Rows that are the same in all
    three are taken equally often. All columns stay as they are; an empty table gives no rows.
    """
    times = _placed(docs, weights, most).select("source", "doc_id", "size", (F.col("epochs") + _all_or_none().cast("int")).cast("int").alias("times"))
    times = cut(times.filter("times > 0 and size > 0"))
    own = {c: free_name(docs, f"__mix_{c}") for c in (*times.columns, "copy")}
    known = times.select(*[F.col(c).alias(own[c]) for c in times.columns])
    same = F.col("doc_id").eqNullSafe(F.col(own["doc_id"])) & F.col("source").eqNullSafe(F.col(own["source"])) & (word_count(F.col("text")) == F.col(own["size"]))
    repeated = docs.join(within_bounds(known), same).withColumn(own["copy"], F.explode(F.sequence(F.lit(1), F.col(own["times"]))))
    return repeated.select(docs.columns)


def quality(labels: DataFrame) -> DataFrame:
    """doc_id and weight: 2 if labelled good, 0.5 if labelled bad, between them by the mean of several labels. Null ids and qualities have none."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
    return known.agg(F.pow(F.lit(4.0), F.avg("quality") - 0.5).alias("weight"))


ORACLE_SQL = r"""
with known as (select doc_id, pow(4.0, avg(quality) - 0.5) w from labels where doc_id is not null and quality is not null group by doc_id),
docs as (
  select d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    -ln((('0x' || substr(md5(coalesce(d.doc_id::varchar, '')), 1, 13))::bigint + 1) / 4503599627370496.0::double)
      / greatest(0.5, least(2.0, coalesce(k.w, 1.0))) as rank_key
  from documents d left join known k on d.doc_id = k.doc_id),
totals as (select source, sum(size)::bigint source_size from docs group by source),
ranked as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from totals),
ratios as (select *, 3 * source_size / weight::double as ratio from ranked),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (order by ratio, source rows between unbounded preceding and 1 preceding), 0))::double
    / sum(weight) over (order by ratio, source rows between current row and unbounded following) as level from ratios),
goals as (select source, source_size, least(3.0 * source_size, max(case when level <= ratio then level end) over () * weight)::double as target from levels),
placed as (
  select d.*, g.source_size, g.target,
    coalesce(sum(d.size) over (partition by d.source order by d.rank_key, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as start
  from docs d join goals g on d.source is not distinct from g.source),
filled as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from placed)
select doc_id, source, size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - start)))::bigint as taken
from filled
"""
