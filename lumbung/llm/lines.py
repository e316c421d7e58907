"""Line dedup by site-relative frequency: lines on more than a share of a host's pages are its boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, within_bounds

#: A line is dropped if it is on more than RATIO of its host's pages, and on SHARE_PAGES of them at least, for hosts of every size: below that a share
#: says nothing, for on a host of nine pages every line is on a ninth, and on two pages a line is as likely from two copies of a text.
RATIO, SHARE_PAGES = 0.1, 3
#: Boilerplate lines of all hosts together up to which they are broadcast; beyond, the join is shuffled by host.
BROADCAST_LINES = 200_000
#: Pages of a host that are shuffled as one part.
PART_PAGES = 20_000
_BLANKS = " \t\r"


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(_BLANKS))))


def _filled(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS)) != ""


def boilerplate(pages: DataFrame, *, ratio: float = RATIO, least: int = SHARE_PAGES) -> DataFrame:
    """Columns host and lines, the digests of the host's boilerplate lines. pages: host, text.

    What a host may have is bounded: each line that is kept takes more than `ratio` of its pages, so there are at most
    1 / ratio times the lines of its mean page.
    """
    each = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), _filled), _digest))
    counts = pages.select("host", F.explode(each).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    often = counts.filter(F.col("pages") >= least).join(totals, "host").filter(F.col("pages") > ratio * F.col("total"))
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


def _salted(keyed: DataFrame, found: DataFrame, host: str, lines: str) -> DataFrame:
    """keyed with each host's lines, shuffled; pages of a large host are dealt to parts of about PART_PAGES by all their columns, so equal texts part too, and its lines are sent to each."""
    part, parts = free_name(keyed, "__part"), free_name(keyed, "__parts")
    sizes = keyed.groupBy(host).agg(F.ceil(F.count(F.lit(1)) / PART_PAGES).cast("int").alias(parts)).filter(F.col(parts) > 1)
    sizes = within_bounds(cut(sizes))
    dealt = keyed.join(sizes, host, "left").withColumn(part, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in keyed.dtypes if "map<" not in kind]), F.coalesce(F.col(parts), F.lit(1))).cast("long"))
    sent = found.join(sizes, host, "left").withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(parts), F.lit(1)).cast("long") - 1)))
    return dealt.join(sent.select(host, part, lines), [host, part], "left")


def drop_lines(docs: DataFrame, host: str = "source", text: str = "text", *, ratio: float = RATIO, least: int = SHARE_PAGES) -> DataFrame:
    """docs with its boilerplate lines taken out of the text, and n_lines, n_dropped: lines before, lines dropped.

    Hosts of fewer than `least` pages lose nothing.

    A page is a row of docs; lines are compared without blanks, tabs and carriage returns at their ends; each counts once a page. Empty lines
    are never dropped. Rows of null host are a host of their own. Null texts stay null and have no lines; empty
    texts have one, empty line. A page may lose all its lines: its text is then empty and its row stays. Texts of any length are taken whole. Repeated rows are pages
    of their own. An empty table gives no rows. Columns of docs named n_lines or n_dropped are replaced, others stay, whatever their names.
    """
    own, lines, kept_ = (free_name(docs, c) for c in ("__host", "__lines", "__kept"))
    keyed = docs.drop("n_lines", "n_dropped").withColumn(own, F.when(F.col(host).isNull(), "").otherwise(F.concat(F.lit("="), F.col(host).cast("string"))))
    found = cut(boilerplate(keyed.select(F.col(own).alias("host"), F.col(text).alias("text")), ratio=ratio, least=least))
    size = found.agg(F.sum(F.size("lines"))).first()[0] or 0
    found = found.select(F.col("host").alias(own), F.col("lines").alias(lines))
    if size <= BROADCAST_LINES:
        joined = keyed.join(F.broadcast(found), own, "left")
    else:
        joined = _salted(keyed, found, own, lines)
    split = F.split(F.col(text), "\n")
    # the page's own boilerplate is found by hashing, so a long list of the host's is not gone through for each line
    mine = F.array_intersect(F.transform(F.filter(split, _filled), _digest), lines)
    joined = joined.withColumn(lines, F.when(F.col(lines).isNotNull() & F.col(text).isNotNull(), mine))
    kept = F.filter(split, lambda x: ~(_filled(x) & F.array_contains(lines, _digest(x))))
    joined = joined.withColumn(kept_, F.when(F.size(lines) > 0, kept).otherwise(split))
    counted = joined.withColumn("n_lines", F.coalesce(F.size(F.split(F.col(text), "\n")).cast("long"), F.lit(0).cast("long")) * F.col(text).isNotNull().cast("long"))
    counted = counted.withColumn("n_dropped", F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size(kept_)).cast("long"))
    counted = counted.withColumn(text, F.when(F.col("n_dropped") > 0, F.array_join(kept_, "\n")).otherwise(F.col(text)))
    return counted.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


ORACLE_SQL = rf"""
with pages as (select row_number() over () as rid, doc_id, source, text from documents),
lines as (select rid, source, unnest(string_split(text, chr(10))) as line from pages where text is not null),
bare as (select distinct rid, source, trim(line, ' ' || chr(9) || chr(13)) as line from lines),
totals as (select source, count(*) as total from pages group by source),
counts as (select source, line, count(*) as n from bare where line <> '' group by source, line),
often as (
  select c.source, list(c.line) as lines from counts c join totals t on c.source is not distinct from t.source
  where c.n >= {SHARE_PAGES} and c.n > {RATIO}::double * t.total group by c.source),
kept as (
  select p.*, string_split(p.text, chr(10)) as before, o.lines from pages p left join often o on p.source is not distinct from o.source),
done as (
  select *, case when lines is null then before else list_filter(before, lambda x: not list_contains(lines, trim(x, ' ' || chr(9) || chr(13)))) end as after from kept)
select doc_id, source, array_to_string(after, chr(10)) as text, coalesce(len(before), 0)::bigint as n_lines,
  coalesce(len(before) - len(after), 0)::bigint as n_dropped
from done
"""
