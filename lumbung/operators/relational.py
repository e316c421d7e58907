"""Relational operators on article tables. Orders are always given by columns, so survivors and numbers are the same each time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settled

PUBLIC = ["No", "Source", "Title", "Content", "Year", "Month", "Week", "Minggu_ke", "Minggu_Mulai", "Week_Label", "Penyakit", "Lokasi", "url"]


def _order(columns: Sequence[str | Column], descending: bool = False) -> list[Column]:
    named = [F.col(c) if isinstance(c, str) else c for c in columns]
    return [c.desc() if descending else c.asc() for c in named]


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores after it as it takes to be none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def public_columns(df: DataFrame) -> DataFrame:
    """The public columns that df has, in their order."""
    return df.select([c for c in PUBLIC if c in df.columns])


def year_filter(df: DataFrame, years: Sequence[int], or_unknown: bool = False, year: str = "Year") -> DataFrame:
    """Rows of some years; null years are kept only if or_unknown."""
    keep = F.col(year).isin(list(years))
    return df.filter(keep | F.col(year).isNull() if or_unknown else keep)


def anti_seen(df: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key isn't in seen."""
    return df.join(seen.select(key), key, "left_anti")


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Of each key the first row in an order."""
    return _one(df, key, _order(order))


def keep_last(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Of each key the last row in an order."""
    return _one(df, key, _order(order, descending=True))


def _one(df: DataFrame, key: str | Sequence[str], order: list[Column]) -> DataFrame:
    # filter on row_number() is planned with a group limit before the shuffle, so a key with many rows sends one from each task
    place = F.row_number().over(Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order))
    name = free_name(df, "__place")
    return df.withColumn(name, place).filter(F.col(name) == 1).drop(name)


def newest_first(order: Sequence[str | Column] = ()) -> list[Column]:
    """Sort keys: Year, Month, Week descending with nulls last, then an order to break ties."""
    return [F.col(c).desc_nulls_last() for c in ("Year", "Month", "Week")] + _order(order)


def number_rows(df: DataFrame, order: list[Column], name: str = "No", partitions: int | None = None) -> DataFrame:
    """Rows numbered from 1 in an order that has no ties.

    Rows are dealt to ranges of the order and numbered within each; the ranges' counts, one row each, are added up before them. No task sees
    all rows.
    """
    spark = df.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # the place in a partition is the low half of the id, its number the high half
    mark, number, start = (free_name(df, c) for c in ("__mark", "__part", "__start"))
    marked = settled(ranged.withColumn(mark, F.monotonically_increasing_id()))
    part, place = F.shiftright(mark, 33), F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))
    counts = marked.groupBy(part.alias(number)).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(number, before.alias(start))  # a row for each partition
    joined = marked.withColumn(number, part).join(F.broadcast(starts), number)
    return joined.withColumn(name, F.col(start) + place + 1).drop(mark, number, start)


def future_row(today: Column, year: str = "Year", month: str = "Month", monday: str = "Minggu_Mulai") -> Column:
    """Whether a row's date is later than today by year, then month, then Monday; false without year or month."""
    y, m = F.year(today), F.month(today)
    later = (F.col(year) > y) | ((F.col(year) == y) & (F.col(month) > m))
    later = later | ((F.col(year) == y) & (F.col(month) == m) & F.coalesce(F.col(monday) > F.date_format(today, "yyyy-MM-dd"), F.lit(False)))
    return F.coalesce(later & F.col(month).isNotNull(), F.lit(False))


def audit(df: DataFrame, today: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose date can be, and rows whose date is in the future."""
    bad = future_row(today)
    return df.filter(~bad), df.filter(bad)


def merge_by_url(existing: DataFrame, new: DataFrame, order: str = "seq", key: str = "url", side: str = "__source") -> DataFrame:
    """Both tables with one row of each url: the last of the new ones, else the last that there was. Columns are matched by name; the column `side`, which neither may have, tells
    old (0) from new (1)."""
    if side in existing.columns or side in new.columns:
        raise ValueError(f"{side} is a column of the tables: name another with side")
    both = existing.withColumn(side, F.lit(0)).unionByName(new.withColumn(side, F.lit(1)), allowMissingColumns=True)
    return keep_last(both, key, [side, order])


def merge_totals(existing: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """One row: rows that there were, new rows, rows of both with keys of their own, and how many rows the merge takes out."""
    both = existing.select(key, F.lit(0).alias("__new")).union(new.select(key, F.lit(1)))
    each = both.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"), F.sum("__new").alias("__new"))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    rows = each.agg(total(F.col("__rows") - F.col("__new")).alias("existing"), total("__new").alias("new"), F.count(F.lit(1)).alias("unique"), total(F.col("__rows") - 1).alias("removed"))
    return rows


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows in an order."""
    return df.orderBy(*_order(order)).limit(n)


def cap_batches(df: DataFrame, batch: str, most: int, before: int = 0, at_least_one: bool = False) -> DataFrame:
    """Batches, in order, until the rows so far are `most` or more: the batch that reaches it is still whole. before: rows of earlier phases."""
    counts = df.groupBy(batch).agg(F.count(F.lit(1)).alias("__rows"))
    so_far = F.coalesce(F.sum("__rows").over(Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + before
    first = F.row_number().over(Window.orderBy(batch)) == 1
    kept = counts.withColumn("__before", so_far).withColumn("__first", first).filter((F.col("__before") < most) | (F.col("__first") & at_least_one))
    return df.join(kept.select(batch), batch, "left_semi")


def in_order(rows: DataFrame, column: str, configured: Sequence[str] = ()) -> list[str]:
    """The values of a column of configuration (queries, sources) that rows has: those configured in their order, then others by name. At most CONFIGURED, which is checked."""
    found = [r[0] for r in rows.select(column).filter(F.col(column).isNotNull()).distinct().limit(CONFIGURED + 1).collect()]
    if len(found) > CONFIGURED:
        raise ValueError(f"{column} is configuration of at most {CONFIGURED} values")
    places = {name: i for i, name in enumerate(configured)}
    return sorted(found, key=lambda x: (places.get(x, len(places)), x))


def accept_batches(make: Callable[[list[str]], DataFrame], batches: Sequence[str], most: int, *, seen: DataFrame | None = None, before: int = 0, at_least_one: bool = False, whole: bool = True) -> DataFrame | None:
    """Rows of batches in their order until the rows that were accepted, with `before` from earlier, are `most` or more; None without a batch.

    make: rows of some batches, with id, seq (their order) and batch (their place in batches). An id belongs to the first row that has it, and is not accepted if it is in seen. The
    batch that reaches `most` is taken whole, or, if not whole, cut there. Batches are made in groups that double in number, so beyond the end at most as
    many are made as before it, and each group's rows are settled, so nothing is made twice. at_least_one: the first batch is made although `most` is reached.
    """
    taken, at, width = None, 0, 1
    while at < len(batches) and (before < most or (at_least_one and at == 0)):
        fresh = keep_first(make(list(batches[at : at + width])), "id", ["seq"])
        for earlier in (seen, taken):
            fresh = anti_seen(fresh, earlier) if earlier is not None else fresh
        fresh = settled(fresh)
        fresh = settled(cap_batches(fresh, "batch", most, before, at_least_one and at == 0))
        before += fresh.count()
        taken = fresh if taken is None else taken.unionByName(fresh)
        at, width = at + width, 2 * width
    if taken is None or whole or before <= most:
        return taken
    return first_rows(taken, most - before + taken.count(), ["seq"])


def until_first_empty(df: DataFrame, query: str = "query", page: str = "page", empty: str = "is_empty") -> DataFrame:
    """Of each query the pages before its first empty one."""
    stop = F.min(F.when(F.col(empty), F.col(page))).over(Window.partitionBy(query))
    name = free_name(df, "__stop")
    return df.withColumn(name, stop).filter(F.col(name).isNull() | (F.col(page) < F.col(name))).drop(name)


def count_by_year(df: DataFrame) -> DataFrame:
    return df.filter("Year is not null").groupBy("Year").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("Year"))


def top_sources(df: DataFrame, n: int = 10) -> DataFrame:
    """The n sources with most rows, ties by name."""
    return df.groupBy("Source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "Source").limit(n)


#: Rows of configuration of either side of requests().
CONFIGURED = 10_000


def requests(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every query with every month or page: both are configuration, of at most CONFIGURED rows, which is checked."""
    for side in (left, right):
        if side.limit(CONFIGURED + 1).count() > CONFIGURED:
            raise ValueError(f"requests() is for configuration of at most {CONFIGURED} rows on either side")
    return left.crossJoin(right)
