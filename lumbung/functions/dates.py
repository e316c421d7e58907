"""Dates: names of months, ambiguous formats, weeks. "Now" is always an argument, as_of, so results can be reproduced.

A parsed date is a struct: instant TIMESTAMP, to compare, and local TIMESTAMP_NTZ, the wall clock that calendar fields are taken from.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import shipped

# Names of months and days, and their abbreviations.
NAMES = {
    "januari": "January", "februari": "February", "maret": "March", "april": "April", "mei": "May", "juni": "June", "juli": "July",
    "agustus": "August", "september": "September", "oktober": "October", "november": "November", "desember": "December",
    "jan": "Jan", "feb": "Feb", "mar": "Mar", "apr": "Apr", "jun": "Jun", "jul": "Jul", "agu": "Aug", "ags": "Aug", "sep": "Sep", "sept": "Sep",
    "okt": "Oct", "nov": "Nov", "des": "Dec",
    "senin": "Monday", "selasa": "Tuesday", "rabu": "Wednesday", "kamis": "Thursday", "jumat": "Friday", "jum'at": "Friday", "sabtu": "Saturday", "minggu": "Sunday",
}
#: A date counts as future from this long after now on.
GRACE = "INTERVAL 1 DAY"
STRUCT = "struct<instant: timestamp, local: timestamp_ntz>"
_ISO = r"^\d{4}[-/]\d{2}[-/]\d{2}(?:[T ]|$)"
_DAY, _MONTH = r"0[1-9]|[12]\d|3[01]", r"0[1-9]|1[0-2]"
_TIME = r"(?:([T ]\d{2}:\d{2}(?::\d{2})?)(?:\.\d+)?\s?(Z|[+-]\d{2}:?\d{2})?)?"
#: Texts that can be read with the day, and with the month, first, ISO or in numbers with strokes or full stops; how to write them as "local|zone"; ISO texts alone, month first.
_DAY_FIRST = rf"^(?:(\d{{4}})[-/]({_DAY})[-/]({_MONTH}){_TIME}|({_DAY}|[1-9])[/.]({_MONTH}|[1-9])[/.](\d{{4}}))$", "$1$8-$3$7-$2$6$4|$5"
_MONTH_FIRST = rf"^(?:(\d{{4}})[-/]({_MONTH})[-/]({_DAY}){_TIME}|({_MONTH}|[1-9])[/.]({_DAY}|[1-9])[/.](\d{{4}}))$", "$1$8-$2$6-$3$7$4|$5"
_NUMERIC_DAY_FIRST = rf"^({_DAY}|[1-9])[/.]({_MONTH}|[1-9])[/.](\d{{4}})$", "$3-$2-$1|"


def instant(as_of: dt.datetime | str) -> Column:
    """A literal instant; without a zone it is UTC."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    as_of = as_of.replace(tzinfo=dt.UTC) if as_of.tzinfo is None else as_of
    return F.lit(as_of)


def is_future(x: Column, as_of: Column) -> Column:
    """More than a day after as_of; false for null."""
    return F.coalesce(x > as_of + F.expr(GRACE), F.lit(False))


def translate_names(x: Column) -> Column:
    """Names of months and days in English. The longest come first, and no result is a name to replace."""
    for name in sorted(NAMES, key=len, reverse=True):
        x = F.regexp_replace(x, rf"(?i)(?<![a-zA-Z]){name}(?![a-zA-Z])", NAMES[name])
    return x


def _written(x: Column, pattern: tuple[str, str]) -> Column:
    """A text as "local|zone", null if it isn't of the pattern. Patterns let no month and no day of the month through that there can't be, so casts rarely fail."""
    return F.when(x.rlike(pattern[0]), F.regexp_replace(x, *pattern))


def _split(written: Column) -> Column:
    return F.split(written, r"\|")


def _wall(parts: Column) -> Column:
    """The local time of what _written() gives, split; null for days that there aren't."""
    return F.get(parts, 0).try_cast("timestamp_ntz")


def _minutes(parts: Column) -> Column:
    """What to add to a local time for UTC."""
    zone = F.replace(F.get(parts, 1), F.lit(":"))
    size = F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int")
    return F.when(F.length(zone) > 1, F.when(F.startswith(zone, F.lit("-")), size).otherwise(-size)).otherwise(0)


def _moment(wall: Column, minutes: Column) -> Column:
    """The struct of a local time; without a zone, it is read as UTC."""
    return F.when(wall.isNotNull(), F.struct(F.timestamp_add("MINUTE", minutes, wall).cast("timestamp").alias("instant"), wall.alias("local")))


def _patterns(swap: bool) -> tuple[tuple[str, str], tuple[str, str]]:
    return _DAY_FIRST if swap else _NUMERIC_DAY_FIRST, _MONTH_FIRST


#: Names of months and days in both languages, in lower case: months by number, days for any.
_ENGLISH_MONTHS = "january february march april may june july august september october november december".split()
_ENGLISH_DAYS = "monday tuesday wednesday thursday friday saturday sunday".split()


def _month_numbers() -> dict[str, int]:
    known = {n: i + 1 for i, m in enumerate(_ENGLISH_MONTHS) for n in (m, m[:3])} | {"sept": 9}
    return known | {k: known[v.lower()] for k, v in NAMES.items() if v.lower() in known}


_MONTHS = _month_numbers()
_DAYS = sorted({d for m in _ENGLISH_DAYS for d in (m, m[:3])} | {k for k, v in NAMES.items() if v.lower() in _ENGLISH_DAYS}, key=len, reverse=True)
_NAMED = (
    rf"(?i)^(?:(?:{'|'.join(_DAYS)}),?\s+)?(\d{{1,2}})\s+({'|'.join(sorted(_MONTHS, key=len, reverse=True))}),?\s+(\d{{4}})(?:,?\s+(\d{{1,2}}:\d{{2}}(?::\d{{2}})?)(?:\s*(?:WIB|WITA|WIT|GMT|UTC|([+-]\d{{4}})))?)?$",
    "$1|$2|$3|$4|$5",
)


def _named(names: Column) -> Column:
    """Texts such as "Kamis, 12 Maret 2026 10:00 WIB" or "Thu, 12 Mar 2026 10:00:00 +0700", as split by _NAMED, as _written() gives them. Names of zones count as none, as UTC does."""
    month = F.try_element_at(F.create_map(*[F.lit(v) for name, n in _MONTHS.items() for v in (name, str(n))]), F.lower(F.get(names, 1)))
    time = F.when(F.get(names, 3) != "", F.concat(F.lit("T"), F.get(names, 3))).otherwise(F.lit(""))
    return F.concat(F.concat_ws("-", F.get(names, 2), month, F.get(names, 0)), time, F.lit("|"), F.get(names, 4))


def _reader(as_of: dt.datetime, swap: bool):  # noqa: ANN202
    """A function from a text to its readings by dateutil, day first and month first, after translate_names()'s rule, missing parts from as_of's day; it remembers texts."""
    from dateutil import parser

    names = re.compile(r"(?<![a-zA-Z])(?:" + "|".join(sorted(NAMES, key=len, reverse=True)) + r")(?![a-zA-Z])", re.IGNORECASE)
    iso, default = re.compile(_ISO), as_of.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
    known: dict[str, list] = {}

    def read(text: str) -> list[dict]:
        if text in known:
            return known[text]
        if len(known) > 50_000:  # dates repeat, and parsing them is slow
            known.clear()
        found: list = []
        english = names.sub(lambda m: NAMES[m[0].lower()], text)
        for day_first in (True, False) if swap or not iso.match(text) else (False,):
            try:
                value = parser.parse(english, dayfirst=day_first, default=default)
                utc = (value.astimezone(dt.UTC) if value.tzinfo else value).replace(tzinfo=None)
            except Exception:  # noqa: BLE001, S112  what isn't a date has no reading
                continue
            if all(f["instant"] != utc for f in found):
                found.append({"instant": utc, "local": value.replace(tzinfo=None)})
        known[text] = found
        return found

    return read


def _other_udf(as_of: dt.datetime):  # noqa: ANN202
    """Readings of texts that no expression reads."""
    shipped()

    @F.pandas_udf(f"array<{STRUCT}>")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = _reader(as_of, True)
        for b in batches:
            yield pd.Series([(read(t) or None) if t is not None else None for t in b], dtype="object")

    return parse


def first_date(raws: Column, as_of: dt.datetime | str, *, policy: str = "reference") -> Column:
    """The first of an array of texts that parse_date() reads, in one evaluation for arrays of any length; null if none is read."""
    moment = (dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of).replace(tzinfo=None)
    return F.get(_first_udf(moment, _swaps(policy))(F.when(F.size(raws) > 0, raws)), 0)


def _first_udf(moment: dt.datetime, swap: bool):  # noqa: ANN202
    """The first of an array of texts that dateutil reads, as an array of one; null if none is."""
    shipped()

    @F.pandas_udf(f"array<{STRUCT}>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read, latest = _reader(moment, swap), moment + dt.timedelta(days=1)
        blank = re.compile(r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\Z")
        for b in batches:
            yield pd.Series([next(([f] for t in (x if x is not None else ()) if t and (s := blank.sub("", t)) for f in read(s) if f["instant"] <= latest), None) for x in b], dtype="object")

    return find


def with_first_date(df: DataFrame, raws: Column, name: str, as_of: dt.datetime | str, *, policy: str = "reference") -> DataFrame:
    """df with a column of first_date(), by expressions over the array: of ISO dates, numeric ones and those with a month's name no text goes to Python.

    What no expression reads, and stands before the first that one does, goes to dateutil; for rows without such texts that is an empty batch entry.
    """
    moment = (dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of).replace(tzinfo=None)
    one, two = _patterns(_swaps(policy))
    own = "__first_"
    while any(c.lower().startswith(own) for c in df.columns):
        own += "_"
    past = lambda c: F.when(~is_future(c["instant"], instant(as_of)), c)
    # each step adds fields to what is known of each text
    steps = [
        lambda s: {"one": _written(s["text"], one), "two": _written(s["text"], two)},
        lambda s: {"names": F.when(F.coalesce(s["one"], s["two"]).isNull(), _split(_written(s["text"], _NAMED)))},
        lambda s: {"named": F.when(s["names"].isNotNull(), _named(s["names"]))},
        lambda s: {"parts": _split(F.coalesce(s["one"], s["named"])), "others": _split(s["two"])},
        lambda s: {"wall": _wall(s["parts"]), "minutes": _minutes(s["parts"]), "wall_two": _wall(s["others"]), "minutes_two": _minutes(s["others"])},
        lambda s: {"first": _moment(s["wall"], s["minutes"]), "second": _moment(s["wall_two"], s["minutes_two"])},
    ]
    read = df.withColumn(own + "each", F.transform(F.filter(raws, lambda x: x.isNotNull()), lambda x: F.struct(stripped(x).alias("text"))))
    def grown(step) -> Column:  # noqa: ANN001
        added = lambda s: reduce(lambda to, field: to.withField(*field), step(s).items(), s)
        return F.transform(own + "each", lambda s: added(s))

    for step in steps:
        read = read.withColumn(own + "each", grown(step))
    done = F.transform(own + "each", lambda s: F.struct(F.coalesce(past(s["first"]), past(s["second"])).alias("date"), F.when(s["first"].isNull() & s["second"].isNull() & (s["text"] != ""), s["text"]).alias("open")))
    read = read.withColumn(own + "done", done)
    at = F.array_position(F.transform(own + "done", lambda s: s["date"].isNotNull()), F.lit(True))
    before = F.filter(F.transform(F.when(at > 0, F.slice(own + "done", F.lit(1), F.greatest(at - 1, F.lit(0)).cast("int"))).otherwise(F.col(own + "done")), lambda s: s["open"]), lambda x: x.isNotNull())
    read = read.withColumn(own + "at", at).withColumn(own + "open", F.when(F.size(before) > 0, before))
    read = read.withColumn(own + "other", _first_udf(moment, _swaps(policy))(F.col(own + "open")))
    found = F.coalesce(F.get(F.col(own + "other"), 0), F.get(own + "done", (F.col(own + "at") - 1).cast("int"))["date"])
    return read.withColumn(name, found).drop(*[own + c for c in ("each", "done", "at", "open", "other")])


def stripped(raw: Column) -> Column:
    """The text that parse_date() reads; as a column of its own, it is made once and not in each part of the expression."""
    return F.regexp_replace(raw, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def _swaps(policy: str) -> bool:
    if policy not in ("reference", "iso_strict"):
        raise ValueError(f"unknown policy {policy!r}")
    return policy == "reference"


def with_date(df: DataFrame, raw: Column, name: str, as_of: dt.datetime | str, *, policy: str = "reference") -> DataFrame:
    """df with a column of parse_date(). What the steps make is a column each, so every text is read once."""
    moment = (dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of).replace(tzinfo=None)
    one, two = _patterns(_swaps(policy))
    own = "__date_"
    while any(c.lower().startswith(own) for c in df.columns):
        own += "_"
    column = lambda x: F.col(own + x)
    past = lambda c: F.when(~is_future(c["instant"], instant(as_of)), c)
    # each step is small enough to be compiled well
    steps = [
        {"text": stripped(raw)},
        {"one": _written(column("text"), one), "two": _written(column("text"), two)},
        {"names": F.when(F.coalesce(column("one"), column("two")).isNull(), _split(_written(column("text"), _NAMED)))},
        {"named": F.when(column("names").isNotNull(), _named(column("names")))},
        {"parts": _split(F.coalesce(column("one"), column("named"))), "others": _split(column("two"))},
        {"wall": _wall(column("parts")), "minutes": _minutes(column("parts"))},
        {"wall_two": _wall(column("others")), "minutes_two": _minutes(column("others"))},
        {"first": _moment(column("wall"), column("minutes"))},
        {"second": _moment(column("wall_two"), column("minutes_two"))},
        {"other": _other_udf(moment)(F.when(column("first").isNull() & column("second").isNull() & (column("text") != ""), column("text")))},
    ]
    read = df
    for step in steps:
        read = read.withColumns({own + c: x for c, x in step.items()})
    found = F.coalesce(past(column("first")), past(column("second")), F.get(F.filter(column("other"), lambda c: ~is_future(c["instant"], instant(as_of))), 0))
    return read.withColumn(name, found).drop(*[own + c for step in steps for c in step])


def parse_date(raw: Column, as_of: dt.datetime | str, *, policy: str = "reference", strip: bool = True) -> Column:
    """A struct of instant and local, or null: the first reading of a text that isn't in the future, day first.

    policy "reference" also reads ISO dates day first, so 2025-03-12 is 3 December if that is past; "iso_strict" reads them as they stand. Numeric
    formats and those with a month's name are Spark expressions; only other texts go to Python. In a table, with_date() does the same with less work.
    """
    moment = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    text = stripped(raw) if strip else raw
    one, two = (_written(text, p) for p in _patterns(_swaps(policy)))
    parts = [_split(F.coalesce(one, _named(_split(_written(text, _NAMED))))), _split(two)]
    first, second = (_moment(_wall(p), _minutes(p)) for p in parts)
    other = _other_udf(moment.replace(tzinfo=None))(F.when(first.isNull() & second.isNull() & (text != ""), text))
    past = lambda c: ~is_future(c["instant"], instant(as_of))
    return F.coalesce(F.when(past(first), first), F.when(past(second), second), F.get(F.filter(other, past), 0))


def date_from_url(url: Column, as_of: Column) -> Column:
    """The date of the first /yyyy/mm/dd/ in a URL; null if it isn't a day or is in the future."""
    found = F.regexp_extract(url, r"/(\d{4})/(\d{2})/(\d{2})/", 0)
    day = F.try_to_timestamp(F.when(found != "", found), F.lit("/yyyy/MM/dd/"))
    return F.when(day.isNotNull() & ~is_future(day, as_of), F.struct(day.alias("instant"), day.cast("timestamp_ntz").alias("local")))


def week_fields(local: Column) -> dict[str, Column]:
    """Year, Month, Week (ISO), Minggu_ke (week of the month), Minggu_Mulai (Monday) and Week_Label of a wall-clock time; null for null."""
    day = local.cast("date")
    monday = F.date_sub(day, F.weekday(day))
    iso_year = F.year(F.date_add(monday, 3))
    return {
        "Year": F.year(day), "Month": F.month(day), "Week": F.weekofyear(day), "Minggu_ke": (F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("int"),
        "Minggu_Mulai": F.date_format(monday, "yyyy-MM-dd"), "Week_Label": F.when(day.isNotNull(), F.format_string("%d-W%02d", iso_year, F.weekofyear(day))),
    }


def week_label(as_of: Column) -> Column:
    return week_fields(as_of)["Week_Label"]


def commit_label(as_of: Column) -> Column:
    """Week of the year counted from its first Monday, and the year: 00 before it."""
    day = as_of.cast("date")
    return F.format_string("W%02d-%d", F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int"), F.year(day))


def week_window(as_of: Column) -> tuple[Column, Column]:
    """Monday 00:00:00 to Sunday 23:59:59 of as_of's week, as instants."""
    begin = F.date_trunc("week", as_of)
    return begin, begin + F.expr("INTERVAL '6 23:59:59' DAY TO SECOND")


def in_week(x: Column, as_of: Column) -> Column:
    """Within as_of's week, ends included; false for null."""
    begin, end = week_window(as_of)
    return F.coalesce(x.between(begin, end), F.lit(False))


def row_in_week(as_of: Column, year: str = "Year", monday: str = "Minggu_Mulai") -> Column:
    """A row's Year is the week's, and its Monday, if it has one, too."""
    begin, end = week_window(as_of)
    same = F.coalesce(F.col(year).isin(F.year(begin), F.year(end)), F.lit(False))
    return same & (F.col(monday).isNull() | (F.col(monday) == "") | (F.col(monday) == F.date_format(begin, "yyyy-MM-dd")))


def last_months(spark: SparkSession, as_of: dt.datetime | str, n: int = 3) -> DataFrame:
    """month_start and month_end (the first of the next) of the last n months, as_of's included, in order."""
    first = F.trunc(instant(as_of).cast("date"), "MM")
    months = F.explode(F.sequence(F.add_months(first, 1 - n), first, F.expr("INTERVAL 1 MONTH"))).alias("month_start")
    return spark.range(1).select(months).select("month_start", F.add_months("month_start", 1).alias("month_end"))


def months_of(spark: SparkSession, years: list[int], as_of: dt.datetime | str) -> DataFrame:
    """The same for all months of some years that have begun at as_of."""
    rows = spark.createDataFrame([(y,) for y in years], "year int")
    months = F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(1)), F.expr("INTERVAL 1 MONTH")))
    found = rows.select(months.alias("month_start")).filter(F.col("month_start") <= instant(as_of).cast("date"))
    return found.select("month_start", F.add_months("month_start", 1).alias("month_end"))
