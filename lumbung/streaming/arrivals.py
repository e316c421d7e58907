"""Articles as they arrive: the rows of a week, each id once, by event time and with state that expires."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates


def week_arrivals(rows: DataFrame, as_of: str, *, key: str = "id", time: str = "pub", late: str = "7 days") -> DataFrame:
    """Of a stream of rows those whose time is in as_of's week, the first that arrives of each key.

    time: a column of timestamps; unknown ones are not in the week. Rows may come late by `late`, against the latest time that was seen; a key is remembered until the watermark is past its
    row, so the state is as large as what arrives within that time. What comes later than that is left out: with `late` of a week or more, and rows of one week, nothing is. Over a table
    that is no stream it gives one row of each key too.
    """
    named = rows.filter(dates.in_week(F.col(time), dates.instant(as_of)))
    if not rows.isStreaming:
        return named.dropDuplicates([key])
    return named.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
