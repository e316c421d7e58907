"""String functions as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str methods know it: Unicode's, and the separators 0x1C to 0x1F.
BLANK = r"(?U)[\s\x1c-\x1f]"
CONTENT = 2000
MEDIA = r"\.(jpg|png|mp4|gif|jpeg|webp)\z"


def _quoted(keyword: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", keyword)


def word_pattern(keywords: str | Sequence[str]) -> str:
    """Whole words, any case, with Unicode's letters and digits; an inner space is one space."""
    words = [keywords] if isinstance(keywords, str) else list(keywords)
    return rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(map(_quoted, words))})(?![\p{{L}}\p{{N}}_])"


def every_match_pattern(keywords: Sequence[str]) -> str:
    """A pattern whose matches are empty, one wherever a keyword begins, also within others; group 1 is the longest that begins there."""
    words = "|".join(map(_quoted, sorted(keywords, key=lambda w: (-len(w), w))))
    return rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?=({words})(?![\p{{L}}\p{{N}}_]))"


def any_keyword(text: Column, keywords: Sequence[str]) -> Column:
    return text.rlike(word_pattern(keywords))


def keyword_count(text: Column, keywords: Sequence[str]) -> Column:
    """Matches of each keyword, added up: those that overlap count each."""
    return reduce(lambda a, b: a + b, [F.regexp_count(text, F.lit(word_pattern(k))) for k in keywords]).cast("int")


def keyword_position(text: Column, keywords: Sequence[str]) -> Column:
    """Where the first match of any keyword begins, from 1; null if there is none."""
    return F.nullif(F.regexp_instr(text, F.lit(word_pattern(keywords))), F.lit(0))


def clean_text(x: Column) -> Column:
    """White space collapsed and stripped; "" for null."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), BLANK + "+", " "))


def strip_text(x: Column) -> Column:
    return F.regexp_replace(x, rf"^{BLANK}+|{BLANK}+\z", "")


def truncate(x: Column, n: int = CONTENT) -> Column:
    """The first n code points."""
    return F.substring(x, 1, n)


def url_id(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 12)


def title_case(x: Column) -> Column:
    """A capital after every character that is no letter, small letters elsewhere, for texts without white space."""
    return F.regexp_replace(F.initcap(F.regexp_replace(x, r"([^\p{L}])", "$1 ")), r"([^\p{L}]) ", "$1")


def domain_source(url: Column) -> Column:
    """The host without www., .com and .co.id, in title case; News without a host."""
    host = F.regexp_extract(url, r"https?://(?:www\.)?([^/]+)", 1)
    bare = F.replace(F.replace(host, F.lit(".com"), F.lit("")), F.lit(".co.id"), F.lit(""))
    return F.when(host == "", F.lit("News")).otherwise(title_case(bare))


def quote_query(x: Column) -> Column:
    """Percent-encoded for a query string, spaces as %20."""
    return F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def not_media(url: Column) -> Column:
    """Whether a URL doesn't end like a picture or a film; case counts."""
    return ~url.rlike(MEDIA)


def url_keyword(url: Column, pattern: Column | str | None) -> Column:
    """Whether a source's filter is found in a URL, in any case; a null filter lets all pass."""
    if pattern is None:
        return F.lit(True)
    if isinstance(pattern, str):
        return url.rlike("(?i)" + pattern)
    return pattern.isNull() | F.regexp_like(url, F.concat(F.lit("(?i)"), pattern))


def topic_url_pattern(lexicon: dict[str, list[str]]) -> str:
    """Keywords of four characters and more as they stand in URLs, the longest first."""
    slugs = {re.sub(r"\s+", "[-_.]", k.strip()) for words in lexicon.values() for k in words if len(k.replace(" ", "")) >= 4}
    return "(" + "|".join(sorted(slugs, key=lambda s: (-len(s), s))) + ")"
