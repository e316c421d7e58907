"""Labels from ordered lexicons: as expressions, and over an automaton for lexicons of tens of thousands of keywords."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..ship import shipped
from .automaton import Automaton
from .lexicon import DEFAULT_PLACE, DEFAULT_TOPIC, PROVINCES, Lexicon
from .text import any_keyword, every_match_pattern


def label_place(text: Column, lexicon: Lexicon = PROVINCES, default: str = DEFAULT_PLACE) -> Column:
    """The first category, in the lexicon's order, that has a keyword in the text."""
    return F.coalesce(*[F.when(any_keyword(text, words), F.lit(name)) for name, words in lexicon.items()], F.lit(default))


def _categories(lexicon: Lexicon) -> dict[str, list[int]]:
    """Of each keyword in small letters the categories, by place, that have it or a keyword which it begins with: wherever it is found, those are found too."""
    words = {w.lower() for ws in lexicon.values() for w in ws}
    begins = {w: [v for v in words if w == v or (w.startswith(v) and not re.match(r"\w", w[len(v)]))] for w in words}
    return {w: [i for v in begins[w] for i, ws in enumerate(lexicon.values()) for x in ws if x.lower() == v] for w in sorted(words)}


def label_topic(title: Column, content: Column, lexicon: Lexicon, default: str = DEFAULT_TOPIC) -> Column:
    """The category of a title.

    Categories with a keyword in the title compete: most matches in the content win (each keyword counted on its own), then the first
    place in the title, then the lexicon's order. Counting is left out if only one competes. Lexicons of all sizes take one pass with one pattern over each text.
    """
    if not lexicon:
        return F.lit(default)
    known = _categories(lexicon)
    owners = F.create_map(*[x for word, places in known.items() for x in (F.lit(word), F.array(*map(F.lit, places)))])
    pattern, names = F.lit(every_match_pattern(list(known))), F.array(*map(F.lit, lexicon))

    def found(text: Column) -> Column:
        """An array for each match, in order: the categories that it speaks for."""
        return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), pattern, F.lit(1)), lambda w: F.try_element_at(owners, F.lower(w)))

    def best(matches: Column) -> Column:
        competing = F.array_distinct(F.flatten(matches))

        def pick(counts: Column) -> Column:
            place = lambda c: F.array_position(F.transform(matches, lambda m: F.array_contains(m, c)), F.lit(True))
            rows = F.transform(competing, lambda c: F.struct((-F.size(F.filter(counts, lambda x: x == c))).alias("f"), place(c).alias("p"), c.alias("i")))
            return F.array_min(rows)["i"]

        none = F.array().cast("array<int>")
        several = F.transform(F.array(F.when(F.size(competing) > 1, F.flatten(found(content))).otherwise(none)), pick)
        return F.when(F.size(competing) > 0, F.get(names, F.get(several, 0)))

    return F.coalesce(F.get(F.transform(F.array(found(title)), best), 0), F.lit(default))


class Labels:
    """The rules of label_topic() and label_place() over an automaton of all keywords, for lexicons that are too large for a pattern."""

    def __init__(self, lexicon: Lexicon) -> None:
        words = sorted({w.lower() for ws in lexicon.values() for w in ws})
        number = {w: i for i, w in enumerate(words)}
        self.names = list(lexicon)
        self.owners: list[list[int]] = [[] for _ in words]
        for i, ws in enumerate(lexicon.values()):
            for w in ws:
                self.owners[number[w.lower()]].append(i)
        self.automaton = Automaton(words)

    def _by_text(self, texts: list[str | None]) -> list[list[tuple[int, int]]]:
        """(place, category) of the matches in each text, in order; a category as often as it has the keyword."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for text, keyword, place in zip(*(x.tolist() for x in self.automaton.find(texts)), strict=True):
            out[text] += [(place, c) for c in self.owners[keyword]]
        return out

    def topics(self, titles: list[str | None], contents: list[str | None]) -> list[str | None]:
        """The category of each title; None if there is none. Contents are read only where several compete."""
        first = []
        for matches in self._by_text(titles):
            places: dict[int, int] = {}
            for place, c in matches:
                places.setdefault(c, place)
            first.append(places)
        open_ = [i for i, p in enumerate(first) if len(p) > 1]
        counts = dict(zip(open_, (Counter(c for _, c in m) for m in self._by_text([contents[i] for i in open_])), strict=True))
        best = [min(p, key=lambda c: (-counts[i][c] if i in counts else 0, p[c], c)) if p else None for i, p in enumerate(first)]  # noqa: B023  used at once
        return [None if b is None else self.names[b] for b in best]

    def places(self, texts: list[str | None]) -> list[str | None]:
        """The first category, in the lexicon's order, that has a keyword in each text."""
        return [self.names[min(c for _, c in m)] if m else None for m in self._by_text(texts)]


def _column(of, spark: SparkSession | None, *columns: Column) -> Column:  # noqa: ANN001
    """What a function from lists of texts to a list of texts makes of columns, with its Labels broadcast."""
    shipped(spark)

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(of(*([x if isinstance(x, str) else None for x in b] for b in batch)), dtype="object")

    return run(*columns)


def label_topic_large(spark: SparkSession, title: Column, content: Column, lexicon: Lexicon, default: str) -> Column:
    """label_topic() for lexicons of any size: the plan stays as large as it is, whatever the lexicon, which is broadcast as arrays of a checked size (automaton.TABLE_BYTES)."""
    shared = spark.sparkContext.broadcast(Labels(lexicon))
    return F.coalesce(_column(lambda a, b: shared.value.topics(a, b), spark, title, content), F.lit(default))


def label_place_large(spark: SparkSession, text: Column, lexicon: Lexicon, default: str) -> Column:
    """label_place() likewise."""
    shared = spark.sparkContext.broadcast(Labels(lexicon))
    return F.coalesce(_column(lambda a, _: shared.value.places(a), spark, text, F.lit("")), F.lit(default))


def topic_of(title: str, content: str | None, compiled: list[tuple[str, list[re.Pattern]]], default: str = DEFAULT_TOPIC) -> str:
    """The same rule for one row, said plainly in Python; the tests hold label_topic() against it."""
    places = {}
    for i, (name, patterns) in enumerate(compiled):
        found = [m.start() for p in patterns if (m := p.search(title))]
        if found:
            places[i, name] = min(found)
    if not places:
        return default
    if len(places) == 1:
        return next(iter(places))[1]
    counts = {i: sum(len(p.findall(content or "")) for p in compiled[i][1]) for i, _ in places}
    return min(places, key=lambda k: (-counts[k[0]], places[k], k[0]))[1]


def compiled(lexicon: Lexicon) -> list[tuple[str, list[re.Pattern]]]:
    return [(name, [re.compile(rf"\b{re.escape(w)}\b", re.IGNORECASE) for w in words]) for name, words in lexicon.items()]
