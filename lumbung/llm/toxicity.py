"""Toxicity by a convolutional text classifier in numpy.

A word's embedding is the sum of three hashed ones: of the word and of its first bytes, which lets inflected forms share what
is learned. Filters over one, two and three words, a rectifier and max pooling over the whole text give a document's features, and a logistic layer its
logit. Trained with Adam; the gradient goes to each filter's best position only.

A filter over words is a sum of terms of one word each, so a trained model is a table of those terms by bucket: texts of any length are scored by
looking words up, and pooled over all their words.

Embeddings do not begin at random: the first coordinate of a bucket's is the log of how much likelier its words make label 1 (_begin), from which training
goes on. Training runs in one task, on a sample that is bounded in rows and characters; the driver gets the trained tables only, which have a fixed size.

A threshold for each language is chosen on rows that were kept from training; the language is guessed from function words of the text. Scores are the logistic
of the distance to it, moved so that the threshold is at CUT.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import free_name, frugal, prepare

#: Score from which a document is called toxic; the share of labelled rows that are held out is one in FOLDS.
CUT, FOLDS, HELD = 0.3, 4, 2
#: The most labelled rows that are learned from, toxic and not: the bound of the sample, taken by hash of the id.
TOXIC_ROWS, CLEAN_ROWS = 3000, 6000
#: The most characters of the sample, in the order of the same hash; a row that goes beyond is left out.
SAMPLE_CHARS = 1 << 26
#: Buckets of embeddings, their width, words of the filters, filters of each width, first bytes of a word that have their own embedding.
BUCKETS, WIDTH, SPANS, FILTERS, PREFIXES = 1 << 15, 8, (1, 2, 3), 6, (4, 6)
#: Documents of the sample that a bucket must be in to be learned: what is rarer says nothing about other documents.
SEEN = 5
EPOCHS, BATCH, RATE, DECAY, CALIBRATION = 5, 128, 0.02, 1e-4, 4

# Function words by which languages are told apart.
LANGUAGES = {
    "en": "the of and to is that it was for with are this".split(),
    "de": "der die und das ist nicht mit von den ein dem für".split(),
    "fr": "le les et des une est dans pour qui sur au pas".split(),
    "es": "el los las por con para una del como más y se".split(),
}


def _hash(words: list[str]) -> np.ndarray:
    return hashing.words([" ".join(words)], hashing.PLAIN).hashes


def _language_table() -> np.ndarray:
    """Language of the function word in each bucket of 2**16: 0 for none, else 1 + its place in LANGUAGES."""
    table = np.zeros(1 << 16, np.int8)
    for i, words in enumerate(LANGUAGES.values()):
        table[_hash(words) & np.uint64(0xFFFF)] = i + 1
    return table


_LANGUAGE = _language_table()


@dataclass
class Texts:
    """Texts as buckets: unique rows of buckets, the row of each word, the words of each text, its language (0: none)."""

    buckets: np.ndarray
    row: np.ndarray
    first: np.ndarray
    language: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def read_texts(texts: list[str | None]) -> Texts:
    found = hashing.words([t.lower() if t else t for t in texts], hashing.PLAIN)
    unique, at, row = np.unique(found.hashes, return_index=True, return_inverse=True)
    kinds = [found.hashes[at], *(found.prefix(n)[at] ^ np.uint64(n) for n in PREFIXES)]
    buckets = np.stack([(hashing.mix(k) % np.uint64(BUCKETS)).astype(np.int32) for k in kinds], 1) if len(at) else np.zeros((0, 1 + len(PREFIXES)), np.int32)
    doc = np.repeat(np.arange(len(texts)), np.diff(found.first))
    spoken = _LANGUAGE[(unique & np.uint64(0xFFFF)).astype(np.int64)][row] if len(at) else np.zeros(0, np.int8)
    counts = np.bincount(doc * (len(LANGUAGES) + 1) + spoken, minlength=len(texts) * (len(LANGUAGES) + 1)).reshape(len(texts), -1)[:, 1:]
    language = np.where(counts.max(1, initial=0) > 0, 1 + counts.argmax(1), 0) if len(texts) else np.zeros(0, np.int64)
    return Texts(buckets, row, found.first.astype(np.int64), language)


def _columns() -> list[tuple[int, int, slice]]:
    """Where the terms of the j-th word of the filters over n words are in a table's rows."""
    out, at = [], 0
    for n in SPANS:
        for j in range(n):
            out.append((n, j, slice(at, at + FILTERS)))
            at += FILTERS
    return out


_TERMS = _columns()


def pool(texts: Texts, table: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each text (its filters' best response, at least 0) and the word where it begins; -1 for texts without words."""
    n, full = len(texts.first) - 1, np.flatnonzero(texts.sizes)
    out, best = np.zeros((n, len(SPANS) * FILTERS)), np.full((n, len(SPANS) * FILTERS), -1)
    if not len(full):
        return out, best
    terms = table[texts.buckets].sum(1)
    starts, row = texts.first[full], texts.row
    end = np.repeat(texts.first[full + 1], texts.sizes[full])
    for s, span in enumerate(SPANS):
        response = np.zeros((len(row), FILTERS), np.float32)
        for size, j, at in _TERMS:
            if size != span:
                continue
            if j == 0:
                response += terms[row, at]
            else:  # words past the end of a text count as nothing
                inside = np.arange(j, len(row)) < end[:-j] if len(row) > j else np.zeros(0, bool)
                response[: len(row) - j] += terms[row[j:], at] * inside[:, None]
        columns = slice(s * FILTERS, (s + 1) * FILTERS)
        top = np.maximum.reduceat(response, starts, axis=0)
        out[full, columns] = np.maximum(top + bias[columns], 0)
        if table.dtype == np.float64:  # in training: where
            for f in range(FILTERS):
                hit = np.flatnonzero(response[:, f] == np.repeat(top[:, f], texts.sizes[full]))
                owner = np.searchsorted(starts, hit, side="right") - 1
                best[full[owner[::-1]], s * FILTERS + f] = hit[::-1]
    return out, best


class Model:
    """Embeddings, filters and the logistic layer, and thresholds by language."""

    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        self.p = {
            "e": r.normal(0, 0.05, (BUCKETS, WIDTH)), "bias": np.zeros(len(SPANS) * FILTERS), "out": r.normal(0.3, 0.05, len(SPANS) * FILTERS), "b": np.full(1, -2.0),
        }
        for n in SPANS:
            self.p[f"w{n}"] = r.normal(0, 0.3, (n, WIDTH, FILTERS))
        self.thresholds = np.zeros(1 + len(LANGUAGES))
        self.scale = 1.0
        self.fixed: np.ndarray | None = None

    def dump(self) -> bytes:
        """What scoring needs: the table of terms and the layers after it."""
        return pickle.dumps({"fixed": self.table().astype(np.float32), "p": {k: self.p[k] for k in ("bias", "out", "b")}, "thresholds": self.thresholds, "scale": self.scale})

    @classmethod
    def load(cls, data: bytes) -> Model:
        model = cls.__new__(cls)
        model.__dict__.update(pickle.loads(data))  # noqa: S301  made by dump() in a task of this very run
        return model

    def table(self) -> np.ndarray:
        """The filters' terms of each bucket; a loaded model has no more than these."""
        if self.fixed is not None:
            return self.fixed
        known = np.flatnonzero(self.p["e"].any(1))  # those that aren't learned stay at 0
        out = np.zeros((BUCKETS, _TERMS[-1][2].stop))
        out[known] = self.p["e"][known] @ np.concatenate([self.p[f"w{n}"][j] for n, j, _ in _TERMS], 1)
        return out

    def fit(self, texts: list[str | None], labels: np.ndarray, seed: int = 7) -> None:
        """Learns from some rows and calibrates on one in CALIBRATION; without both labels all logits are the base rate's."""
        labels = np.asarray(labels, float)
        if not len(labels) or labels.min() == labels.max():
            self.p["e"][:] = 0
            self.p["out"][:] = 0
            self.p["b"][:] = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 5))
            self.thresholds[:] = 0.0
            return
        r = np.random.default_rng(seed)
        order = r.permutation(len(labels))
        kept, tried = np.sort(order[len(order) // CALIBRATION :]), np.sort(order[: len(order) // CALIBRATION])
        if len(np.unique(labels[tried])) < 2 or len(np.unique(labels[kept])) < 2:
            kept = tried = np.arange(len(labels))
        known = [read_texts([texts[i] for i in kept[a:b]]) for a, b in hashing.chunks([texts[i] for i in kept], 1 << 18)]
        self._begin(known, labels[kept])
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step, parts = 0, np.cumsum([0, *(len(k.first) - 1 for k in known)])
        for _ in range(EPOCHS):
            for i in r.permutation(len(known)):
                step += 1
                self._step(known[i], labels[kept][parts[i] : parts[i + 1]], moments, step)
        read = (read_texts([texts[i] for i in tried[a:b]]) for a, b in hashing.chunks([texts[i] for i in tried]))
        found = [(self.logits(t), t.language) for t in read]
        self._calibrate(*(np.concatenate(x) for x in zip(*found, strict=True)), labels[tried])

    def _begin(self, known: list[Texts], labels: np.ndarray) -> None:
        """Buckets that few documents have stay at 0; the first coordinate of the others begins with how much likelier they make label 1."""
        counts, at = np.zeros((BUCKETS, 2)), 0
        for k in known:
            n = len(k.first) - 1
            doc = np.repeat(np.arange(n), k.sizes)
            pairs = np.unique(np.repeat(doc, k.buckets.shape[1]) * BUCKETS + k.buckets[k.row].ravel())
            np.add.at(counts, (pairs % BUCKETS, labels[at : at + n][pairs // BUCKETS].astype(int)), 1)
            at += n
        total = counts.sum(0) + 1
        odds = np.log((counts[:, 1] + 0.3) / total[1]) - np.log((counts[:, 0] + 1.0) / total[0])
        self.mask = (counts.sum(1) >= SEEN)[:, None]
        self.p["e"][:, 0] = np.clip(odds, 0, 6) / 3
        self.p["e"] *= self.mask
        for n in SPANS:
            self.p[f"w{n}"][0, 0] = np.abs(self.p[f"w{n}"][0, 0]) + 0.5
        self.p["b"][:] = np.log(labels.mean() / (1 - labels.mean())) - 1

    def logits(self, texts: Texts) -> np.ndarray:
        return pool(texts, self.table().astype(np.float32), self.p["bias"])[0] @ self.p["out"] + self.p["b"][0]

    def loss(self, texts: Texts, labels: np.ndarray) -> float:
        """Mean logistic loss, with the decay of the embeddings that are learned."""
        logits = pool(texts, self.table(), self.p["bias"])[0] @ self.p["out"] + self.p["b"][0]
        return float(np.mean(np.logaddexp(0, logits) - labels * logits)) + DECAY / 2 * float(((self.p["e"] * self.mask) ** 2).sum())

    def gradients(self, texts: Texts, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Those of loss(); a filter's goes to its best position only."""
        features, best = pool(texts, self.table(), self.p["bias"])
        n = len(labels)
        error = (1 / (1 + np.exp(-np.clip(features @ self.p["out"] + self.p["b"][0], -30, 30))) - labels) / n
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["out"], grads["b"] = features.T @ error, np.array([error.sum()])
        back = np.outer(error, self.p["out"]) * (features > 0)
        grads["bias"] = back.sum(0)
        for s, span in enumerate(SPANS):
            for f in range(FILTERS):
                c = s * FILTERS + f
                doc = np.flatnonzero(back[:, c])
                for j in range(span):
                    place = best[doc, c] + j
                    inside = place < texts.first[doc + 1]
                    d, rows = doc[inside], texts.buckets[texts.row[place[inside]]]
                    grads[f"w{span}"][j, :, f] += (self.p["e"][rows].sum(1) * back[d, c, None]).sum(0)
                    np.add.at(grads["e"], rows.ravel(), np.repeat(back[d, c, None] * self.p[f"w{span}"][j, :, f], rows.shape[1], axis=0))
        grads["e"] = (grads["e"] + DECAY * self.p["e"]) * self.mask
        return grads

    def _step(self, texts: Texts, labels: np.ndarray, moments: dict, step: int) -> None:
        """One step of Adam."""
        for k, g in self.gradients(texts, labels).items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.p[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    def _calibrate(self, logits: np.ndarray, languages: np.ndarray, labels: np.ndarray) -> None:
        """The threshold of each language that has 10 rows of either label, for the others that of all rows."""
        self.thresholds[:] = threshold(logits, labels)
        for language in range(1 + len(LANGUAGES)):
            rows = languages == language
            if labels[rows].sum() >= 10 and (1 - labels[rows]).sum() >= 10:
                self.thresholds[language] = threshold(logits[rows], labels[rows])
        self.scale = 1 / max(0.5, float(np.std(logits)))

    def scores(self, texts: Texts, table: np.ndarray) -> np.ndarray:
        logits = pool(texts, table, self.p["bias"])[0] @ self.p["out"] + self.p["b"][0]
        distance = (logits - self.thresholds[texts.language]) * self.scale
        return 1 / (1 + np.exp(-np.clip(distance + np.log(CUT / (1 - CUT)), -30, 30)))


def threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """Between the two logits where calling those above toxic has the best F1."""
    order = np.argsort(-logits, kind="stable")
    right = np.cumsum(labels[order])
    f1 = 2 * right / (np.arange(1, len(order) + 1) + labels.sum())
    f1[:-1][logits[order[1:]] == logits[order[:-1]]] = -1  # equal logits are called alike
    at = int(np.argmax(f1))
    below = logits[order[at + 1]] if at + 1 < len(order) else logits[order[at]] - 1
    return float((logits[order[at]] + below) / 2)


def held_out(doc_id: str = "doc_id"):  # noqa: ANN201
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == HELD


def train(docs: DataFrame, labels: DataFrame, *, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """A model of the labelled rows that are not held out, of which at most toxic_rows and clean_rows with `chars` characters are read, by hash of the id.

    Null ids, texts and labels are left out; a document with several labels counts as toxic if one is. Without any row all scores are equal.
    """
    prepare(docs.sparkSession)
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic_rows), (0, clean_rows))]
    chosen = parts[0].union(parts[1]).withColumnRenamed("doc_id", "label_id")  # bounded by the two limits, so it may be broadcast
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")
    first = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))  # an id that is repeated is learned once
    ordered = first.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("text", "toxic")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, truth, held = [], [], 0
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                if held + len(text) <= chars:
                    held += len(text)
                    texts.append(text)
                    truth.append(toxic)
        model = Model()
        model.fit(texts, np.array(truth))
        yield pd.DataFrame({"model": [model.dump()]})

    found = ordered.mapInPandas(frugal(fit), "model binary").collect()  # one row of a fixed size
    if found:
        return Model.load(bytes(found[0]["model"]))
    model = Model()
    model.fit([], np.zeros(0))
    return Model.load(model.dump())


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with a column of scores, in the same rows: nothing is joined, so repeated and null ids do not matter.

    Null, empty and blank texts have the score of a text without words. Equal texts have equal scores; an empty table gives no rows.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model.dump())  # of a fixed size

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Model.load(shared.value)
        table = model.table()
        for b in batches:
            texts = b.tolist()
            values = [model.scores(read_texts(texts[i:j]), table) for i, j in hashing.chunks(texts)]
            yield pd.Series(np.concatenate(values) if values else np.zeros(0))

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from frugal(run)(batches)

    return docs.withColumn(name, F.pandas_udf(scored, "double")("text"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs (doc_id, text); other columns are not read."""
    rows = with_score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the rows that the model calls toxic. Rows are judged each on its own: null ids, repeated rows and null texts stay unless their score is CUT or more."""
    name = free_name(docs, "__score")
    return with_score(docs, model, name).filter(F.col(name) < CUT).select(docs.columns)
