"""Language identification by word-first backoff.

Training counts, per language, words and the character n-grams of ``" word "`` for n = 5 to 1, on
a bounded sample of labelled documents. A known word scores its log frequency in each language.
An unseen word falls back to its 5-grams; if none of them is known to its 4-grams, and so on down
to single characters, and scores the mean log frequency of those known. A document's language has
the largest sum over all its words; ``score`` is the posterior under equal priors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetdoc.llm.common import bound_batches

#: Labelled documents to learn from, and documents of each language at least. All their words and
#: n-grams are kept.
TRAIN_DOCS, LEAST_DOCS = 1_200, 300
LONGEST_GRAM = 5
MAX_WORD = 64
CACHE_ROWS = 150_000
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty where the text has no letter."""
    words = _WORD.findall(text.lower()) if text else []
    return words if any(any(map(str.isalpha, w)) for w in words) else []


def _grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies: ``rows[0]`` gives a word's row of ``logs``, ``rows[n]`` an n-gram's; a
    column per language."""

    langs: list[str]
    rows: list[dict[str, int]]
    logs: np.ndarray

    def known(self, word: str) -> list[int]:
        """Rows that stand for a word: its own, else those of its longest known n-grams."""
        row = self.rows[0].get(word)
        if row is not None:
            return [row]
        for n in range(LONGEST_GRAM, 0, -1):
            rows = self.rows[n]
            found = [rows[g] for g in _grams(word, n) if g in rows]
            if found:
                return found
        return []

    def words(self, words: list[str]) -> np.ndarray:
        """A row of log frequencies for each word; zeros where nothing of it is known."""
        out = np.zeros((len(words), len(self.langs)))
        found = [self.known(w) for w in words]
        many = np.array([len(f) for f in found])
        some = np.flatnonzero(many)
        if len(some):
            flat = np.fromiter((r for f in found for r in f), np.int64, many.sum())
            starts = np.concatenate(([0], np.cumsum(many[some])[:-1]))
            out[some] = np.add.reduceat(self.logs[flat], starts, axis=0) / many[some, None]
        return out


class _Scores(dict):
    """Word -> row of ``matrix``: the words that a worker has scored so far."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.matrix = np.empty((0, len(model.langs)))

    def learn(self, words: set[str]) -> None:
        """Score those words that are new; a full cache is emptied first."""
        if len(self) > CACHE_ROWS:
            self.clear()
            self.matrix = self.matrix[:0]
        new = [w for w in words - self.keys() if len(w) <= MAX_WORD]
        self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
        self.matrix = np.concatenate((self.matrix, self.model.words(new)))

    def total(self, words: list[str]) -> np.ndarray:
        long = [w for w in words if len(w) > MAX_WORD]
        if long:
            words = [w for w in words if len(w) <= MAX_WORD]
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.matrix[rows].sum(axis=0) + self.model.words(long).sum(axis=0)


def train(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = TRAIN_DOCS) -> LanguageModel | None:
    """Learn from the rows of ``docs`` that have a language and a text (None if there are none).

    About ``most`` distinct texts are used, in equal parts for the languages but LEAST_DOCS of each
    where there are so many, chosen by a hash of their text, so that reruns agree; counting runs in
    the tasks and is pre-aggregated before the shuffle. What comes to the driver are the entries of
    this bounded sample, all of them."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").count().collect()
    if not sizes:
        return None
    each = max(most // len(sizes), LEAST_DOCS)
    share = F.create_map(*(F.lit(x) for name, n in sizes for x in (name, (1 << 40) * min(each, n) // n)))
    h = F.xxhash64("text")
    rows = rows.where(F.pmod(h, F.lit(1 << 40)) < share[F.col("lang")])
    rows = rows.groupBy("lang", h.alias("h")).agg(F.first("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        for batch in batches:
            for name, t in zip(batch["lang"], batch["text"], strict=True):
                words.update((name, w) for w in letters(t) if len(w) <= MAX_WORD)
        found: Counter = Counter()
        for (name, w), c in words.items():
            found[name, 0, w] = c
            for n in range(1, LONGEST_GRAM + 1):
                for g in _grams(w, n):
                    found[name, n, g] += c
        keys = list(found)
        if keys:
            yield pd.DataFrame({"lang": [k[0] for k in keys], "n": [k[1] for k in keys], "gram": [k[2] for k in keys], "c": [found[k] for k in keys]})

    counts = (
        rows.mapInPandas(count, "lang string, n int, gram string, c long")
        .groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
        .groupBy("n", "gram").agg(F.sum("c").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "c"))).alias("by"))
    )
    got = counts.orderBy("n", "gram").collect()
    langs = sorted({name for r in got for name in r["by"]})
    if not langs:
        return None
    seen = np.array([[r["by"].get(name, 0) for name in langs] for r in got]) + 0.5
    order = np.array([r["n"] for r in got])
    for n in range(LONGEST_GRAM + 1):
        seen[order == n] /= seen[order == n].sum(axis=0)
    rows: list[dict[str, int]] = [{} for _ in range(LONGEST_GRAM + 1)]
    for i, r in enumerate(got):
        rows[r["n"]][r["gram"]] = i
    return LanguageModel(langs, rows, np.log(seen))


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out`` of ``lang`` and ``score`` (0 to 1).

    A null text, one without a letter, or an untrained model gives ``und`` with score 0. Equal
    sums go to the language that comes first by code point. Only the text is looked at; other
    columns stay (one named ``out`` is replaced)."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores_of = _Scores(shared.value) if shared.value else None
        for batch in batches:
            texts = [letters(t) if scores_of is not None else [] for t in batch]
            if scores_of is not None:
                scores_of.learn(set().union(*texts))
            langs, scores = [], []
            for words in texts:
                if not words:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                total = scores_of.total(words)
                best = int(np.argmax(total))
                langs.append(scores_of.model.langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pd.DataFrame({"lang": langs, "score": scores})

    return docs.withColumn(out, guess(F.col(text)))


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text modulo ``folds``; a row without an id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(0))
