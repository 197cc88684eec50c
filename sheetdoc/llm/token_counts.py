"""Token counts by a map-side two-tier lookup.

The unit is the pre-token that white space delimits. The vocabulary's own pre-tokenizer drops
white space, its normalizer works on runs between spaces, and its special strings hold no space,
so a text has as many tokens as its white-space runs have together. Tier one is a compact table
``run -> tokens`` of the most frequent runs, taken from a bounded sample and broadcast. Tier two
is a cache in each Python worker: a run that tier one lacks is encoded once by the library and
remembered. Nothing is shuffled; both tiers only save encoding, every count is the library's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetdoc.llm.common import bound_batches

#: Documents (about) of the sample that names the frequent runs, and how many of these are broadcast.
#: With runs of at most MAX_RUN bytes the broadcast table stays under about 5 MB.
SAMPLE_DOCS = 2000
TABLE_ROWS = 30_000
MAX_RUN = 64
#: Entries of a worker's cache (about 60 MB); a full cache loses its older half.
CACHE_ROWS = 400_000
#: Runs that the library encodes in one call.
CALL = 256


class _Lengths(dict):
    """Tokens of each white-space run; a missing run is encoded and remembered."""

    def __init__(self, tokenizer_file: str, frequent: dict[bytes, int]):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.frequent = frequent
        super().__init__(frequent)

    def encode(self, runs: list[bytes]) -> list[int]:
        out: list[int] = []
        for at in range(0, len(runs), CALL):
            texts = [r.decode() for r in runs[at : at + CALL]]
            of = self.tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False).word_ids
            out += np.bincount(of, minlength=len(texts)).tolist() if of else [0] * len(texts)
        return out

    def learn(self, runs: set[bytes]) -> None:
        """Encode the short runs of ``runs`` that are unknown, in one call."""
        if len(self) > CACHE_ROWS:
            newer = list(self.items())[-(CACHE_ROWS // 2) :]
            self.clear()
            self.update(self.frequent)
            self.update(newer)
        new = [r for r in runs - self.keys() if len(r) <= MAX_RUN]
        self.update(zip(new, self.encode(new), strict=True))

    def __missing__(self, run: bytes) -> int:
        return self.encode([run])[0]


def _frequent_runs(docs: DataFrame, text: str, tokenizer_file: str) -> dict[bytes, int]:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.iloc[:, 0]:
                if t:
                    seen.update(r for r in t.encode().split() if len(r) <= MAX_RUN)
        runs = [r for r, _ in seen.most_common(TABLE_ROWS)]
        lengths = _Lengths(tokenizer_file, {})
        yield pd.DataFrame({"run": runs, "n": lengths.encode(runs)})

    # the sample only fills a cache: it has no influence on any count
    there = docs.count()
    share = int((1 << 20) * min(1.0, SAMPLE_DOCS / max(there, 1)))
    h = F.xxhash64(text)
    sample = docs.select(F.col(text), h.alias("h")).where(F.pmod(h, F.lit(1 << 20)) < share)
    # copies of a text are one: a frequent one cannot fill the task
    sample = sample.groupBy("h").agg(F.first(text).alias(text)).select(text).repartition(1)
    return {bytes(r.run): r.n for r in sample.mapInPandas(count, "run binary, n long").collect()}


def count_tokens(
    docs: DataFrame, tokenizer_file: str, text: str = "text", out: str = "n_tokens"
) -> DataFrame:
    """``docs`` with a column ``out``: the tokens of the whole text by the ``tokenizers`` file at
    ``tokenizer_file`` (a path that every executor has), without tokens that frame a text and
    without truncation or padding. A null or empty text has 0 tokens; rows, ties and other columns
    are left as they are (a column already named ``out`` is replaced)."""
    spark = docs.sparkSession
    bound_batches(spark)
    table = spark.sparkContext.broadcast(_frequent_runs(docs, text, tokenizer_file))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = _Lengths(tokenizer_file, table.value)
        for batch in batches:
            texts = [(t or "").encode().split() for t in batch]
            lengths.learn(set().union(*texts))
            yield pd.Series([sum(map(lengths.__getitem__, runs)) for runs in texts], dtype="int64")

    return docs.withColumn(out, tokens(F.col(text)))
