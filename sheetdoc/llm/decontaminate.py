"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are lower-cased (A-Z) and cut into words; every window of ``WINDOW`` consecutive words
(a shorter item is one window) becomes a pattern of the normalised text, with a space around each
word so that matches begin and end at words. Each document is normalised the same way, scanned
once, and the matched words are mapped back to code-point offsets of the original text. The
automaton is built in each Python worker from broadcast patterns. Their size is measured first:
a benchmark beyond ``PART_CHARS`` is dealt into several automata, each scanned in turn, and their
hits are united, so no broadcast grows beyond that bound.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetdoc.llm.common import bound_batches, free_name

#: Consecutive words that count as a test question or answer seen again.
WINDOW = 13
#: Characters of test items that go into one automaton (each is in up to WINDOW patterns).
PART_CHARS = 2_000_000

#: byte -> byte: A-Z to lower case, letters, digits and non-ASCII kept, all others a space.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_HITS = "n_words long, hit array<int>, items array<long>, spans array<struct<start:int,end:int>>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


def _patterns(items: list[tuple[int | None, str | None]], window: int) -> dict[str, tuple[int, list[int]]]:
    """pattern -> (its words, the items that hold it)."""
    found: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            key = (b" " + b" ".join(words[i : i + n]) + b" ").decode("latin-1")
            found.setdefault(key, (n, set()))[1].update([] if item_id is None else [item_id])
    return {k: (n, sorted(ids)) for k, (n, ids) in found.items()}


def _automaton(patterns: dict[str, tuple[int, list[int]]]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for key, value in patterns.items():
        made.add_word(key, value)
    if patterns:
        made.make_automaton()
    return made


def _scan(automaton, text: str | None) -> tuple[int, list[int], list[int], list[tuple[int, int]]]:
    """Words of the text, indexes of the hit words, items found, hit runs as code-point spans."""
    words = words_of(text)
    if not words or not len(automaton):
        return len(words), [], [], []
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found = list(automaton.iter(line))
    if not found:
        return len(words), [], [], []
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])  # of the space before each word
    hit = np.zeros(len(words) + 1, np.int32)
    items: set[int] = set()
    for end, (n, ids) in found:
        last = int(np.searchsorted(starts, end))  # the space that ends the match opens word `last`
        hit[last - n] += 1
        hit[last] -= 1
        items.update(ids)
    covered = np.cumsum(hit[:-1]) > 0
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    spans, byte, char = [], 0, 0
    for first, stop in zip(edges[::2], edges[1::2], strict=True):
        pair = []
        for b in (at[first][0], at[stop - 1][1]):
            char += len(raw[byte:b].decode())
            byte = b
            pair.append(char)
        spans.append(tuple(pair))
    return len(words), np.flatnonzero(covered).tolist(), sorted(items), spans


def _scanner(shared):
    @F.pandas_udf(_HITS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared.value)
        for batch in batches:
            rows = [_scan(automaton, t) for t in batch]
            yield pd.DataFrame({
                "n_words": [r[0] for r in rows], "hit": [r[1] for r in rows], "items": [r[2] for r in rows],
                "spans": [[{"start": a, "end": b} for a, b in r[3]] for r in rows],
            })

    return scan


def _parts(benchmark: DataFrame, item: str, text: str, part_chars: int) -> int:
    chars = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    return max(1, -(-chars // part_chars))


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, part_chars: int = PART_CHARS,
    out: str = "benchmark_hits",
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_words`` (words of the document),
    ``n_hit`` (those inside an occurrence of a window), ``items`` (sorted ids of the items with an
    occurring window) and ``spans`` (code-point ranges of the original text that hits cover; where
    the benchmark needs several automata, ranges of each).

    A null or empty text has no words and no hits; an item without words has no window; a row of
    the benchmark without an id hits words but is not listed; repeated items count once. Extra
    columns stay (one named ``out`` is replaced)."""
    spark = docs.sparkSession
    bound_batches(spark)
    parts = _parts(benchmark, item, item_text, part_chars)
    found = []
    for part in range(parts):
        own = benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t"))
        if parts > 1:  # dealt by content: no part holds much more than its share
            own = own.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == part)
        found.append(_scanner(spark.sparkContext.broadcast(_patterns([tuple(r) for r in own.collect()], window)))(F.col(text)))
    more = free_name(docs, "benchmark_more")
    raw = docs.withColumn(out, found[0])
    for other in found[1:]:
        raw = raw.withColumn(more, other).withColumn(out, F.struct(
            F.col(f"{out}.n_words"),
            F.array_union(f"{out}.hit", f"{more}.hit").alias("hit"),
            F.array_sort(F.array_union(f"{out}.items", f"{more}.items")).alias("items"),
            F.array_sort(F.array_union(f"{out}.spans", f"{more}.spans")).alias("spans"),
        )).drop(more)
    return raw.withColumn(out, F.struct(
        f"{out}.n_words", F.size(f"{out}.hit").cast("long").alias("n_hit"), f"{out}.items", f"{out}.spans",
    ))


def is_contaminated(hits: str = "benchmark_hits", least: int = 20):
    """True where the hit words are at least one in ``least`` of the document's words."""
    n_hit, n_words = F.col(f"{hits}.n_hit"), F.col(f"{hits}.n_words")
    return (n_hit > 0) & (least * n_hit >= n_words)
