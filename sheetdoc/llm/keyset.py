"""A set of 64-bit keys to look for while reading texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetdoc.llm.common import Staged
from sheetdoc.llm.packed import Columns, Packed, gathered

#: Bits of a filter that is broadcast for a set of keys, at most (32 MB): 16 to 32 a
#: key, so that some 0.5 % of other keys hit. A larger set is joined, unless its user takes fewer
#: bits a key (at 2, some 47 % of other keys hit).
FILTER_BITS = 1 << 28
#: Bits a key that a filter has at least.
KEY_BITS = 16
#: Where the bits of a key that name its places in the filter begin; all must be set for a hit.
SHIFTS = (0, 6, 13)
#: Places of keys in the filter, which has 1 << 16 bits or more, dealt into ranges of them.
_PLACES = Packed(256, place="u4")


class KeySet:
    """``keys`` has one long column, ``finger``: the ``low_bits`` low bits of keys.

    A set that is small enough becomes a broadcast bit filter (``bits``; it has a few false hits,
    more where ``key_bits`` allows fewer bits a key than KEY_BITS); for a larger one ``bits`` is None
    and ``only`` joins."""

    def __init__(self, keys: DataFrame, low_bits: int = 64, key_bits: int = KEY_BITS):
        if 1 << low_bits < FILTER_BITS << max(SHIFTS):  # a place must lie within the kept bits
            raise ValueError("too few bits of the keys are kept")
        self.table = Staged([keys], "keys")
        self.low_bits, self.keys, self.bits = low_bits, self.table.rows, None
        count = max(1, self.keys.count())
        many = 1 << max(16, (KEY_BITS * count - 1).bit_length())
        if many > FILTER_BITS >= max(1 << 16, key_bits * count):
            many = FILTER_BITS
        if many <= FILTER_BITS:
            filled = Staged([_PLACES.dealt(self.keys.mapInArrow(_places(many), Packed.schema), _filled, "word array<long>, bits array<long>")], "key-bits")
            table = np.zeros(many >> 6, np.uint64)
            for piece in filled.rows.toArrow().to_batches():
                word, bits = (piece.column(c).flatten().to_numpy() for c in ("word", "bits"))
                table[word] = bits.view(np.uint64)
            filled.drop()
            self.bits = keys.sparkSession.sparkContext.broadcast(table)

    def only(self, rows: DataFrame, column: str = "key") -> DataFrame:
        """``rows`` whose key is in the set, where the tasks could not test it."""
        if self.bits is not None:
            return rows
        finger = F.col(column).bitwiseAND(F.lit(-1 if self.low_bits == 64 else (1 << self.low_bits) - 1))
        return rows.withColumn("finger", finger).join(self.keys, "finger", "left_semi").drop("finger")


def _places(many: int):
    """Keys -> their places among ``many``, dealt into ranges of places."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = gathered(pd.DataFrame({"finger": b.column(0).to_numpy()}) for b in batches)
        for finger in (rows["finger"].to_numpy().view(np.uint64) for rows in keys):
            place = np.concatenate([finger >> np.uint64(n) & np.uint64(many - 1) for n in SHIFTS])
            rows = _PLACES.rows((place * np.uint64(_PLACES.many) // np.uint64(many)).astype(np.int64), {"place": place})
            yield pa.RecordBatch.from_pandas(rows.astype({"bucket": np.int32, "n": np.int32}), preserve_index=False)

    return each


def _filled(buckets: Iterator[Columns]) -> Iterator[pd.DataFrame]:
    """Words of the filter that have bits, and their bits; a word's places are all in one range."""
    for cols in buckets:
        place = np.sort(cols["place"])
        word = place >> np.uint32(6)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        bits = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint32(63)).astype(np.uint64), first)
        yield pd.DataFrame({"word": [word[first].astype(np.int64)], "bits": [bits.view(np.int64)]})


def tester(bits):
    """A function keys -> which of them may be in the set, for use inside a task."""
    if bits is None:
        return lambda h: np.ones(len(h), bool)
    table = bits.value
    most = np.uint64(64 * len(table) - 1)

    def test(h: np.ndarray) -> np.ndarray:
        left = np.arange(len(h))
        for n in SHIFTS:  # most keys that are not in the set miss their first place
            place = (h[left] >> np.uint64(n)) & most
            left = left[(table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
        found = np.zeros(len(h), bool)
        found[left] = True
        return found

    return test
